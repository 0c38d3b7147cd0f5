"""All registered queries; importing the package fills the registry."""

from threadloom.plans.catalog import (  # noqa: F401
    answer_queries, conversation_queries, job_queries, score_queries, search_queries, text_queries,
)
from threadloom.plans.catalog.base import ORACLES, QUERIES  # noqa: F401
