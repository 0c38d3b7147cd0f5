"""Fixed schemas of every table that crosses an operator boundary."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE, BOOL = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Raw message dump: every column is text, as in the source files.
TWEETS = _struct(
    ("tweet_id", STRING), ("author_id", STRING), ("inbound", STRING), ("created_at", STRING),
    ("text", STRING), ("response_tweet_id", STRING), ("in_response_to_tweet_id", STRING),
)

TURN = _struct(
    ("seq", LONG), ("role", STRING), ("author_id", STRING), ("text", STRING), ("tweet_id", STRING),
)

TURNS = _struct(
    ("thread_id", STRING), ("root_id", STRING), ("brand", STRING), ("seq", LONG), ("role", STRING),
    ("author_id", STRING), ("text", STRING), ("tweet_id", STRING),
)

# Nested thread rows; a thread longer than one page has several rows, so no row is unbounded.
THREAD_PAGES = _struct(
    ("thread_id", STRING), ("root_id", STRING), ("brand", STRING), ("page", LONG),
    ("turns", T.ArrayType(TURN)),
)

GOLDEN_CSV = _struct(
    ("thread_id", STRING), ("customer_query", STRING), ("brand_response_actual", STRING),
    ("intent", STRING), ("escalate", STRING), ("escalation_reason", STRING), ("notes", STRING),
)

NEIGHBOURS = T.ArrayType(_struct(("query", STRING), ("response", STRING), ("score", DOUBLE)))

PREDICTIONS = _struct(
    ("example_id", LONG), ("query", STRING), ("intent", STRING), ("intent_confidence", STRING),
    ("reply", STRING), ("escalate", STRING), ("escalation_reason", STRING),
    ("similar_threads", NEIGHBOURS),
)

JUDGE_SCORES = _struct(
    ("example_id", LONG), ("helpfulness", INT), ("tone", INT), ("groundedness", INT),
    ("overall", DOUBLE), ("reasoning", STRING),
)

HUMAN_SHEET = _struct(
    ("index", STRING), ("customer_query", STRING), ("generated_reply", STRING),
    ("actual_reply", STRING), ("human_helpfulness", STRING), ("human_tone", STRING),
    ("human_groundedness", STRING), ("human_notes", STRING),
)

RESPONSES = _struct(("example_id", LONG), ("stage", STRING), ("response", STRING))

METRICS = _struct(
    ("system", STRING), ("family", STRING), ("metric", STRING), ("class", STRING), ("value", DOUBLE),
)
