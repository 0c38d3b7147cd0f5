"""Column functions for message text. All of them stay inside JVM expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from threadloom import constants as C

# Unicode white space and word characters, spelled out because Java's \s, \S and \w are ASCII only.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
ZERO_WIDTH = ("\u200b", "\u200d")
ASCII_BREAKS = ("\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f")
# White space that is more than one plain blank; a lone blank needs no rewriting. The look-ahead
# turns printable ASCII away before the costly Unicode class is tried.
RAGGED_SPACE = rf"(?![!-~])(?: (?![!-~])[{SPACE}]++|(?! )[{SPACE}]++)"


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def mask_urls(c: Column) -> Column:
    return F.regexp_replace(c, rf"https?://[^{SPACE}]+", "[URL]")


def strip_mentions(c: Column) -> Column:
    return F.regexp_replace(c, rf"@[{WORD}]+", "")


def _contains_any(c: Column, marks: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [c.contains(mark) for mark in marks])


def clean_text(c: Column) -> Column:
    """Drop zero-width marks, mask links, drop mentions, collapse white space; NULL becomes ''.

    Most messages need less than the whole chain. Substring tests on the raw text pick the shortest
    one: plain ASCII text with single blanks runs no regular expression.
    """
    c = F.coalesce(c, F.lit(""))
    bare = strip_mentions(mask_urls(F.translate(c, "".join(ZERO_WIDTH), "")))
    marked = _contains_any(c, ("@", "http", *ZERO_WIDTH))
    ragged = _contains_any(c, ("  ", *ASCII_BREAKS)) | (F.octet_length(c) != F.length(c))
    return F.trim(
        F.when(marked, F.regexp_replace(bare, RAGGED_SPACE, " "))
        .when(ragged, F.regexp_replace(c, RAGGED_SPACE, " "))
        .otherwise(c)
    )


def ascii_share(c: Column) -> Column:
    """Share of ASCII characters, NULL for empty text."""
    ascii_only = F.regexp_replace(c, r"[^\x00-\x7F]+", "")
    kept = F.when(F.octet_length(c) == F.length(c), F.length(c)).otherwise(F.length(ascii_only))
    return F.try_divide(kept, F.length(c))


def is_mostly_ascii(c: Column, share: float = C.ASCII_SHARE) -> Column:
    return F.coalesce(ascii_share(c) > share, F.lit(False))


def null_if_missing(c: Column) -> Column:
    """Map the spellings of a missing value to NULL."""
    return F.when(~c.isin(*C.MISSING_SPELLINGS), c)


def truthy(c: Column) -> Column:
    """Flag text as written in the message dump; NULL is false."""
    return F.coalesce(F.lower(c).isin(*C.TRUE_FLAGS), F.lit(False))


def truthy_label(c: Column) -> Column:
    """Flag label as written by a model or a person; spaces around it do not count."""
    return truthy(strip(c))


def split_ids(c: Column) -> Column:
    """Comma list to an array of ids without blanks."""
    parts = F.transform(F.split(c, ","), strip)
    return F.filter(parts, lambda x: x != "")


def thread_key(root: Column) -> Column:
    return F.substring(F.md5(root), 1, 12)


def prefix_key(c: Column, length: int = C.DEDUP_PREFIX) -> Column:
    return strip(F.lower(F.substring(c, 1, length)))


def ascii_preview(c: Column, length: int) -> Column:
    """Leading characters with every non-ASCII one shown as '?'."""
    return F.regexp_replace(F.substring(c, 1, length), r"[^\x00-\x7F]", "?")


def tidy_reply(c: Column) -> Column:
    """White space, then double quotes, then single quotes off both ends."""
    return F.trim(F.trim(strip(c), F.lit('"')), F.lit("'"))


def cap_reply(c: Column, limit: int = C.REPLY_LIMIT, cut: int = C.REPLY_CUT) -> Column:
    """Shorten only above ``limit``: keep ``cut`` characters, back up to the last space, add dots."""
    head = F.regexp_replace(F.substring(c, 1, cut), r" [^ ]*\z", "")
    return F.when(F.length(c) > limit, F.concat(head, F.lit("..."))).otherwise(c)


def in_taxonomy(c: Column) -> Column:
    return F.coalesce(c.isin(*C.INTENTS), F.lit(False))


def to_taxonomy(c: Column) -> Column:
    """Normalised label; anything outside the taxonomy becomes the fallback."""
    label = strip_lower(c)
    return F.when(in_taxonomy(label), label).otherwise(C.FALLBACK_INTENT)


def decimals(c: Column, digits: int) -> Column:
    """Fixed number of decimals, rounded from the exact binary value."""
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", c.cast("double"), F.lit(pattern))


def percent(c: Column, digits: int = 1) -> Column:
    """A share as percent text. Shares are reported from their four-digit values."""
    return F.coalesce(F.concat(decimals(F.round(c, 4) * 100, digits), F.lit("%")), F.lit("N/A"))


def two_decimals(c: Column) -> Column:
    return F.coalesce(decimals(F.round(c, 2), 2), F.lit("N/A"))


def sampling_key(c: Column, seed: int = C.SEED) -> Column:
    """Order by this key for a uniform sample that depends on the seed and the id only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
