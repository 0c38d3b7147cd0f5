import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as X

SAMPLES = [
    None, "", "   ", "plain text", "a  b\t\nc", "zero​width‍join", "nbsp and　wide space",
    "see https://ex.com/ä?q=1 now", "http://a.b/c tail", "@user１２３ hello @naïve_1! mail a@b.c",
    "ünïcödé text ünïcödé", "日本語のテキスト", "\x85line\x1csep x", "'quoted'", '"both\'', " \t '\"x\"' ", "ends with space ",
    "a" * 79 + " b", "É" * 81, "tab\tonly", "x y", "ABC​ ",
]


def expected_clean(text):
    if text is None:
        return ""
    text = "".join(ch for ch in text if ch not in "​‍")
    text = re.sub(r"https?://\S+", "[URL]", text)
    text = re.sub(r"@\w+", "", text)
    return " ".join(text.split())


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clean_text_agrees_with_unicode_aware_rules(samples):
    assert column(samples, X.clean_text(F.col("t"))) == [expected_clean(t) for t in SAMPLES]


def test_random_texts(spark):
    rng = random.Random(5)
    pieces = [" ", "  ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u200b", "\u200d", "\u200c",
              "@", "@a", "@é_9²", "http://", "https://x.y/z", "HTTP://q", "http:/", "a", "Z", "_", "9", "½", "é", "e\u0301", "日", "\U0001f600",
              "!", "~", "\x7f", "\x00", "'", '"', "$1", "\\"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = df.orderBy("i").select(
        X.clean_text(F.col("t")), X.is_mostly_ascii(F.col("t")), X.prefix_key(F.col("t")), X.tidy_reply(F.col("t"))
    ).collect()
    for text, row in zip(texts, got):
        assert row[0] == expected_clean(text), ascii(text)
        assert row[1] == (bool(text) and sum(ord(ch) < 128 for ch in text) / len(text) > 0.8)
        assert row[2] == text[:80].lower().strip(), ascii(text)
        assert row[3] == text.strip().strip('"').strip("'"), ascii(text)


def test_ascii_share_is_strict(spark):
    rows = [("abcdé", False), ("abcdeé", True), ("", False), (None, False), ("plain", True), ("\U0001f600", False)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    assert column(df, X.is_mostly_ascii(F.col("t"))) == [e for _, e in rows]


def test_prefix_key_cuts_then_lowers_then_strips(samples):
    got = column(samples, X.prefix_key(F.col("t")))
    assert got == [None if t is None else t[:80].lower().strip() for t in SAMPLES]


def test_reply_tidy_and_cap(spark):
    words = ("word " * 80).strip()
    texts = ['  "Hi there"  ', "'x'", "\"'y'\"", "a" * 300, "a" * 301, words[:300], words[:301], "b" * 290, "c" * 281]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")

    def expected(t):
        t = t.strip().strip('"').strip("'")
        return t[:280].rsplit(" ", 1)[0] + "..." if len(t) > 300 else t

    assert column(df, X.cap_reply(X.tidy_reply(F.col("t")))) == [expected(t) for t in texts]


def test_flags_ids_and_missing(spark):
    df = spark.createDataFrame([(0, "True"), (1, "1"), (2, "YES"), (3, "no"), (4, None), (5, " yes ")], "i int, t string")
    assert column(df, X.truthy(F.col("t"))) == [True, True, True, False, False, False]
    assert column(df, X.truthy_label(F.col("t"))) == [True, True, True, False, False, True]
    df = spark.createDataFrame([(0, "1, 2,,3 "), (1, "nan"), (2, ""), (3, "None"), (4, "NaN"), (5, None)], "i int, t string")
    assert column(df, X.split_ids(X.null_if_missing(F.col("t")))) == [["1", "2", "3"], None, None, None, None, None]


def test_number_texts(spark):
    df = spark.createDataFrame([(0, 0.8005), (1, 0.125), (2, None), (3, 1.0)], "i int, v double")
    assert column(df, X.percent(F.col("v"))) == [f"{0.8005 * 100:.1f}%", "12.5%", "N/A", "100.0%"]
    assert column(df, X.two_decimals(F.col("v"))) == ["0.80", "0.13", "N/A", "1.00"]
    df = spark.createDataFrame([(0, "café olé")], "i int, t string")
    assert column(df, X.ascii_preview(F.col("t"), 6)) == ["caf? o"]
