"""The fitted language model: its frequencies, and what counting takes of the driver's Python."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from threadloom.llm import kernels as K, language


def find(table: K.HashTable, names: list[str]) -> np.ndarray:
    raw, at = K.text_buffer(pa.array(names, pa.string()))
    return table.find(K.span_hashes(raw, at[:-1], at[1:]))


def logs(counts: dict[tuple[str, str], int], names: list[str], languages: list[str]) -> np.ndarray:
    table = np.array([[counts.get((x, name), 0) for x in languages] for name in names], float)
    return np.log(table + 0.5) - np.log(table.sum(0) + 0.5 * len(names))


def test_frequencies_are_those_of_a_plain_count(spark):
    texts = [("a", "One one TWO, zwei! straße"), ("a", "one two straße x"), ("b", "zwei zwei eins one"), ("b", "eins été"), ("ü", "été été")]
    rows = [(i, text, lang) for i, (lang, text) in enumerate(texts)] + [(90, None, "a"), (91, "one", None), (92, "", "b"), (93, "12 ...", "c")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    words, grams = collections.Counter(), collections.Counter()
    for lang, text in texts:
        for word in re.findall(r"[a-z\x80-\U0010ffff]+", text.lower()):
            words[lang, word] += 1
            grams.update((lang, word[i : i + k]) for k in range(1, language.LONGEST + 1) for i in range(len(word) - k + 1))
    assert model.languages == ["a", "b", "ü"]
    for counted, table, found in ((words, model.words, model.word_logs), (grams, model.grams, model.gram_logs)):
        kept = {x: n for x, n in counted.items() if n >= language.LEAST_COUNT}
        names = sorted({name for _, name in kept})
        place = find(table, names)
        assert sorted(place) == list(range(len(names))) and found.shape == (len(names), 3)
        assert np.allclose(found[place], logs(kept, names, model.languages), atol=1e-5)
    assert find(model.words, ["x", "twos"]).tolist() == [-1, -1]


def test_counts_do_not_become_python_rows(spark):
    """Counts were collected as Python rows, 762 bytes of the driver's Python for each entry of this model at the peak."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(15_000)]
    rows = [(i, " ".join(words[i // 2 * 150 :][:150]), "ab"[i // 2 % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        model = language.fit(docs)
        peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes()
    finally:
        tracemalloc.stop()
    entries = len(model.word_logs) + len(model.gram_logs)
    assert entries > 90_000
    assert peak / entries < 300
