"""BPE ids of whole texts by a table of distinct words, and texts back from ids.

For vocabularies whose words are encoded one by one (a model of words with word ends). Spark cuts
the texts into words in blocks of a bounded number of bytes. A block keeps each of its words once, by
number, and the numbers of its texts. The words of all blocks, dealt by hash, form the table of
distinct words; each is encoded once. The ids go back to the block that asked, where the numbers say
in which places they stand. What moves are compressed lists, a few hundredths of a row per word.

Decoding joins ids with the pieces of the vocabulary, a table of fixed size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from threadloom.llm import kernels as K
from threadloom.llm.common import prepare, temporary

# Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 16_000_000
# Bytes of text that are cut at once, unless a text is longer.
SLICE_BYTES = 500_000
# Block words that one group of the distinct-word table holds, on average.
GROUP_WORDS = 250_000
# Ids of a batch while decoding; a longer text is decoded alone.
DECODE_IDS = 1_000_000

_SPACE, _LETTER, _NUMBER, _OTHER = 1, 2, 3, 4
# Starts a word that stands for an added token; no UTF-8 text holds this byte.
_ADDED = b"\xff"
_BREAK = 10
# The pattern that the fast cutter follows (a fixed value); others are cut by the library.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_FAST_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the others in order from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Splitter:
    """Cuts texts into the words that the library would encode one by one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = self.library.get_added_tokens_decoder()
        if any(x.lstrip or x.rstrip or x.single_word or x.normalized for x in added.values()):
            raise ValueError("added tokens that take neighbouring characters are not supported")
        letters = _byte_letters()
        self.mapped = {i: letters[i] for i in range(256)}
        self.unmapped = {ord(c): i for i, c in enumerate(letters)}
        self.added = {x.content: _ADDED + str(i).encode() for i, x in added.items()}
        names = sorted(self.added, key=len, reverse=True)
        self.spelled = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.raw_spelled = re.compile(b"(?=" + b"|".join(re.escape(x.encode()) for x in names) + b")") if names else None
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.fast = [x["type"] for x in steps] == _FAST_NORMALIZERS and cuts[0].get("pattern") == {"Regex": _PATTERN}
        if cuts[-1].get("type") != "ByteLevel":
            raise ValueError("a byte-level vocabulary is needed")
        self.kinds = self._classes() if self.fast else None
        self.lower = K.LOWER

    def _cut(self, text: str) -> list[str]:
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def _classes(self) -> np.ndarray:
        """Classes of the code points below 0x100, asked from the library."""
        kinds = np.full(0x100, _OTHER, np.uint8)
        for code in range(0x100):
            letter = chr(code)
            if not self._cut(letter):
                kinds[code] = _SPACE
            elif len(self._cut("q" + letter)) == 1:
                kinds[code] = _LETTER
            elif len(self._cut("!" + letter)) == 2:
                kinds[code] = _NUMBER
        return kinds

    def words(self, text: str) -> list[bytes]:
        """The words of one text, by the library."""
        parts = self.spelled.split(text) if self.spelled else [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(self.added[part])
            else:
                out += [x.translate(self.unmapped).encode("latin-1") for x in self._cut(part)]
        return out

    def split(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends, words per text) of the words of all texts, in order."""
        n = len(at) - 1
        odd = np.full(n, not self.fast)
        if self.fast:
            far = np.flatnonzero(raw >= 0xC4)  # from U+0100 on
            odd[K.rows_of(far, at)] = True
            if self.raw_spelled:
                marks = np.array([m.start() for m in self.raw_spelled.finditer(raw.tobytes())], np.int64)
                odd[K.rows_of(marks, at)] = True
        if not odd.any():
            starts, ends, raw = self._fast(raw, at)
            return raw, starts, ends, K.row_counts(K.rows_of(starts, at), n)
        plain = np.flatnonzero(~odd)
        sizes = at[plain + 1] - at[plain]
        flat = raw[K.spread(at[plain], sizes)]
        flat_at = np.concatenate([[0], np.cumsum(sizes)])
        starts, ends, flat = self._fast(flat, flat_at) if len(plain) else (np.empty(0, np.int64),) * 2 + (flat,)
        counts = np.zeros(n, np.int64)
        counts[plain] = K.row_counts(K.rows_of(starts, flat_at), len(plain))
        hard = [self.words(x) for x in K.strings_of(raw, at[:-1][odd], at[1:][odd])]
        counts[odd] = [len(x) for x in hard]
        more = [w for words in hard for w in words]
        lengths = np.array([len(w) for w in more], np.int64)
        more_ends = len(flat) + np.cumsum(lengths)
        place = np.cumsum(counts) - counts
        all_starts, all_ends = np.empty(int(counts.sum()), np.int64), np.empty(int(counts.sum()), np.int64)
        for rows, own_starts, own_ends in ((plain, starts, ends), (np.flatnonzero(odd), more_ends - lengths, more_ends)):
            where = K.spread(place[rows], counts[rows])
            all_starts[where], all_ends[where] = own_starts, own_ends
        joined = np.concatenate([flat, np.frombuffer(b"".join(more), np.uint8)])
        return joined, all_starts, all_ends, counts

    def _fast(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and the lower-cased bytes; for code points below 0x100."""
        n = len(raw)
        raw = self.lower[raw]
        if n == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64), raw
        kind = self.kinds[raw]
        two = np.flatnonzero(raw >= 0xC2)
        code = (raw[two] & 3) << 6 | (raw[two + 1] & 0x3F)
        capital = (code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)
        raw[two[capital] + 1] += 32
        kind[two] = kind[two + 1] = self.kinds[code]
        start = np.zeros(n + 1, bool)
        start[at[:-1]] = True
        start[n] = True
        start[1:n] |= kind[1:] != kind[:-1]
        # Each number is a word; its second byte, if any, is not.
        number = np.zeros(n + 1, bool)
        number[:n] = kind == _NUMBER
        number[two + 1] = False
        start |= number
        # Contractions: an apostrophe that is a whole run, and the letters after it.
        mark = np.flatnonzero((raw == 39) & start[:n] & start[1:])
        mark = mark[mark + 1 < n]
        head = np.zeros(n + 2, bool)
        head[at] = True
        mark = mark[(kind[mark + 1] == _LETTER) & ~head[mark + 1]]
        if len(mark):
            one = raw[mark + 1]
            room = (mark + 2 < n) & ~head[mark + 2]
            second = np.where(room, raw[np.minimum(mark + 2, n - 1)], 0)
            single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            double = ((one == 114) | (one == 118)) & (second == 101) | (one == 108) & (second == 108)
            short = mark[single | double]
            start[short + 1] = False
            start[short + 2 + double[single | double]] = True
        edges = np.flatnonzero(start)
        starts, ends = edges[:-1], edges[1:]
        real = kind[starts] != _SPACE
        return starts[real], ends[real], raw

    def ids(self, word: bytes) -> list[int]:
        """Ids of one word."""
        if word[:1] == _ADDED:
            return [int(word[1:])]
        return [x.id for x in self.library.model.tokenize(word.decode("latin-1").translate(self.mapped))]


_SPLITTERS: dict[str, Splitter] = {}


def splitter(path: str) -> Splitter:
    """The splitter of this Python worker."""
    if path not in _SPLITTERS:
        _SPLITTERS[path] = Splitter(path)
    return _SPLITTERS[path]


# Numbers below _ONE take one byte, those below _TWO two bytes.
_ONE = 192
_TWO = _ONE + 63 * 256


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers, most of them small, in one, two or four bytes, each byte in a stream of its own, compressed."""
    values = values.astype(np.uint32)
    two = (values >= _ONE) & (values < _TWO)
    far = values >= _TWO
    rest = values[two] - _ONE
    first = values.astype(np.uint8)
    first[two] = _ONE + (rest >> 8)
    first[far] = 255
    last = np.ascontiguousarray((values[far] - _TWO).astype("<u4").view(np.uint8).reshape(-1, 4).T[:3])
    sizes = np.array([len(first), len(rest), len(last[0])], "<u4")
    return zstandard.compress(sizes.tobytes() + first.tobytes() + (rest & 255).astype(np.uint8).tobytes() + last.tobytes(), 3)


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    n, n_two, n_far = raw[:12].view("<u4").tolist()
    first, rest, last = raw[12 : 12 + n], raw[12 + n : 12 + n + n_two], raw[12 + n + n_two :].reshape(3, n_far).astype(np.uint32)
    values = first.astype(np.uint32)
    values[(first >= _ONE) & (first < 255)] = _ONE + (first[(first >= _ONE) & (first < 255)].astype(np.uint32) - _ONE << 8) + rest
    values[first == 255] = _TWO + (last[0] | last[1] << 8 | last[2] << 16)
    return values


def _pack_ids(ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + zstandard.compress(ids.astype(f"<u{width}").tobytes(), 3)


def _unpack_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), f"<u{data[0]}")


def spell(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words at these places, joined by a line break, which no word holds."""
    lengths = ends - starts + 1
    out = raw[np.minimum(K.spread(starts, lengths), len(raw) - 1)]
    out[np.cumsum(lengths) - 1] = _BREAK
    return out[:-1].tobytes()


def _end_to_end(words: list[tuple[bytes, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of the words of several lists."""
    raw = np.frombuffer(b"\n".join(x for x, _ in words), np.uint8)
    lengths = np.concatenate([np.empty(0, np.int64), *(x for _, x in words)])
    ends = np.cumsum(lengths + 1) - 1
    return raw, ends - lengths, ends


def _by_spelling(listed: bytes) -> list[int]:
    """The order of listed words by their bytes."""
    words = listed.split(b"\n") if listed else []
    return sorted(range(len(words)), key=words.__getitem__)


def _cut(path: str, kind: pa.DataType):
    """Rows of a block: its distinct words, the most frequent first, and for each run of its texts
    their keys, words per text and word numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(path)
        block = TaskContext.get().partitionId() << 33
        table, words, chunks, held = K.HashTable(16), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, table, held
            often = np.zeros(table.size, np.int64)
            for _, _, numbers in chunks:
                often += np.bincount(numbers, minlength=table.size)
            data, starts, ends = _end_to_end(words)
            order = np.argsort(-often, kind="stable")
            # Numbers of one or two bytes go by frequency; the others by spelling, which compresses best.
            rare = order[_TWO:]
            order[_TWO:] = rare[_by_spelling(spell(data, starts[rare], ends[rare]))]
            rank = np.empty(table.size, np.uint32)
            rank[order] = np.arange(table.size)
            listed = zstandard.compress(spell(data, starts[order], ends[order]), 9)
            none = pa.nulls(1, pa.list_(kind)), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([-1]), *none, pa.array([listed], pa.binary()), pa.array([table.size])], _CUT)
            for place, (keys, counts, numbers) in enumerate(chunks):
                names = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys.cast(kind))
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([place]), names, pa.array([counts]), pa.array([pack_numbers(rank[numbers])], pa.binary()),
                    pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())], _CUT)
            block, table, held = block + 1, K.HashTable(16), 0
            words.clear()
            chunks.clear()

        for batch in batches:
            for first, end, raw, at in K.slices(batch.column(1), SLICE_BYTES):
                if held and held + len(raw) > BLOCK_BYTES:
                    yield from flush()
                held += max(len(raw), 1)
                raw, starts, ends, counts = own.split(raw, at)
                hashes = K.span_hashes(raw, starts, ends)
                numbers = table.find(hashes)
                missing = np.flatnonzero(numbers < 0)
                if len(missing):
                    fresh, where = np.unique(hashes[missing], return_index=True)
                    where = missing[where]
                    words.append((spell(raw, starts[where], ends[where]), ends[where] - starts[where]))
                    table.insert(fresh)
                    numbers[missing] = table.find(hashes[missing])
                chunks.append((batch.column(0).slice(first, end - first), counts, numbers))
        if chunks:
            yield from flush()

    return run


_CUT = ["block", "chunk", "keys", "counts", "numbers", "words", "n_words"]


def _deal(path: str, groups: int):
    """The words of each block by group: (group, block, places in the block's list, words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = zstandard.decompress(data)
                if not data:
                    continue
                raw = np.frombuffer(data, np.uint8)
                ends = np.concatenate([np.flatnonzero(raw == _BREAK), [len(raw)]])
                starts = np.concatenate([[0], ends[:-1] + 1])
                group = (K.span_hashes(raw, starts, ends) % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                cuts = np.flatnonzero(np.diff(group[order])) + 1
                parts = np.split(order, cuts)
                yield pa.record_batch({
                    "group": pa.array(group[[p[0] for p in parts]]), "block": pa.array([block] * len(parts)),
                    "places": pa.array([pack_numbers(np.diff(p, prepend=0)) for p in parts], pa.binary()),
                    "words": pa.array([zstandard.compress(spell(raw, starts[p], ends[p]), 9) for p in parts], pa.binary()),
                })

    return run


def _encode_group(path: str):
    """The distinct words of a group, each encoded once, and their ids for each block that asked."""
    def run(table: pa.Table) -> pa.Table:
        own, known, asked = splitter(path), {}, []
        for data in table["words"].to_pylist():
            asked.append(np.array([known.setdefault(w, len(known)) for w in zstandard.decompress(data).split(b"\n")], np.int64))
        ids = [own.ids(w) for w in known]
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.int64)
        begin = np.cumsum(lengths) - lengths
        return pa.table({
            "block": table["block"], "places": table["places"],
            "ids": pa.array([_pack_ids(flat[K.spread(begin[x], lengths[x])]) for x in asked], pa.binary()),
            "lengths": pa.array([pack_numbers(lengths[x]) for x in asked], pa.binary()),
        })

    return run


def _put_back(kind: pa.DataType):
    """The ids of the texts of a block, from its numbers and the ids of its words."""
    def run(chunks: pa.Table, parts: pa.Table) -> pa.Table:
        places = [np.cumsum(unpack_numbers(x).astype(np.int64)) for x in parts["places"].to_pylist()]
        sizes = [unpack_numbers(x).astype(np.int64) for x in parts["lengths"].to_pylist()]
        flat = [_unpack_ids(x) for x in parts["ids"].to_pylist()]
        none = np.empty(0, np.int64)
        place, size, flat = np.concatenate([none, *places]), np.concatenate([none, *sizes]), np.concatenate([none, *flat]).astype(np.uint32)
        length, begin = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        length[place] = size
        begin[place] = np.cumsum(size) - size
        out = []
        for i in range(chunks.num_rows):
            numbers = unpack_numbers(chunks["numbers"][i].as_py()).astype(np.int64)
            counts = chunks["counts"][i].values.to_numpy()
            own = length[numbers]
            ids = flat[K.spread(begin[numbers], own)]
            before = np.concatenate([[0], np.cumsum(own)])
            ends = np.cumsum(counts)
            n_ids = before[ends] - before[ends - counts]
            out.append(pa.table({
                "key": chunks["keys"][i].values, "n_tokens": pa.array(n_ids), "ids": K.binary_column(ids, n_ids)}))
        return pa.concat_tables(out) if out else pa.schema(
            [("key", kind), ("n_tokens", pa.int64()), ("ids", pa.binary())]).empty_table()

    return run


def encode_words(docs: DataFrame, path: str, keep, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: the key, n_tokens, and ids (little-endian unsigned 32-bit numbers).

    The ids are those of the tokenizers library for the whole text with ``add_special_tokens=False``;
    spelled added tokens get their id, as there. ``keep(df, name)`` writes a table and reads it back
    (``common.temporary``); the stored blocks must stay until the result is written. Null and empty
    texts, and those without words, have no ids. Very long texts are whole, in a block of their own.
    Equal texts and repeated or null keys give a row each. An empty table gives no rows; other columns
    are not read.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)
    cut_schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("numbers", T.BinaryType()),
        T.StructField("words", T.BinaryType()), T.StructField("n_words", T.LongType()),
    ])
    cut = keep(source.mapInArrow(_cut(path, arrow), cut_schema), "word-blocks")
    lists = cut.filter("chunk < 0")
    listed = lists.agg(F.sum("n_words")).first()[0] or 0
    groups = max(1, -(-listed // GROUP_WORDS))
    dealt = lists.select("block", "words").mapInArrow(_deal(path, groups), "group long, block long, places binary, words binary")
    encoded = dealt.groupBy("group").applyInArrow(_encode_group(path), "block long, places binary, ids binary, lengths binary")
    out_schema = T.StructType([
        T.StructField("key", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    chunks = cut.filter("chunk >= 0").select("block", "keys", "counts", "numbers")
    placed = chunks.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(_put_back(arrow), out_schema)
    return placed.select(F.col("key").alias(key), "n_tokens", "ids")


def pieces(path: str) -> pa.Array:
    """The piece of each id of a vocabulary; ids without one are null."""
    own = splitter(path)
    vocabulary = own.library.get_vocab(with_added_tokens=True)
    names: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        names[i] = piece
    return pa.array(names, pa.string())


def _join_pieces(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        has = table.is_valid().to_numpy(zero_copy_only=False)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).cast(pa.large_binary()).fill_null(b"")
            sizes = pc.binary_length(ids).to_numpy() // 4
            ends = np.cumsum(sizes)
            first = 0
            while first < batch.num_rows:
                base = ends[first] - sizes[first]
                last = max(first + 1, int(np.searchsorted(ends, base + DECODE_IDS, side="right")))
                part = ids.slice(first, last - first)
                _, offsets, data = part.buffers()
                begin = np.frombuffer(offsets, np.int64, 1, 8 * part.offset)[0]
                n = int(ends[last - 1] - base)
                flat = np.frombuffer(data, "<u4", n, begin) if n else np.empty(0, np.uint32)
                known = (flat < len(table)) & has[np.minimum(flat, len(table) - 1)]
                bounds = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[base], ends[first:last]]) - base]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), table.take(pa.array(flat[known].astype(np.int64))))
                rest = [x.slice(first, last - first) for x in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, pc.binary_join(lists, " ")], batch.schema.names)
                first = last

    return run


def decode_words(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the text of their ids in column ``into``, as the library's
    ``decode(ids, skip_special_tokens=False)`` gives it: the pieces joined by one space, since the
    vocabulary has no decoder of its own.

    Ids join the pieces of the vocabulary, which are sent to every worker: their number is fixed by
    the file. Unknown ids give nothing. Null and empty ids give an empty text; very long ones are
    decoded alone; equal and repeated rows give a row each; an empty table no rows. All columns stay;
    one that is already called ``into`` (in any case) is replaced.
    """
    spark = prepare(encoded.sparkSession)
    if splitter(path).library.decoder is not None:
        raise ValueError("vocabularies with a decoder are not supported")
    shared = spark.sparkContext.broadcast(pieces(path))
    kept = [x for x in encoded.schema.fields if x.name.lower() != into.lower()]
    rows = encoded.select(*(encoded[f"`{x.name}`"] for x in kept), encoded[f"`{ids}`"].alias(into))
    schema = T.StructType([*kept, T.StructField(into, T.StringType())])
    return rows.mapInArrow(_join_pieces(shared), schema)
