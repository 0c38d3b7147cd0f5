"""Whole texts to token ids with a vocabulary of the tokenizers library, a batch at a time.

The vocabulary is byte-level BPE, whose pre-tokens are encoded one by one and never touch each
other. Each task therefore cuts the texts into pre-tokens with array operations, asks the library
only for pre-tokens it has not met, and keeps their ids in a bounded table. Texts with characters
outside the ranges that the cutter knows, and texts that spell an added token (which the library
splits off first), are encoded whole by the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from threadloom.llm import kernels as K

# Pre-tokens kept by a Python worker; when full, the table starts anew.
TABLE_LIMIT = 1_500_000
# Pre-tokens of more bytes are not kept (and are rare).
LONG_PIECE = 200

_SPACE, _LETTER, _NUMBER, _OTHER = 1, 2, 3, 4


def _classes() -> np.ndarray:
    """Classes of the code points below 0x250: white space, letter, number, other."""
    import regex

    kinds = np.full(0x250, _OTHER, np.uint8)
    for code in range(0x250):
        character = chr(code)
        if regex.fullmatch(r"\s", character):
            kinds[code] = _SPACE
        elif regex.fullmatch(r"\p{L}", character):
            kinds[code] = _LETTER
        elif regex.fullmatch(r"\p{N}", character):
            kinds[code] = _NUMBER
    return kinds


class Encoder:
    """Encodes texts; one object per Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spelled = [re.escape(x.content.encode()) for x in self.library.get_added_tokens_decoder().values()]
        # Looks ahead only, so that a match across two texts hides none inside a text.
        self.added = re.compile(b"(?=" + b"|".join(spelled) + b")") if spelled else None
        self.kinds = _classes()
        self.line = self.library.encode("\n", add_special_tokens=False).ids[0]
        self._reset()

    def _reset(self) -> None:
        self.table = K.HashTable(16)
        self.ids = np.empty(1 << 16, np.int32)
        self.used = 0
        self.begin = np.zeros(1, np.int64)
        self.length = np.zeros(1, np.int64)

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        n = len(at) - 1
        lead = raw >= 0xC9  # from U+0240 on: left to the library
        odd = np.zeros(n, bool)
        if lead.any():
            odd[K.rows_of(np.flatnonzero(lead), at)] = True
        if self.added:
            marks = np.array([m.start() for m in self.added.finditer(raw.tobytes())], np.int64)
            odd[K.rows_of(marks, at)] = True
        if not odd.any():
            return self._encode_plain(raw, at)
        plain = np.flatnonzero(~odd)
        keep = K.spread(at[plain], at[plain + 1] - at[plain])
        sizes = np.zeros(n, np.int64)
        plain_at = np.concatenate([[0], np.cumsum(at[plain + 1] - at[plain])])
        flat, sizes[plain] = self._encode_plain(raw[keep], plain_at)
        texts = K.strings_of(raw, at[:-1][odd], at[1:][odd])
        whole = [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        sizes[odd] = [len(x) for x in whole]
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]), np.int32)
        out[K.spread((ends - sizes)[plain], sizes[plain])] = flat
        for row, ids in zip(np.flatnonzero(odd).tolist(), whole):
            out[ends[row] - len(ids) : ends[row]] = ids
        return out, sizes

    def _cut(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Starts of the pre-tokens, as the published pattern of the vocabulary cuts them."""
        n = len(raw)
        kind = self.kinds[raw]
        two = np.flatnonzero(raw >= 0xC2)  # leads of two-byte characters, the only longer ones here
        code = (raw[two].astype(np.int64) & 0x1F) << 6 | (raw[two + 1] & 0x3F)
        kind[two] = kind[two + 1] = self.kinds[code]
        follow = np.zeros(n + 1, bool)
        follow[two + 1] = True
        head = np.zeros(n + 1, bool)
        head[at[:-1]] = True
        head[n] = True
        start = head.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        # One space before a letter, number or other run belongs to that run.
        space = kind == _SPACE
        run = np.flatnonzero(start[:n] & ~space & ~head[:n])
        run = run[space[run - 1]]
        before = run - 1 - follow[run - 1]
        blank = raw[before] == 32
        start[run[blank]] = False
        start[before] = True  # else the last white-space character stands alone
        # Contractions: a lone apostrophe, not after a space, and the letters after it.
        mark = np.flatnonzero((raw == 39) & start[:n])
        mark = mark[mark + 1 < n]
        mark = mark[(kind[mark + 1] == _LETTER) & ~head[mark + 1]]
        if len(mark):
            one = raw[mark + 1]
            room = (mark + 2 < n) & ~head[np.minimum(mark + 2, n)]
            second = np.where(room, raw[np.minimum(mark + 2, n - 1)], 0)
            single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            double = ((one == 114) | (one == 118)) & (second == 101) | (one == 108) & (second == 108)
            short = mark[single | double]
            start[short + 1] = False
            start[short + 2 + double[single | double]] = True
        return np.flatnonzero(start)

    def _encode_plain(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(at) - 1
        if len(raw) == 0:
            return np.empty(0, np.int32), np.zeros(rows, np.int64)
        edges = self._cut(raw, at)
        starts, ends = edges[:-1], edges[1:]
        keys = K.span_hashes(raw, starts, ends)
        if self.table.size > TABLE_LIMIT:
            self._reset()
        found = self.table.find(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            self._learn(new, K.strings_of(raw, starts[where], ends[where]))
            found[missing] = self.table.find(keys[missing])
        lengths = self.length[found]
        ids = self.ids[K.spread(self.begin[found], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        bounds = before[np.searchsorted(starts, at)]
        return ids, np.diff(bounds)

    def _ask(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single pre-tokens. Those without white space are asked for by the line: a line
        break never joins a neighbour, and its id is in no other pre-token."""
        sizes = np.zeros(len(pieces), np.int64)
        parts: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        lines = [i for i, piece in enumerate(pieces) if not piece.isspace()]
        for first in range(0, len(lines), 100):
            some = lines[first : first + 100]
            joined = "\n".join(pieces[i] for i in some)
            ids = np.array(self.library.encode(joined, add_special_tokens=False).ids, np.int32)
            for i, part in zip(some, np.split(ids, np.flatnonzero(ids == self.line)), strict=True):
                parts[i] = part[1:] if i != some[0] else part
        for i, piece in enumerate(pieces):
            if piece.isspace():
                parts[i] = np.array(self.library.encode(piece, add_special_tokens=False).ids, np.int32)
            sizes[i] = len(parts[i])
        return np.concatenate(parts), sizes

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        flat, sizes = self._ask(pieces)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(len(self.ids), np.int32)])
        self.ids[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(sizes) - sizes
        kept = self.table.size
        self.table.insert(keys)
        while self.table.size > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(len(self.begin), np.int64)])
            self.length = np.concatenate([self.length, np.zeros(len(self.length), np.int64)])
        self.begin[kept : self.table.size] = begin
        self.length[kept : self.table.size] = sizes
        self.used += len(flat)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_column(column: pa.Array, path: str, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids with the end id after each text, ids per text) for parts of a batch."""
    own = encoder(path)
    for first, end, raw, at in K.slices(column):
        ids, sizes = own.encode(raw, at)
        ends = np.cumsum(sizes + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        out[ends - 1] = end_id
        out[K.spread(ends - sizes - 1, sizes)] = ids
        yield first, end, out, sizes + 1
