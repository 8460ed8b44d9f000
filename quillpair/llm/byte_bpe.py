"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokens are found without a regular expression. Each code point has a class (letter, number, white space, other;
from the Unicode categories), and with the class of its successor one of eight symbols; the first code point of a
text has a variant that starts anew. A small automaton reads the symbols: its state is the kind of the open
pre-token, and a transition says whether a new one begins. Transition functions compose associatively, so texts laid
end to end are cut into columns: every column composes its functions for all states at once, the columns' functions
are combined by doubling, and from its now known first state each column emits its boundaries.

The boundaries are turned into byte offsets and slices; a slice's ids come from a store of merged slices or, when it
is new, from merging its pairs by rank. Token offsets stay with the ids and place each token's bytes in decoding.

A null id counts as -1, null text as empty: no ids, no bytes. Repeated ids are separate rows. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts
from .worker import kept

#: Code points of one pass; a longer text is a pass of its own.
PASS_CHARS = 1 << 20
#: Steps of one column of the scan.
STEPS = 128
#: Slices kept per worker; when full, the store starts anew.
KEEP = 1 << 18
#: From this many bytes on pairs are merged through a heap.
LONG = 96

# Classes, symbols and states of the automaton. LAST/INNER: white space before a non-space, or before more white
# space or the end. ONE/TWO: an apostrophe with one or two letters that form a contraction ('s 't 'm 'd, 're 've 'll).
LETTER, NUMBER, OTHER, SPACE, BLANK = range(5)
S_LETTER, S_NUMBER, S_OTHER, S_SPACE_LAST, S_BLANK_LAST, S_INNER, S_ONE, S_TWO = range(8)
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_SPACE, LETTER_LEFT, LETTERS_LEFT = range(8)
WHITE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
         0x3000]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a pre-token begins at this symbol)."""
    if symbol == S_LETTER:
        if state in (LETTER_LEFT, LETTERS_LEFT):  # of a contraction
            return (FREE if state == LETTER_LEFT else LETTER_LEFT), False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if symbol in (S_ONE, S_TWO) and state not in (IN_OTHERS, AFTER_SPACE):
        return (LETTER_LEFT if symbol == S_ONE else LETTERS_LEFT), True
    if symbol in (S_OTHER, S_ONE, S_TWO):
        return IN_OTHERS, state not in (IN_OTHERS, AFTER_SPACE)
    if symbol == S_SPACE_LAST:
        return AFTER_SPACE, True
    if symbol == S_BLANK_LAST:
        return FREE, True
    return IN_SPACES, state != IN_SPACES


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each code point; next state and boundary by 8 * symbol + state (symbols from 8: a text begins)."""
    return kept("bpe-tables", _make_tables)


def _make_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds = {"L": LETTER, "N": NUMBER}
    cls = np.array([kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)], np.uint8)
    cls[WHITE] = BLANK
    cls[0x20] = SPACE
    steps = [_step(FREE if symbol >= 8 else state, symbol % 8) for symbol in range(16) for state in range(8)]
    return cls, np.array([s for s, _ in steps], np.uint8), np.array([b for _, b in steps], bool)


def _symbols(cp: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Automaton symbols of code points laid end to end; begins: where the (non-empty) texts start."""
    cls = _tables()[0][cp]
    white = cls >= SPACE
    first = np.zeros(len(cp) + 2, bool)
    first[begins] = True
    first[len(cp):] = True
    ends = first[1:-1]  # the next place begins a text
    before_word = np.zeros(len(cp), bool)
    before_word[:-1] = ~white[1:]
    before_word &= ~ends
    sym = np.where(white, np.where(before_word, cls, S_INNER), cls).astype(np.uint8)
    quote = np.flatnonzero((cp == 39) & ~ends)
    if len(quote):
        one = cp[quote + 1]
        two = np.where(first[quote + 2], 0, cp[np.minimum(quote + 2, len(cp) - 1)])
        sym[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_ONE
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        sym[quote[pair]] = S_TWO
    sym[begins] += 8
    return sym


def boundaries(cp: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places where pre-tokens begin."""
    _, go, cut = _tables()
    sym = _symbols(cp, begins)
    cols = -(-len(sym) // STEPS)
    rows = np.full(cols * STEPS, S_INNER, np.uint8)
    rows[:len(sym)] = sym
    rows = np.ascontiguousarray(rows.reshape(cols, STEPS).T) << 3
    f = np.tile(np.arange(8, dtype=np.uint8), (cols, 1))  # each column's transition function, so far the identity
    for row in rows:
        f = go[row[:, None] + f]
    shift = 1
    while shift < cols:  # inclusive scan by doubling: f[i] becomes the composition of columns 0..i
        f[shift:] = np.take_along_axis(f[shift:], f[:-shift].astype(np.intp), 1)
        shift *= 2
    state = np.concatenate([[FREE], f[:-1, FREE]]).astype(np.uint8)
    out = np.empty((STEPS, cols), bool)
    for t, row in enumerate(rows):
        at = row + state
        out[t] = cut[at]
        state = go[at]
    return np.flatnonzero(out.T.reshape(-1)[:len(sym)])


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank, leftmost first, is merged until none is known."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) >= LONG:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = len(ranks) + 1_000_000
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same through a heap of pairs, n log n for slices of any length."""
    n = len(piece)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if (r := right[i]) < n and (rank := ranks.get(piece[i:end[r]])) is not None:
            heapq.heappush(heap, (rank, i, end[r]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        r = right[i] if end[i] else n
        if r >= n or end[r] != to:  # one side has changed since
            continue
        end[i], right[i], end[r] = to, right[r], 0
        if right[r] < n:
            left[right[r]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = right[i]
    return out


class ByteBpe:
    """Encoder and decoder for a file of ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.known: dict[bytes, bytes] = {}
        self.size = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for token, rank in self.ranks.items():
            self.size[rank] = len(token)
        self.place = np.cumsum(self.size) - self.size
        self.bytes = np.empty(int(self.size.sum()), np.uint8)
        for token, rank in self.ranks.items():
            self.bytes[self.place[rank]:self.place[rank] + len(token)] = np.frombuffer(token, np.uint8)

    @classmethod
    def of(cls, path: str) -> "ByteBpe":
        """One per Python worker and path."""
        return kept(("bpe", path), lambda: cls(path), large=True)

    def _ids(self, pieces: list[bytes]) -> bytes:
        known = self.known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            new = set(pieces).difference(known)
            if len(known) + len(new) > KEEP:
                known.clear()
                new = set(pieces)
            known.update((p, np.array(merge_pairs(p, self.ranks), "<u4").tobytes()) for p in new)
            return b"".join(map(known.__getitem__, pieces))

    def encode(self, docs: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        whole = "".join(docs)
        if not whole:
            return [np.empty(0, "<u4")] * len(docs)
        cp = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        lens = np.array([len(d) for d in docs])
        begins = np.cumsum(lens) - lens
        at = boundaries(cp, begins[lens > 0])
        of_doc = np.searchsorted(at, np.append(begins, len(cp)))
        raw = whole.encode()
        if len(raw) > len(cp):  # places in code points to places in bytes
            width = 1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)
            at = (np.cumsum(width, dtype=np.int64) - width)[at]
        cuts = [*at.tolist(), len(raw)]
        pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return [np.frombuffer(self._ids(pieces[a:b]), "<u4") for a, b in zip(of_doc[:-1], of_doc[1:])]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in its text."""
        size = self.size[ids]
        return np.cumsum(size) - size

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The text's bytes: each token's bytes are put at its offset."""
        size, offsets = self.size[ids], offsets.astype(np.int64)
        total = int(offsets[-1] + size[-1]) if len(ids) else 0
        out = np.empty(total, np.uint8)
        source = np.arange(total) + np.repeat(self.place[ids] - offsets, size)
        np.take(self.bytes, source, out=out)
        return out.tobytes()


def _passes(column: pa.Array) -> Iterator[list[str]]:
    held: list[str] = []
    n = 0
    for t in column:
        s = t.as_buffer().to_pybytes().decode("utf-8", "replace")
        if held and n + len(s) > PASS_CHARS:
            yield held
            held, n = [], 0
        held.append(s)
        n += len(s)
    if held:
        yield held


def bpe_encode(df: DataFrame, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, offsets): ids as little-endian 32-bit integers, offsets in bytes alike, in binary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(ranks)
        for batch in batches:
            at = 0
            for docs in _passes(batch.column(1)):
                ids = bpe.encode(docs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(docs)), pa.array([x.tobytes() for x in ids], pa.binary()),
                     pa.array([bpe.offsets(x).astype("<u4").tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "ids", "offsets"])
                at += len(docs)
    return texts(df, key, text).mapInArrow(run, "doc_id bigint, ids binary, offsets binary")


def bpe_decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(ranks)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                out = [bpe.decode(np.frombuffer(i.as_buffer(), "<u4"), np.frombuffer(o.as_buffer(), "<u4"))
                       for i, o in zip(part.column(1), part.column(2))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())],
                                                 names=["doc_id", "ids", "decoded"])
    return encoded.select("doc_id", "ids", "offsets").mapInArrow(run, "doc_id bigint, ids binary, decoded binary")
