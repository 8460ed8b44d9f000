"""TextRank over whole Arrow batches of texts (E6, H19, J1), to convergence or for fixed steps.

All edges of a text come from its own row, so nothing is shuffled: the graphs
of a slice of texts are one block-diagonal sparse matrix, and a step of the
power iteration is one weighted count over its edges. A text whose ranks
change by less than the tolerance keeps them and leaves; when half of the
edges have left, the rest is packed. Words, content words and ties are those
of ``keywords``; its relational form gives the same ranks.

Null and empty texts have no words. Rows are independent of each other, so
repeated ids are ranked each. A slice holds about SLICE_WORDS words, or one
text, which is a row and so one task's work in any form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import resources as R
from .keywords import ITERATIONS, _is_content, power_iteration, text_words

SLICE_WORDS = 200_000
#: Limits of a search to convergence.
TOLERANCE, MOST_STEPS = 1e-4, 100


def _content_words(text: Column | str) -> Column:
    """The text's words in order, "" for those that are no nodes."""
    return F.transform(text_words(text), lambda x: F.when(_is_content(x), x).otherwise(F.lit("")))


class _Slice:
    """Nodes, ranks and kept words of some texts given as a list array of words."""

    def __init__(self, words: pa.Array, ratio: float, steps: int, damping: float, tolerance: float | None):
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(words.flatten())
        self.names = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        content = np.array([bool(w) for w in self.names], bool)[code] if len(code) else np.zeros(0, bool)
        text = np.repeat(np.arange(len(sizes)), sizes)
        near = content[:-1] & content[1:] & (text[:-1] == text[1:]) & (code[:-1] != code[1:])
        key = text * max(len(self.names), 1) + code
        a, b = np.flatnonzero(near), np.flatnonzero(near) + 1
        nodes, inverse = np.unique(np.concatenate([key[a], key[b]]), return_inverse=True)
        x, y = inverse[:len(a)], inverse[len(a):]
        pair = np.unique(np.minimum(x, y) * max(len(nodes), 1) + np.maximum(x, y))
        lo, hi = pair // max(len(nodes), 1), pair % max(len(nodes), 1)
        self.text, self.code = nodes // max(len(self.names), 1), nodes % max(len(self.names), 1)
        rank = power_iteration(np.concatenate([lo, hi]), np.concatenate([hi, lo]), self.text, len(sizes), steps,
                               damping, tolerance)
        self.score = np.floor(rank * 1e6 + 0.5) / 1e6
        place = np.empty(len(self.names), np.int64)
        place[sorted(range(len(self.names)), key=self.names.__getitem__)] = np.arange(len(self.names))
        order = np.lexsort((place[self.code], -self.score, self.text))
        starts = np.searchsorted(self.text[order], np.arange(len(sizes) + 1))
        number = np.arange(len(order)) - starts[self.text[order]]
        most = np.floor(ratio * np.diff(starts))
        kept = number < most[self.text[order]]
        self.kept, self.rank = order[kept], number[kept] + 1
        self.sizes, self.key, self.first = sizes, key, np.cumsum(sizes) - sizes

    def phrases(self) -> list[str]:
        """The keyword string of each text: kept words at their first places, neighbours as one phrase, of a phrase at
        the text's end its last word; phrases by falling mean score, then place."""
        wanted = np.unique(self.text[self.kept] * max(len(self.names), 1) + self.code[self.kept], return_index=True)
        at = np.flatnonzero(np.isin(self.key, wanted[0]))
        found, first = np.unique(self.key[at], return_index=True)
        place = at[first]
        score = self.score[self.kept][wanted[1]]
        order = np.argsort(place)
        out: list[list] = [[] for _ in self.sizes]
        last, run = -2, None
        for p, k, s in zip(place[order].tolist(), found[order].tolist(), score[order].tolist()):
            text, word = divmod(k, len(self.names))
            pos = p - int(self.first[text])
            if run is None or p != last + 1 or run[3] != text:
                run = [[], [], pos, text]
                out[text].append(run)
            run[0].append(self.names[word])
            run[1].append(s)
            last = p
        return [self._joined(runs, int(n)) for runs, n in zip(out, self.sizes)]

    @staticmethod
    def _joined(runs: list, n: int) -> str:
        parts = []
        for words, scores, pos, _ in runs:
            if pos + len(words) == n:
                pos, words, scores = n - 1, words[-1:], scores[-1:]
            parts.append((-round(sum(scores) / len(scores), 9), pos, " ".join(words)))
        return " ".join(p[2] for p in sorted(parts))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a slice holds SLICE_WORDS words, or one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > first and held + n > SLICE_WORDS:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += n
        if batch.num_rows > first:
            yield batch.slice(first)


def textrank_top(df: DataFrame, id_col: str, text_col: str, ratio: float = R.KEYWORD_RATIO, steps: int = ITERATIONS,
                 damping: float = R.TEXTRANK_DAMPING, tolerance: float | None = None) -> DataFrame:
    """(id, rank, word, score): TextRank's kept words per text. With a tolerance, ``steps`` is the most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            s = _Slice(batch.column(1), ratio, steps, damping, tolerance)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(s.text[s.kept])), pa.array(s.rank, pa.int64()),
                 pa.array([s.names[c] for c in s.code[s.kept].tolist()], pa.string()), pa.array(s.score[s.kept])],
                names=[id_col, "rank", "word", "score"])
    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, _content_words(text_col).alias("_w")).mapInArrow(
        run, f"{id_col} {kind}, rank bigint, word string, score double")


def keywords(df: DataFrame, id_col: str, text_col: str, ratio: float = R.KEYWORD_RATIO, steps: int = ITERATIONS,
             damping: float = R.TEXTRANK_DAMPING, tolerance: float | None = None) -> DataFrame:
    """(id, keywords): the keyword string of every row, empty when the text has no edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            s = _Slice(batch.column(1), ratio, steps, damping, tolerance)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.phrases(), pa.string())],
                                             names=[id_col, "keywords"])
    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, _content_words(text_col).alias("_w")).mapInArrow(run, f"{id_col} {kind}, keywords string")
