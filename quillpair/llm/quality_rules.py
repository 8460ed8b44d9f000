"""Quality rules: word and line statistics, then zstandard compression bands.

A text's compression ratio (compressed / raw UTF-8 bytes) shows repetition (low) and noise (high). The ratio depends
on length: a short text carries the frame header and has little history. So the limits come in bands by length, and
they are applied to the whole text and to each fixed chunk of it. A text is rejected when its whole ratio leaves its
band, or when over a quarter of its chunks leave theirs: a long document whose parts are each fine but which repeats
itself fails the first test, one with long stretches of noise in good prose fails the second.

A null id counts as -1, null text as one without words; an empty text has no ratio and fails the base rule (under 50 words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import texts

#: (bytes from, lowest ratio, highest ratio). Highest ratios lie above clean prose at level 3: the 8,884 documents of
#: sf0.1 that pass the base rules (at most 0.75 at 256 bytes, 0.64 at 768, 0.59 at 1 kB, 0.52 at 2 kB, 0.48 at 4 kB,
#: 0.43 at 16 kB) and 99 % of the pieces of real manuals in Latin, Cyrillic and Greek script (0.84 at 300 bytes, 0.72 at
#: 600, 0.64 at 1.1 kB, 0.58 at 2.1 kB, 0.55 at 4 kB, 0.51 at 9 kB, 0.49 at 17 kB). Random base64 (0.72 and more) is above them from 256 bytes, random letters and digits (0.64-0.66) from
#: 1.5 kB, random letters (0.58-0.60) from 2 kB, random hex (0.51-0.53) from 8 kB; below these sizes clean prose has the
#: same ratios. One repeated line is below 0.1.
BANDS = ((0, 0.0, 99.0), (64, 0.45, 1.25), (128, 0.40, 1.05), (256, 0.38, 0.86), (384, 0.38, 0.81),
         (512, 0.38, 0.76), (768, 0.38, 0.71), (1024, 0.33, 0.66), (1536, 0.33, 0.62), (2048, 0.33, 0.59),
         (3072, 0.33, 0.57), (4096, 0.30, 0.55), (8192, 0.30, 0.52), (16384, 0.26, 0.495))
#: Added to the highest ratio of texts with at least a quarter of their bytes outside ASCII: Chinese, Japanese and Korean
#: prose is denser (0.81 at 600 bytes, 0.59 at 2.1 kB), and so is their noise (random ideographs 0.72 and more).
WIDE_MORE = 0.06
CHUNK_BYTES = 4096
CHUNK_SHARE = 0.25
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACE = b" \t\n\r\x0b\x0c"
_NOT_A_CHAR = _SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
_ASCII = bytes(range(0x80))
_SYMBOLS = b"#*$%&|<>"
_FROM = np.array([b[0] for b in BANDS])

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, n_chunks bigint, "
          "n_bad_chunks bigint")


def in_band(ratio: float, size: int, wide: bool) -> bool:
    _, low, high = BANDS[int(np.searchsorted(_FROM, size, "right")) - 1]
    return low <= ratio <= high + WIDE_MORE * wide


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known = dict(zip(dict.fromkeys(words), range(n)))
    ids = np.fromiter(map(known.__getitem__, words), np.int64, n)
    size = len(known)
    pair = ids[:-1] * size + ids[1:]
    if size > 2_000_000:  # the product of three ids would pass 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, counts = np.unique(pair[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= twice
    return int(hit.sum())


def bands(zstd: zstandard.ZstdCompressor, raw: bytes, wide: bool) -> tuple[float | None, int, int]:
    """Whole ratio, chunks, chunks outside their band."""
    if not raw:
        return None, 0, 0
    ratio = len(zstd.compress(raw)) / len(raw)
    if len(raw) <= CHUNK_BYTES:
        return ratio, 1, int(not in_band(ratio, len(raw), wide))
    chunks = [raw[a:a + CHUNK_BYTES] for a in range(0, len(raw), CHUNK_BYTES)]
    bad = sum(not in_band(len(zstd.compress(c)) / len(c), len(c), wide) for c in chunks)
    return ratio, len(chunks), bad


def judge(zstd: zstandard.ZstdCompressor, raw: bytes) -> tuple:
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, repeats = len(words), repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    wide = not raw.isascii() and 4 * len(raw.translate(None, _ASCII)) >= len(raw)
    ratio, chunks, bad = bands(zstd, raw, wide)
    fine = ratio is not None and in_band(ratio, len(raw), wide) and bad <= CHUNK_SHARE * chunks
    return (n, len(raw.translate(None, _NOT_A_CHAR)), len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeats, failed, not failed and fine, ratio, chunks, bad)


def _judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        if batch.num_rows:
            rows = [judge(zstd, t.as_buffer().to_pybytes()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=names)


def keep_quality(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of df, all columns, that quality_rules keeps; a decision is its own row's, whatever its id."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            kept = [t.is_valid and judge(zstd, t.as_buffer().to_pybytes())[6] for t in batch.column(at)]
            yield batch.filter(pa.array(kept, pa.bool_()))
    return df.mapInArrow(run, df.schema)


def quality_rules(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the statistics, base_failed, kept, and the ratio behind the verdict."""
    return texts(df, key, text).mapInArrow(_judge_batches, SCHEMA)
