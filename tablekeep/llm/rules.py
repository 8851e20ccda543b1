"""Quality rules by compression bands: zstandard ratios over whole documents and fixed chunks.

Text that repeats itself compresses far better than prose of its length, noise far worse. How well prose compresses
depends on its length, so each band of lengths has its own limits. Chunks find a long document that is only in part so;
the last chunk is the last ``CHUNK_BYTES`` bytes, so that none are left over. A shorter text is a chunk of its own length,
and meets the limits of that length as a whole.

Defined cases: a null text has no words; a text under 50 words fails; texts are measured whole; rows are independent, so
repeated rows and null ``doc_id`` give equal rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Band:
    """Limits of compressed bytes per byte for texts of at least ``least`` bytes."""

    least: int
    low: float
    high: float


BANDS = (
    Band(0, 0.0, 9.0),
    Band(128, 0.38, 1.10),
    Band(256, 0.38, 1.00),
    Band(512, 0.38, 0.90),
    Band(1024, 0.36, 0.80),
    Band(2048, 0.34, 0.75),
    Band(4096, 0.31, 0.72),
    Band(16384, 0.27, 0.70),
    Band(65536, 0.22, 0.70),
)
LEVEL = 3
CHUNK_BYTES = 4096
CHUNK_LOW, CHUNK_HIGH = 0.25, 0.80
# A document fails when more than this share of its chunks does. Of the clean documents of sf0.1 (label 1, from 4096 bytes:
# 560 with 1,368 chunks, the last ones among them) no chunk is out of limits; all have ratios of 0.443 to 0.483.
CHUNK_SHARE = 0.05
LEAST_WORDS = 50
REPEAT_PERCENT = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, low_chunks long, high_chunks long, n_chunks long, n_bytes long"
)


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    many = len(ids)
    pairs = a[:-1] * many + a[1:]
    if many >= 1 << 21:  # three ids would not fit in 63 bits
        _, pairs = np.unique(pairs, return_inverse=True)
    _, place, number = np.unique(pairs[:-1] * many + a[2:], return_inverse=True, return_counts=True)
    again = number[place] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def measured(text: str) -> tuple[int, ...]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    data = text.encode()
    words = data.split()
    blanks = len(data) - len(data.translate(None, SPACE))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeat_words(words)


def compressed(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, int]:
    """The whole text's ratio, and how many chunks are under, over, and there."""
    if not data:
        return 0.0, 0, 0, 0
    ratio = len(compressor.compress(data)) / len(data)
    begins = [*range(0, len(data) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    if begins and len(data) % CHUNK_BYTES:
        begins.append(len(data) - CHUNK_BYTES)
    ratios = [len(compressor.compress(data[at : at + CHUNK_BYTES])) / CHUNK_BYTES for at in begins]
    return ratio, sum(r < CHUNK_LOW for r in ratios), sum(r > CHUNK_HIGH for r in ratios), len(ratios)


def measure(docs: DataFrame) -> DataFrame:
    schema = pa.schema([(n, pa.float64() if n == "ratio" else pa.int64()) for n in (f.split()[0] for f in OUT.split(", "))])

    def of(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = value.as_py()
                data = text.encode()
                rows.append((doc_id, *measured(text), *compressed(data, compressor), len(data)))
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return doc_texts(docs).mapInArrow(of, OUT)


def judged(docs: DataFrame, bands: tuple[Band, ...] = BANDS) -> DataFrame:
    """Measures, ``base_failed``, ``kept``, and the ratios behind it, for every document."""
    out_of_band = F.lit(False)
    for band, above in zip(bands, [*bands[1:], None]):
        inside = F.col("n_bytes") >= band.least
        if above is not None:
            inside &= F.col("n_bytes") < above.least
        out_of_band |= inside & ((F.col("ratio") < band.low) | (F.col("ratio") > band.high))
    chunks = (F.col("low_chunks") + F.col("high_chunks")) > CHUNK_SHARE * F.col("n_chunks")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    found = measure(docs).withColumn("base_failed", base)
    return found.select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & ~out_of_band & ~chunks).alias("kept"), "ratio", "low_chunks", "high_chunks", "n_chunks"
    )
