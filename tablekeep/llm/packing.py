"""Sequence packing by shortest-pack-first over the histogram of piece lengths.

Documents are tokenised and cut into full pieces and a rest. Only the histogram of lengths (one row per possible length)
reaches the driver. There, lengths are placed longest first, each into the shortest pack that has room; packs of equal
filling are kept as one pattern with a count, and a pattern is split where only part of it takes the next length. The
placements (length, ranks from - to, first sequence, offset) are then joined to the pieces by length and rank.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each for itself; null ``doc_id`` is
kept; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts, ranked, settled
from tablekeep.llm.tokens import ByteLevelEncoder
from tablekeep.session import Workspace

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
END = 1


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int = END) -> DataFrame:
    """Tokenise every text, add the end id, cut it into pieces of ``capacity`` ids and a rest.

    ``ids`` are little-endian unsigned 32-bit integers. Rows are given out document by document, so a long one is never
    held more than once.
    """
    out_type = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "doc_tokens")), ("ids", pa.binary())])

    def cut(batches):
        encoder = ByteLevelEncoder(tokenizer)
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, start, len(part), len(ids), part.tobytes()))
                held += len(ids)
                if held > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out_type)], schema=out_type)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out_type)], schema=out_type)

    return doc_texts(docs).mapInArrow(cut, PIECES)


def place_lengths(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Placements ``(length, first rank, first sequence, number, offset)`` of all lengths of the histogram.

    An entry of ``patterns`` is a run of consecutive sequences filled alike. The work and the number of placements depend
    on the number of lengths, not on that of the pieces.
    """
    patterns: list[tuple[int, int, int]] = []  # a heap: (filled so far, first sequence, number of sequences)
    out: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        changed = []
        while left:
            # The heap's first pattern is the shortest: if it has no room, none has.
            if patterns and patterns[0][0] + length <= capacity:
                filled, first, number = heapq.heappop(patterns)
                taken = min(left, number)
                if taken < number:
                    heapq.heappush(patterns, (filled, first + taken, number - taken))
            elif changed:
                # Packs that took this length already come next, as any other.
                for pattern in changed:
                    heapq.heappush(patterns, pattern)
                changed = []
                if patterns[0][0] + length <= capacity:
                    continue
                filled, first, taken = 0, sequences, left
                sequences += taken
            else:
                filled, first, taken = 0, sequences, left
                sequences += taken
            out.append((length, rank, first, taken, filled))
            if filled + length < capacity:
                changed.append((filled + length, first, taken))
            rank += taken
            left -= taken
        for pattern in changed:
            heapq.heappush(patterns, pattern)
    return out


def assign_sequences(cut: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id, start, length`` and others); pieces are read twice, so they
    should be a written table. All columns but binary ones decide the order among pieces of one length."""
    spark = cut.sparkSession
    # At most one row per possible length.
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placed = spark.createDataFrame(
        place_lengths(histogram, capacity), "p_length long, first_rank long, first_sequence long, number long, offset long"
    )
    order = ["doc_id", "start", *(c for c, kind in cut.dtypes if kind != "binary" and c not in ("doc_id", "start", "length"))]
    ranks = ranked(cut, "length", order, "__rank")
    within = F.col("__rank") - F.col("first_rank")
    # Placements are bounded by the number of lengths, whatever the corpus.
    met = ranks.join(F.broadcast(placed), (F.col("length") == F.col("p_length")) & (within >= 0) & (within < F.col("number")))
    return met.select(*cut.columns, (F.col("first_sequence") + within).alias("sequence_id"), "offset")


def pack(docs: DataFrame, tokenizer: str, ws: Workspace, capacity: int = 2048) -> DataFrame:
    """Pieces with their ids and places: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``."""
    return assign_sequences(settled(pieces(docs, tokenizer, capacity), ws, "pieces"), capacity)


def pack_digests(docs: DataFrame, tokenizer: str, ws: Workspace, capacity: int = 2048) -> DataFrame:
    """As ``pack``, with the CRC of a piece's ids in place of the ids, so that no ids are shuffled."""
    written = settled(pieces(docs, tokenizer, capacity), ws, "pieces")
    digests = written.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return assign_sequences(digests, capacity)
