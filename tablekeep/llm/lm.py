"""Language-model scores from an Elias-Fano n-gram trie.

Level one holds every word of the training texts: its 64-bit hash in an Elias-Fano sequence, its count, and a monotone
sequence of how many tokens come before it. Level two holds, for each word, the words that followed it, as one Elias-Fano
sequence of (context, word id) with monotone pointers, and a quantised smoothed probability each. Level three holds, for
each bigram, the words that followed it, by their ranks among the successors of the bigram's second word; ranks of one
context are made to follow those of the context before, so that they too are one Elias-Fano sequence. A query finds the
words in level one, takes the context's pointers, and searches for the successor between them.

The model has absolute discounting and is interpolated with the level below: p(w|c) = (n - D)/c(c) + b(c) p(w|shorter c),
where b(c) is what the n-grams of c leave over, so p sums to one. p(w) is the base model. An n-gram with an unknown word is
not looked up. Every bigram and trigram of the training texts is kept.

Only level one, which grows with the vocabulary, is at hand in every task: fetched once per executor and memory-mapped.
Levels two and three are cut into units, and n-grams come to them: a text's task sends each of its trigrams to the unit that
answers it, which sends back a sum per document. A unit is a stretch of the line of all training tokens in order of their
ids. A word owns as much of that line as it has tokens, and a trigram's place in its middle word's stretch is given by a
hash of its first word, so a common word lies in as many units as its share of the tokens asks for; its list of successors,
at most the vocabulary, goes to each. A unit with more tokens than its share (a common pair) is copied, and documents are
dealt over the copies. Each level is counted by one exchange, of n-grams counted per task before it.

Defined cases: a null or empty text is its end token alone; repeated rows count as often as they occur; a null ``doc_id``
hashes as empty text (held out); without training texts every score is 0; an empty table gives an empty table; other
columns are ignored; a text of many megabytes ends the group of texts that its
task holds at once. Two words of one hash (about V squared /
2^65 such pairs) count as one. More than 2^32 - 1 distinct words raise ``OverflowError``.
"""

from __future__ import annotations

import fcntl
import gc
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import zstandard
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts, partitions, settled
from tablekeep.llm.eliasfano import EliasFano, packed, unpacked
from tablekeep.session import Workspace, delete_folder

FOLDS = 10
ADDED = 0.1
DISCOUNT = 0.75
# Bytes whose words are hashed at once (8 bytes of numbers for each of them), bytes of the texts that are put together, and
# tokens of the texts that are looked up together.
HASHED = 1 << 18
STRETCH = 1 << 21
GROUP_TOKENS = 1_000_000
# N-grams of a group, or of a unit, that are sorted or answered together: their columns and keys are what takes memory.
SORTED = 1 << 18
# The first word of a trigram that has none: of the second token of a text, or after an unknown word.
NO_WORD = (1 << 32) - 1
FLUSH_WORDS = 600_000
CODES = 256
LOWEST_LOG = -12.0


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


# ---- tokens as hashes
#
# A word's hash is a polynomial over its bytes (A-Z in lower case), modulo 2^64, whose coefficients are a table of random
# numbers, with its bits mixed at the end. Sums over a stretch of bytes give the hashes of all its words at once.


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 11
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_BYTES[65:91] = _BYTES[97:123]
# Where no byte of a word can be.
_BYTES[_BLANK] = 0
# Of the end token, which no word is.
END = np.uint64(0x5EED0FE7D)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` to the powers 0, 1, ... below ``_STEP``, and to the multiples of ``_STEP`` below ``n``, modulo 2^64."""

    def run(b: int, k: int) -> np.ndarray:
        factors = np.full(k, b, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return run(base, _STEP), run(pow(base, _STEP, 1 << 64), -(-n // _STEP) + 1)


def _power(base: int, at: np.ndarray, n: int) -> np.ndarray:
    low, high = _powers(base, n)
    return low[at & (_STEP - 1)] * high[at >> 11]


def _word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in a stretch of bytes, and where each begins; a word also ends where another text begins."""
    inside = ~_BLANK[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first = begins[begins < len(data)]
    start[first] = inside[first]
    last = first[first > 0] - 1
    end[last] = inside[last]
    start, end = np.flatnonzero(start), np.flatnonzero(end)
    size = 1 << max(16, len(data).bit_length())
    low, high = _powers(BASE, size)
    sums = (high[: -(-len(data) // _STEP), None] * low).ravel()[: len(data)]
    sums *= _BYTES[data]
    np.cumsum(sums, out=sums)
    word = sums[end] - np.where(start > 0, sums[start - 1], np.uint64(0))
    # As if each word began at the first byte.
    word *= _power(pow(BASE, -1, 1 << 64), start, size)
    return _mixed(word ^ ((end - start).astype(np.uint64) << np.uint64(40))), start


def _stretches_of(data: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut bytes into stretches of some ``HASHED`` bytes, each of which ends after a blank or with a text."""
    at, step = 0, min(HASHED, STRETCH)
    while at < len(data):
        end = min(at + step, len(data))
        while end < len(data):
            blanks = np.flatnonzero(_BLANK[data[at:end]])
            texts = begins[np.searchsorted(begins, at, "right") : np.searchsorted(begins, end, "right")]
            cut = max(at + int(blanks[-1]) + 1 if len(blanks) else at, int(texts[-1]) if len(texts) else at)
            if cut > at:
                end = cut
                break
            # One word beyond a stretch's size.
            end = min(end + step, len(data))
        yield at, end
        at = end


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of some texts, each text's end after its words, and how many tokens each text has."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = texts.buffers()[2]
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    begins = offsets[:-1] - offsets[0]
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in _stretches_of(data, begins):
        found, at = _word_hashes(data[a:b], begins[np.searchsorted(begins, a) : np.searchsorted(begins, b)] - a)
        hashes.append(found)
        starts.append(at + a)
    words, where = np.concatenate(hashes), np.concatenate(starts)
    # The words before the end of each text.
    before = np.searchsorted(where, offsets[1:] - offsets[0])
    out = np.insert(words, before, END)
    return out, np.diff(before, prepend=0) + 1


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of hash values, in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _split(keys: np.ndarray, counts: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Per bucket: keys (sorted within it) as compressed differences, and counts."""
    order = np.argsort(of, kind="stable")
    edges = np.flatnonzero(np.diff(of[order])) + 1
    write = zstandard.ZstdCompressor(level=1)
    for part in np.split(order, edges):
        if len(part):
            steps = np.diff(keys[part], prepend=np.uint64(0))
            yield int(of[part[0]]), write.compress(steps.tobytes()), write.compress(counts[part].astype("<u4").tobytes())


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a bucket once, sorted, with the sum of their counts."""
    read = zstandard.ZstdDecompressor()
    keys, counts = [], []
    for k, c in zip(table.column("keys"), table.column("counts")):
        keys.append(np.cumsum(np.frombuffer(read.decompress(k.as_py()), np.uint64), dtype=np.uint64))
        counts.append(np.frombuffer(read.decompress(c.as_py()), "<u4"))
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.diff(all_keys, prepend=all_keys[:1] + np.uint64(1)))
    return all_keys[first], np.add.reduceat(all_counts, first)


PARTS = "bucket int, keys binary, counts binary"
PARTS_SCHEMA = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _part_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    bucket, keys, counts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(keys), pa.array(counts)], ["bucket", "keys", "counts"])


def _grouped(batches, size: int = GROUP_TOKENS) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Texts' token hashes in groups of some ``size`` tokens, with the ids of the documents and their numbers of tokens."""
    ids, hashes, lengths, n = [], [], [], 0
    for batch in batches:
        texts = batch.column("text")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            # So many texts at once as have the bytes of a stretch, one at least.
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + STRETCH, "right")))
            found, each = token_hashes(texts.slice(at, stop - at))
            ids += batch.column("doc_id").slice(at, stop - at).to_pylist()
            hashes.append(found)
            lengths.append(each)
            n += len(found)
            at = stop
            if n >= size:
                yield _taken(ids, hashes, lengths)
                n = 0
    if ids:
        yield _taken(ids, hashes, lengths)


def _taken(ids: list, hashes: list[np.ndarray], lengths: list[np.ndarray]) -> tuple[list, np.ndarray, np.ndarray]:
    """A group in one piece each; the lists are empty then, so that whoever has the group has its only copy."""
    group = list(ids), np.concatenate(hashes), np.concatenate(lengths)
    for pieces in (ids, hashes, lengths):
        pieces.clear()
    return group


# ---- levels as files


@dataclass(frozen=True)
class Shipped:
    """A written level: names of its files among Spark's files, and a name for its flat copy on an executor."""

    files: tuple[str, ...]
    name: str


def ship(level: DataFrame, ws: Workspace, name: str) -> tuple[Shipped, DataFrame]:
    """Write ``bucket, block, ...`` rows to the shared folder and let every executor fetch the files."""
    spark = level.sparkSession
    written = settled(level, ws, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(ws.path(name))
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    paths = sorted(s.getPath().toString() for s in found if s.getPath().getName().endswith(".parquet"))
    for path in paths:
        spark.sparkContext.addFile(path)
    return Shipped(tuple(p.rsplit("/", 1)[1] for p in paths), uuid.uuid4().hex), written


@lru_cache(maxsize=4)
def _mapped(level: Shipped) -> dict[int, list[np.ndarray]]:
    """The blocks of a level by bucket, memory-mapped from this executor's flat copy (made by whoever comes first)."""
    flat = os.path.join(SparkFiles.getRootDirectory(), level.name)
    with open(flat + ".lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(flat):
            index = []
            with open(flat + ".part", "wb") as out:
                for name in level.files:
                    rows = pq.ParquetFile(SparkFiles.get(name)).iter_batches(1, columns=["bucket", "block"])
                    for row in rows:
                        block = row.column("block")[0].as_py()
                        index += [row.column("bucket")[0].as_py(), out.tell(), len(block)]
                        out.write(block)
            np.array(index, np.int64).tofile(flat + ".index")
            os.rename(flat + ".part", flat)
            # One copy per executor: an executor that takes this one's place fetches the files anew.
            for name in level.files:
                os.remove(SparkFiles.get(name))
    index = np.fromfile(flat + ".index", np.int64).reshape(-1, 3)
    if not len(index):
        return {}
    data = np.memmap(flat, np.uint8, "r")
    return {int(b): unpacked(data[at : at + n]) for b, at, n in index}


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what is settled: it does so for DataFrames that nothing refers to any more,
    whenever the driver's garbage collector comes by, so it is asked to. Spark holds on to its last query, hence another."""
    gc.collect()
    spark.range(1).collect()
    spark._jvm.System.gc()


# ---- level one


@dataclass(frozen=True)
class Vocabulary:
    """Level one as shipped, with how many words come before each bucket and the totals the base model needs."""

    level: Shipped
    buckets: int
    before: tuple[int, ...]
    mass_before: tuple[int, ...]
    words: int
    tokens: int

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word ids (-1: unknown) and counts (0: unknown)."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        blocks = _mapped(self.level)
        of = bucket_of(hashes, self.buckets)
        order = np.argsort(of, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            if not len(part) or int(of[part[0]]) not in blocks:
                continue
            bucket = int(of[part[0]])
            sequence, codes, table = blocks[bucket][:5], *blocks[bucket][5:7]
            at = EliasFano.from_arrays(sequence).find(hashes[part] - np.uint64(bucket_base(bucket, self.buckets)))
            known = at >= 0
            ids[part[known]] = self.before[bucket] + at[known]
            counts[part[known]] = table[codes[at[known]]]
        return ids, counts

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        ids = _wide(ids)
        blocks, out = _mapped(self.level), np.zeros(len(ids), np.int64)
        bucket = np.searchsorted(np.array(self.before), ids, side="right") - 1
        for b in np.unique(bucket).tolist():
            some = np.flatnonzero(bucket == b)
            codes, table = blocks[b][5:7]
            out[some] = table[codes[ids[some] - self.before[b]]]
        return out

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's tokens begin on the line of all training tokens, and how many they are."""
        ids = _wide(ids)
        blocks, begin = _mapped(self.level), np.zeros(len(ids), np.int64)
        bucket = np.searchsorted(np.array(self.before), ids, side="right") - 1
        for b in np.unique(bucket).tolist():
            some = np.flatnonzero(bucket == b)
            mass = EliasFano.from_arrays(blocks[b][7:12])
            begin[some] = self.mass_before[b] + mass.access(ids[some] - self.before[b]).astype(np.int64)
        return begin, self.counts_of(ids)

    def unit_at(self, point: np.ndarray) -> np.ndarray:
        """The unit of a place on the line."""
        # In floating point, as the product may have more than 64 bits; alike wherever it is asked for.
        return np.minimum((point * (self.buckets / max(1, self.tokens))).astype(np.int64), self.buckets - 1)

    def log_p(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.words + 1)))


def _share(ids: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each word, by a mix of the bits of its id."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def bucket_base(bucket: int, buckets: int) -> int:
    """The least hash of a bucket."""
    return (-(-(bucket << 32) // buckets)) << 32


def count_words(texts: DataFrame, ws: Workspace) -> Vocabulary:
    """Count all tokens of ``doc_id, text``: once per task and bucket before the shuffle, then once per bucket."""
    buckets = partitions(texts.sparkSession)

    def count(batches):
        held, n = [], 0
        for _, hashes, _ in _grouped(batches):
            codes, words = pd.factorize(hashes)
            held.append((words, np.bincount(codes)))
            n += len(words)
            if n > FLUSH_WORDS:
                yield _flushed(held)
                held, n = [], 0
        if held:
            yield _flushed(held)

    def _flushed(held):
        (hashes,), counts = _distinct([np.concatenate([h for h, _ in held])], np.concatenate([c for _, c in held]))
        return _part_batch(list(_split(hashes, counts, bucket_of(hashes, buckets))))

    def level(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        hashes, counts = _merged(table)
        base, above = bucket_base(bucket, buckets), bucket_base(bucket + 1, buckets)
        distinct, codes = np.unique(counts, return_inverse=True)
        codes = codes.astype(np.uint16 if len(distinct) <= 65536 else np.uint32)
        total = int(counts.sum())
        mass = EliasFano.of(np.cumsum(counts) - counts, total + 1).arrays()
        block = packed([*EliasFano.of(hashes - np.uint64(base), above - base).arrays(), codes, distinct, *mass])
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "words": [len(hashes)], "tokens": [total], "block": [block]})

    rows = texts.mapInArrow(count, PARTS).groupBy("bucket").applyInArrow(level, "bucket int, words long, tokens long, block binary")
    level_one, written = ship(rows, ws, "words")
    # A row per bucket, of which there are as many as shuffle partitions.
    sizes = {r["bucket"]: (r["words"], r["tokens"]) for r in written.select("bucket", "words", "tokens").collect()}
    each = np.array([sizes.get(b, (0, 0)) for b in range(buckets)], np.int64).reshape(-1, 2)
    words, tokens = (int(x) for x in each.sum(axis=0))
    if words >= NO_WORD:
        raise OverflowError("too many distinct words for 32-bit ids")
    before, mass_before = (np.cumsum(x) - x for x in each.T)
    return Vocabulary(level_one, buckets, tuple(before.tolist()), tuple(mass_before.tolist()), words, tokens)


# ---- n-grams on their way to units


@dataclass(frozen=True)
class Located:
    """Tokens of a group of documents in a row: the rank of each among the group's known words in order of their ids (-1:
    unknown), the documents' places, the known words' ids and counts, and each one's stretch and share."""

    rank: np.ndarray
    begins: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    stretch: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> Located:
        codes, words = pd.factorize(hashes)
        ids, counts = vocabulary.look_up(words)
        order = np.argsort(ids)[np.count_nonzero(ids < 0) :]
        # Fewer than the tokens of a group.
        place = np.full(len(words), -1, np.int32)
        place[order] = np.arange(len(order))
        stretch, _ = vocabulary.stretches(ids[order])
        return cls(place[codes], np.cumsum(lengths) - lengths, ids[order], counts[order], stretch, _share(ids[order]))

    def token_counts(self) -> np.ndarray:
        return np.append(self.counts, 0)[self.rank]

    def bigrams(self) -> np.ndarray:
        """The positions that a bigram of known words ends at."""
        inner = np.ones(len(self.rank), bool)
        inner[self.begins] = False
        inner[1:] &= (self.rank[1:] >= 0) & (self.rank[:-1] >= 0)
        return np.flatnonzero(inner)

    def first_words(self, at: np.ndarray) -> np.ndarray:
        """The rank of the word two before each position, -1 where there is none or it is unknown."""
        second = np.zeros(len(self.rank) + 1, bool)
        second[self.begins + 1] = True
        return np.where(second[at], -1, self.rank[np.maximum(at - 2, 0)])

    def units(self, vocabulary: Vocabulary, middle: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The units that answer for trigrams of these middle and first words (ranks)."""
        share = np.append(self.share, 0.0)[first]
        return vocabulary.unit_at(self.stretch[middle] + (share * self.counts[middle]).astype(np.int64))


def _in_order(columns: list[np.ndarray]) -> np.ndarray:
    """An order of rows by columns of whole numbers, through one 64-bit key: by their differences from the least, or, where
    these have too many bits together, by the ranks of the column's values."""
    if len(columns) == 1 and columns[0].dtype == np.uint64:
        return np.argsort(columns[0])
    ranks, bits = {}, [(int(c.max()) - int(c.min())).bit_length() for c in columns]
    for i, c in enumerate(columns):
        if sum(bits) <= 64:
            break
        values, ranks[i] = np.unique(c, return_inverse=True)
        bits[i] = (len(values) - 1).bit_length()
    if sum(bits) > 64:
        return np.lexsort([ranks[i] for i in reversed(range(len(columns)))])
    # A column at a time, as each is as large as the key.
    key = np.zeros(len(columns[0]), np.uint64)
    for i, (c, b) in enumerate(zip(columns, bits)):
        least, part = (0, ranks.pop(i)) if i in ranks else (c.min(), c)
        part = part.astype(np.uint64)
        part -= np.uint64(least)
        key <<= np.uint64(b)
        key |= part
    return np.argsort(key)


def _counted_once(columns: list[np.ndarray], values: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of ranks below ``values`` once each, in order, with how often each is there: sorted as keys, without their order."""
    bits = max(1, values.bit_length())
    if bits * len(columns) > 64:
        return _distinct(columns)
    key = columns[0].astype(np.uint64)
    for c in columns[1:]:
        key = (key << np.uint64(bits)) | c.astype(np.uint64)
    key.sort()
    first = _runs([key])
    key, n = key[first], np.diff(first, append=len(key))
    mask = np.uint64((1 << bits) - 1)
    return [((key >> np.uint64(bits * k)) & mask).astype(np.int64) for k in reversed(range(len(columns)))], n


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row begins that differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _distinct(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows once each, in order, with the sum of their counts (1 each if None)."""
    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    order = _in_order(columns)
    columns = [c[order] for c in columns]
    first = _runs(columns)
    if counts is None:
        total = np.diff(first, append=len(order))
    else:
        total = np.add.reduceat(counts[order], first)
    return [c[first] for c in columns], total


def _squeezed(columns: list[np.ndarray]) -> bytes:
    """Columns of 32-bit numbers, rows in order, by planes of bytes: of the first one the differences, of the second one those
    within a run of the first."""
    first, second, *rest = (c.astype(np.uint32) for c in columns)
    steps = np.diff(second, prepend=np.uint32(0))
    begins = _runs([first])
    steps[begins] = second[begins]
    planes = [np.diff(first, prepend=np.uint32(0)), steps, *rest]
    data = b"".join(np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in planes)
    return zstandard.ZstdCompressor(level=1).compress(data)


def _spread_out(data: bytes, n: int, width: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, 4, n)
    steps, inner, *rest = (np.ascontiguousarray(planes[i].T).view("<u4").ravel() for i in range(width))
    first = np.cumsum(steps, dtype=np.uint32)
    begins = _runs([first])
    # Sums from the beginning of all, less what they were before each run began; modulo 2^32, as the steps are.
    sums = np.cumsum(inner, dtype=np.uint32)
    before = np.repeat(sums[begins] - inner[begins], np.diff(begins, append=n))
    return [first, sums - before, *rest]


def _small(ids: np.ndarray) -> np.ndarray:
    return ids.astype(np.uint32)


def _wide(ids: np.ndarray) -> np.ndarray:
    return ids.astype(np.int64)


def _by_unit(units: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    # A radix sort, of numbers with few bits.
    order = np.argsort(units.astype(np.uint16 if units.max(initial=0) < 1 << 16 else np.uint32), kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(units[order])) + 1):
        if len(part):
            yield int(units[part[0]]), part


def _unit_pieces(found: Located, vocabulary: Vocabulary, middle: np.ndarray, first: np.ndarray | None) -> Iterator[np.ndarray]:
    """The places of a group's n-grams (of two words, if ``first`` is None) in pieces of some ``SORTED``, each of which has all
    of its units."""
    units = np.empty(len(middle), np.uint16 if vocabulary.buckets <= 1 << 16 else np.uint32)
    for a in range(0, len(middle), SORTED):
        some = middle[a : a + SORTED]
        at = vocabulary.unit_at(found.stretch[some]) if first is None else found.units(vocabulary, some, first[a : a + SORTED])
        units[a : a + SORTED] = at
    order = np.argsort(units, kind="stable")
    ends = np.cumsum(np.bincount(units))
    at = 0
    while at < len(order):
        # So many units as fit in, one at least.
        last = max(np.searchsorted(ends, at + SORTED, "right") - 1, np.searchsorted(ends, at, "right"))
        yield order[at : ends[last]]
        at = int(ends[last])


NGRAMS = "unit int, n int, data binary"


def _counted_rows(found: Located, vocabulary: Vocabulary, width: int) -> list[tuple[int, int, bytes]]:
    """``NGRAMS`` of a group."""
    at = found.bigrams()
    if width == 2:
        columns = [found.rank[at - 1], found.rank[at]]
    else:
        first = found.first_words(at)
        at, first = at[first >= 0], first[first >= 0]
        columns = [found.rank[at - 1], first, found.rank[at]]
        del first
    del at
    ids, rows = found.ids.astype(np.uint32), []
    for piece in _unit_pieces(found, vocabulary, columns[0], columns[1] if width > 2 else None):
        grams, counts = _counted_once([c[piece] for c in columns], len(ids))
        units = vocabulary.unit_at(found.stretch[grams[0]]) if width == 2 else found.units(vocabulary, *grams[:2])
        for unit, part in _by_unit(units):
            rows.append((unit, len(part), _squeezed([*(ids[c[part]] for c in grams), counts[part].astype(np.uint32)])))
    return rows


def _counted(texts: DataFrame, vocabulary: Vocabulary, width: int) -> DataFrame:
    """``NGRAMS``: all n-grams of ``width`` words by the unit that holds them, middle (or first) word first, with counts.

    They are counted before the shuffle, so no n-gram, however common, is there more than once per group of documents.
    """

    def count(batches):
        for _, hashes, lengths in _grouped(batches):
            found = Located.of(hashes, lengths, vocabulary)
            del hashes
            if rows := _counted_rows(found, vocabulary, width):
                unit, n, data = zip(*rows)
                del found, rows
                yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int32()), pa.array(n, pa.int32()), pa.array(data)], ["unit", "n", "data"])
                del unit, n, data

    return texts.mapInArrow(count, NGRAMS)


def _together(table: pa.Table, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All n-grams of a unit once, in order, with their counts."""
    parts = [_spread_out(d.as_py(), n.as_py(), width + 1) for n, d in zip(table.column("n"), table.column("data"))]
    if not parts:
        return [np.zeros(0, np.uint32)] * width, np.zeros(0, np.int64)
    # The parts are in order: a stretch of first words after another, of some ``SORTED`` rows unless one word has more.
    sample = np.sort(np.concatenate([p[0][::64] for p in parts]))
    stretches = 1 + sum(len(p[0]) for p in parts) // SORTED
    cuts = np.unique(sample[:: -(-len(sample) // stretches)])[1:]
    edges = [np.concatenate([[0], np.searchsorted(p[0], cuts), [len(p[0])]]) for p in parts]
    done = []
    for k in range(len(cuts) + 1):
        *columns, counts = (np.concatenate([p[i][e[k] : e[k + 1]] for p, e in zip(parts, edges)]) for i in range(width + 1))
        done.append(_distinct(columns, counts.astype(np.int64)))
    del parts, columns, counts
    return [np.concatenate([columns[i] for columns, _ in done]) for i in range(width)], np.concatenate([n for _, n in done])


# ---- levels two and three


def quantised(logs: np.ndarray) -> np.ndarray:
    """Base-ten logarithms from ``LOWEST_LOG`` to 0 as codes of a byte."""
    return np.clip(np.round(logs / LOWEST_LOG * (CODES - 1)), 0, CODES - 1).astype(np.uint8)


def log_of(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (LOWEST_LOG / (CODES - 1))


@dataclass(frozen=True)
class Successors:
    """A stretch of level two: of the words ``first`` to ``last`` all that followed them."""

    first: int
    last: int
    words: int
    pointers: EliasFano
    successors: EliasFano
    backoff: np.ndarray
    codes: np.ndarray

    @classmethod
    def counted(cls, vocabulary: Vocabulary, context: np.ndarray, word: np.ndarray, n: np.ndarray) -> Successors:
        context, first, last = _wide(context), int(context[0]), int(context[-1])
        local, width = context - first, last - first + 1
        share = (n - DISCOUNT) / np.bincount(local, n, width)[local]
        left = 1.0 - np.bincount(local, share, width)
        p = share + left[local] * 10 ** vocabulary.log_p(vocabulary.counts_of(word))
        pointers = np.concatenate([[0], np.cumsum(np.bincount(local, minlength=width))])
        v = vocabulary.words
        placed = local.astype(np.uint64) * np.uint64(v) + word.astype(np.uint64)
        return cls(
            first,
            last,
            v,
            EliasFano.of(pointers, len(word) + 1),
            EliasFano.of(placed, width * v),
            quantised(np.log10(np.maximum(left, 1e-12))),
            quantised(np.log10(p)),
        )

    def block(self) -> bytes:
        parts = [x for e in (self.pointers, self.successors) for x in e.bare_arrays()]
        return _block([np.array([self.first, self.last, self.words]), *parts, self.backoff, self.codes])

    @classmethod
    def of_block(cls, data: bytes) -> Successors:
        head, *a = _of_block(data)
        return cls(*(int(x) for x in head), *(EliasFano.from_bare_arrays(a[i : i + 3]) for i in (0, 3)), *a[6:])

    @cached_property
    def _decoded(self) -> tuple[np.ndarray, np.ndarray]:
        # Asked for about as many n-grams as there are in a unit, it is quicker to read a sequence through once.
        return self.pointers.decoded().astype(np.int64), self.successors.decoded()

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each (context, word): the rank among the context's successors (-1: absent), the code of its log10 p, and the
        code of the context's backoff weight."""
        pointers, successors = self._decoded
        local = _wide(context) - self.first
        placed = local.astype(np.uint64) * np.uint64(self.words) + word.astype(np.uint64)
        at, there = _successor(successors, placed)
        return np.where(there, at - pointers[local], -1), self.codes[at], self.backoff[local]


def _block(arrays: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(packed(arrays))


def _of_block(data: bytes) -> list[np.ndarray]:
    return unpacked(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8))


def _successor(values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the first of ``values`` that is not below each number asked for (the last, if all are), and whether it
    is that number."""
    if not len(values):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(values, asked), len(values) - 1)
    return at, values[at] == asked


@dataclass(frozen=True)
class Thirds:
    """A unit's share of level three, for the middle words of one stretch of level two."""

    first: int
    words: int
    contexts: EliasFano
    pointers: EliasFano
    ranks: EliasFano
    universe: int
    backoff: np.ndarray
    codes: np.ndarray

    @classmethod
    def counted(cls, two: Successors, middle: np.ndarray, first: np.ndarray, word: np.ndarray, n: np.ndarray) -> Thirds:
        begins = _runs([middle, first])
        bounds = np.append(begins, len(middle))
        ranks, codes = np.empty(len(middle), np.int64), np.empty(len(middle), np.uint8)
        backoff, top = np.empty(len(begins), np.uint8), 0
        # Whole contexts of some ``SORTED`` rows at once.
        cuts = np.append(np.unique(np.searchsorted(begins, np.arange(0, len(middle), SORTED), "right") - 1), len(begins))
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows, each = slice(bounds[a], bounds[b]), np.diff(bounds[a : b + 1])
            rank, shorter, _ = two.find(middle[rows], word[rows])
            context = np.repeat(np.arange(b - a), each)
            share = (n[rows] - DISCOUNT) / np.bincount(context, n[rows], b - a)[context]
            left = 1.0 - np.bincount(context, share, b - a)
            p = share + left[context] * 10 ** log_of(shorter)
            # Ranks of a context begin one above the last of the context before.
            last = rank[np.cumsum(each) - 1]
            tops = top + np.cumsum(last + 1)
            ranks[rows] = rank + np.repeat(tops - last - 1, each)
            top = int(tops[-1])
            backoff[a:b] = quantised(np.log10(np.maximum(left, 1e-12)))
            codes[rows] = quantised(np.log10(p))
        universe = top + 1
        placed = (_wide(middle[begins]) - two.first).astype(np.uint64) * np.uint64(two.words) + first[begins].astype(np.uint64)
        return cls(
            two.first,
            two.words,
            EliasFano.of(placed, (two.last - two.first + 1) * two.words),
            EliasFano.of(bounds, len(middle) + 1),
            EliasFano.of(ranks, universe),
            universe,
            backoff,
            codes,
        )

    def block(self) -> bytes:
        head = np.array([self.first, self.words, self.universe])
        parts = [x for e in (self.contexts, self.pointers, self.ranks) for x in e.bare_arrays()]
        return _block([head, *parts, self.backoff, self.codes])

    @classmethod
    def of_block(cls, data: bytes) -> Thirds:
        (first, words, universe), *a = _of_block(data)
        sequences = [EliasFano.from_bare_arrays(a[i : i + 3]) for i in (0, 3, 6)]
        return cls(int(first), int(words), *sequences, int(universe), *a[9:])

    @cached_property
    def _decoded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.contexts.decoded(), self.pointers.decoded().astype(np.int64), self.ranks.decoded()

    def find(self, middle: np.ndarray, first: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each trigram, its last word as a rank: whether the bigram before it has been seen as a context, the code of the
        trigram's log10 p (or -1), and the code of the context's backoff weight."""
        n, asked = len(middle), np.flatnonzero(first != NO_WORD)
        seen, code, weight = np.zeros(n, bool), np.full(n, -1, np.int64), np.zeros(n, np.uint8)
        if not len(self.codes) or not len(asked):
            return seen, code, weight
        contexts, pointers, ranks = self._decoded
        placed = (_wide(middle[asked]) - self.first).astype(np.uint64) * np.uint64(self.words) + first[asked].astype(np.uint64)
        # In order of their contexts, of which each is looked up once.
        begins = _runs([placed])
        each = np.diff(begins, append=len(placed))
        context, there = (np.repeat(x, each) for x in _successor(contexts, placed[begins]))
        asked, context = asked[there], context[there]
        seen[asked], weight[asked] = True, self.backoff[context]
        asked, context = asked[rank[asked] >= 0], context[rank[asked] >= 0]
        begin, end = pointers[context], pointers[context + 1]
        base = np.where(begin > 0, _wide(ranks[np.maximum(begin - 1, 0)]) + 1, 0)
        at, there = _successor(ranks, (base + rank[asked]).astype(np.uint64))
        there &= at < end
        code[asked[there]] = self.codes[at[there]]
        return seen, code, weight


LEVEL_TWO = "unit int, two binary"
LEVELS = "unit int, tokens long, two binary, three binary"


def _level_two(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``LEVEL_TWO``: per unit the stretch of the words that begin there, and in each further unit that the last of these
    words reaches into, a stretch of that word alone."""

    def level(table: pa.Table) -> pa.Table:
        unit = table.column("unit")[0].as_py()
        (context, word), n = _together(table, 2)
        rows = [(unit, Successors.counted(vocabulary, context, word, n).block())]
        last = context[-1:]
        begin, count = vocabulary.stretches(last)
        reach = int(vocabulary.unit_at(begin + count)[0])
        if reach > unit:
            alone = Successors.counted(vocabulary, *(c[context == last[0]] for c in (context, word, n))).block()
            rows += [(u, alone) for u in range(unit + 1, reach + 1)]
        units, blocks = zip(*rows)
        return pa.table({"unit": pa.array(units, pa.int32()), "two": pa.array(blocks, pa.binary())})

    return _counted(texts, vocabulary, 2).groupBy("unit").applyInArrow(level, LEVEL_TWO)


@dataclass(frozen=True)
class Trie:
    """Level one as shipped, the other levels by unit, and how many copies of each unit the documents are dealt over."""

    vocabulary: Vocabulary
    levels: DataFrame
    copies: tuple[int, ...]


def train(docs: DataFrame, ws: Workspace) -> Trie:
    """The model of all documents that are not held out."""
    texts = doc_texts(docs).where(~held_out())
    vocabulary = count_words(texts, ws)
    two = settled(_level_two(texts, vocabulary), ws, "successors")
    release(ws.spark)

    def level(left: pa.Table, right: pa.Table) -> pa.Table:
        (middle, first, word), n = _together(left, 3)
        rows = []
        for unit, block in zip(right.column("unit").to_pylist(), right.column("two").to_pylist()):
            stretch = Successors.of_block(block)
            # The middle words are in order.
            here = slice(*np.searchsorted(middle, np.array([stretch.first, stretch.last + 1], middle.dtype)))
            some = [c[here] for c in (middle, first, word, n)]
            rows.append((unit, int(some[3].sum()), block, Thirds.counted(stretch, *some).block()))
        units, tokens, twos, threes = zip(*rows) if rows else ((), (), (), ())
        arrays = [pa.array(units, pa.int32()), pa.array(tokens, pa.int64()), pa.array(twos, pa.binary()), pa.array(threes, pa.binary())]
        return pa.Table.from_arrays(arrays, ["unit", "tokens", "two", "three"])

    counted = _counted(texts, vocabulary, 3)
    levels = counted.groupBy("unit").cogroup(two.groupBy("unit")).applyInArrow(level, LEVELS)
    levels = settled(levels, ws, "levels")
    del counted, two
    delete_folder(ws.spark, ws.path("successors"))
    release(ws.spark)
    # A row per unit, of which there are as many as shuffle partitions.
    held = {r["unit"]: r["n"] for r in levels.groupBy("unit").agg(F.sum("tokens").alias("n")).collect()}
    fair = max(1.0, vocabulary.tokens / vocabulary.buckets)
    copies = tuple(max(1, round(held.get(u, 0) / fair)) for u in range(vocabulary.buckets))
    return Trie(vocabulary, levels, copies)


# ---- scores


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"
ASKED = "unit int, copy int, part long, n int, data binary, docs binary"
ANSWERED = "part long, docs binary, sums binary"


def _known_row(found: Located, vocabulary: Vocabulary, doc_ids: list, lengths: np.ndarray, part: int, turn: int) -> dict:
    counts, begins = found.token_counts(), found.begins
    base = vocabulary.log_p(counts)
    known = np.add.reduceat((counts > 0).astype(np.int64), begins)
    del counts
    all_base = np.add.reduceat(base, begins)
    base[found.bigrams()] = 0.0
    ids = pa.array(doc_ids, pa.int64())
    own = [
        ids.fill_null(0).to_numpy(zero_copy_only=False),
        np.array(ids.is_null().to_numpy(zero_copy_only=False), np.uint8),
        lengths.astype(np.int64),
        known,
        all_base,
        np.add.reduceat(base, begins),
    ]
    return {"unit": turn % vocabulary.buckets, "copy": 0, "part": part, "n": 0, "data": b"", "docs": packed(own)}


def _asked_rows(found: Located, vocabulary: Vocabulary, copies: np.ndarray, lengths: np.ndarray, part: int, turn: int) -> list[dict]:
    at = found.bigrams()
    first = found.first_words(at)
    columns = [
        found.rank[at - 1],
        np.where(first < 0, len(found.ids), first).astype(np.int32),
        found.rank[at],
        np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[at],
    ]
    del at, first
    ids, rows = np.append(found.ids, NO_WORD), []
    for piece in _unit_pieces(found, vocabulary, *columns[:2]):
        # Once per document, however often it is there.
        (middle, first, word, doc), times = _distinct([c[piece] for c in columns])
        for unit, some in _by_unit(found.units(vocabulary, middle, first)):
            data = _squeezed([ids[middle[some]], ids[first[some]], ids[word[some]], doc[some], times[some]])
            rows.append({"unit": unit, "copy": turn % int(copies[unit]), "part": part, "n": len(some), "data": data, "docs": None})
    return rows


def _asked(docs: DataFrame, trie: Trie) -> DataFrame:
    """Per group of documents (``part``) and unit the trigrams to be answered, with the documents they are in; and, once per
    group, what its task knows of its documents by itself."""
    vocabulary, copies = trie.vocabulary, np.array(trie.copies)

    def ask(batches):
        # Not by enumerate, which would hold on to each group.
        number = -1
        for doc_ids, hashes, lengths in _grouped(batches):
            number += 1
            task = TaskContext.get().partitionId()
            part, turn = (task << 32) | number, task + 7919 * number
            found = Located.of(hashes, lengths, vocabulary)
            del hashes
            rows = [_known_row(found, vocabulary, doc_ids, lengths, part, turn)]
            rows += _asked_rows(found, vocabulary, copies, lengths, part, turn)
            # What is done with is let go before the next group is put together.
            del found, doc_ids, lengths
            yield pa.RecordBatch.from_pylist(rows, ASKED_SCHEMA)
            del rows

    return doc_texts(docs).mapInArrow(ask, ASKED)


ASKED_SCHEMA = pa.schema(
    [("unit", pa.int32()), ("copy", pa.int32()), ("part", pa.int64()), ("n", pa.int32()), ("data", pa.binary()), ("docs", pa.binary())]
)
ANSWERED_SCHEMA = pa.schema([("part", pa.int64()), ("docs", pa.binary()), ("sums", pa.binary())])


def _numbered(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order, and the number among them of each row."""
    order = _in_order(columns)
    columns = [c[order] for c in columns]
    begins = _runs(columns)
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(order)))
    return [c[begins] for c in columns], place


def _log_p(vocabulary: Vocabulary, two: Successors, three: Thirds, middle: np.ndarray, first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log10 p of each word after its two words, or after the middle one alone; bigrams are looked up once."""
    (before, after), place = _numbered([middle, word])
    rank, code, weight = two.find(before, after)
    base = vocabulary.log_p(vocabulary.counts_of(after))
    bigram = np.where(rank >= 0, log_of(code), base + log_of(weight))[place]
    seen, code, weight = three.find(middle, first, rank[place])
    return np.where(code >= 0, log_of(code), np.where(seen, bigram + log_of(weight), bigram))


def _sums(vocabulary: Vocabulary, shelves: list[tuple[Successors, Thirds]], each: list[list[np.ndarray]]) -> list[bytes]:
    """Of each group's n-grams the sums of log10 p by document; n-grams of more than one group are looked up once."""
    grams, place = _numbered([np.concatenate([e[k] for e in each]) for k in range(3)])
    found = np.zeros(len(grams[0]))
    for two, three in shelves:
        here = np.flatnonzero((grams[0] >= two.first) & (grams[0] <= two.last))
        if len(here):
            found[here] = _log_p(vocabulary, two, three, *(g[here] for g in grams))
    edges = np.cumsum([len(e[0]) for e in each])[:-1]
    return [np.bincount(e[3], found[where] * e[4]).tobytes() for e, where in zip(each, np.split(place, edges))]


def scores(docs: DataFrame, trie: Trie) -> DataFrame:
    """``SCORES`` of every row: the n-grams go to the units, and their sums come back to the documents."""
    vocabulary = trie.vocabulary

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        shelves = [
            (Successors.of_block(two.as_py()), Thirds.of_block(three.as_py()))
            for two, three in zip(right.column("two"), right.column("three"))
        ]
        parts, sizes = left.column("part").to_numpy(), left.column("n").to_numpy()
        out = [{"part": p, "docs": d.as_py(), "sums": None} for p, d in zip(parts, left.column("docs")) if d.is_valid]
        asking = np.flatnonzero(left.column("docs").is_null().to_numpy())
        # So many groups' n-grams at once as begin in a stretch of ``SORTED``.
        turn = (np.cumsum(sizes[asking]) - sizes[asking]) // SORTED
        for some in np.split(asking, np.flatnonzero(np.diff(turn)) + 1):
            if len(some):
                each = [_spread_out(left.column("data")[int(i)].as_py(), int(sizes[i]), 5) for i in some]
                out += [{"part": parts[i], "docs": None, "sums": sums} for i, sums in zip(some, _sums(vocabulary, shelves, each))]
        return pa.Table.from_pylist(out, ANSWERED_SCHEMA)

    def together(table: pa.Table) -> pa.Table:
        [own] = [d.as_py() for d in table.column("docs") if d.is_valid]
        ids, missing, lengths, known, base, score = unpacked(np.frombuffer(own, np.uint8))
        score = score.copy()
        for sums in table.column("sums"):
            if sums.is_valid:
                # Of the documents up to the last one that asked.
                each = np.frombuffer(sums.as_py(), np.float64)
                score[: len(each)] += each
        doc_ids = pa.array(ids, mask=missing.astype(bool))
        return pa.Table.from_arrays(
            [doc_ids, *(pa.array(x) for x in (lengths, known, base, score))], ["doc_id", "n_tokens", "n_known", "base_score", "score"]
        )

    copies = F.element_at(F.array(*map(F.lit, trie.copies)), F.col("unit") + 1)
    levels = trie.levels.select("unit", "two", "three", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    asked = _asked(docs, trie).groupBy("unit", "copy")
    answered = asked.cogroup(levels.groupBy("unit", "copy")).applyInArrow(answer, ANSWERED)
    return answered.groupBy("part").applyInArrow(together, SCORES)


def score_documents(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Train on the documents that are not held out, and score all of them by the base model and by the trie."""
    trie = train(docs, ws)
    total = F.lit(trie.vocabulary.tokens).cast("long").alias("train_tokens")
    return scores(docs, trie).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", total, "base_score", "score")
