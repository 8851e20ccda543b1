"""SimHash near-duplicates with pivot distance tables.

A fingerprint has a bit set where over half of the text's 4-word shingles' hashes have it. Distances of every fingerprint
to many reference fingerprints (pivots) are computed once and packed into its row. A pair whose distances to any one
pivot differ by more than the radius cannot be within it (triangle inequality) and is discarded; survivors are verified.

A pivot table gives ranges, not equal keys, so pairs must be brought together by something that can be hashed: the bits
are cut into blocks, and of fingerprints that differ in at most r bits all but r blocks are equal somewhere (pigeonhole), so every link shares a
key. More fingerprints get more blocks and longer keys; the result does not depend on it.

No bucket is compared all against all. First each member is tried against its bucket's two extreme fingerprints, which
links dense groups through few edges; components of these are formed. Then only the members outside a bucket's largest
component are tried against members of other components, and only against those that the pivot table lets them meet: each
bucket is cut by its distances to the pivot that spreads it most, into ranges a little wider than the radius.

Defined cases: a null or empty text has fingerprint zero and links like any other; equal fingerprints are one node; a
null ``doc_id`` takes part and never becomes a component's id unless its whole component is null; repeated rows are kept;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts, free_name, row_key, settled, text_or_empty
from tablekeep.llm.components import component_roots
from tablekeep.session import Workspace, col

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
PIVOTS = 16
SLICE = 50_000


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text (as a signed integer); words are ASCII-blank separated, A-Z in lower case."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    spans = list(zip(starts, ends[SHINGLE_WORDS - 1 :])) or [(0, ends[-1])]
    ones, hashed = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(spans), SLICE):
        hashes = np.array([hashed(joined[a : b - 1], SEED) for a, b in spans[at : at + SLICE]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, fp`` of every row, with the MD5 of the text (null text: empty). One scan."""

    def of(batches):
        for batch in batches:
            found = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), found], ["doc_id", "digest", "fp"])

    return doc_texts(docs).withColumn("digest", F.md5("text")).mapInArrow(of, "doc_id long, digest string, fp long")


def pivot_fingerprints(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints by rule: hashes of 0, 1, 2, ... as signed integers."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(i), SEED)).astype(np.int64)) for i in range(n)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def with_pivot_table(fps: DataFrame) -> DataFrame:
    """Add the distances to all pivots, a byte each, eight to a long (``p0``, ``p1``, ...)."""
    pivots = pivot_fingerprints()
    columns = []
    for at in range(0, len(pivots), 8):
        packed = F.lit(0).cast("long")
        for i, pivot in enumerate(pivots[at : at + 8]):
            packed = packed.bitwiseOR(F.shiftleft(_distance(F.col("fp"), F.lit(pivot)).cast("long"), 8 * i))
        columns.append(packed.alias(f"p{at // 8}"))
    return fps.select("*", *columns)


def _near(a: str, b: str, radius: int) -> Column:
    """Pivot coordinates first, then the distance itself."""
    near = F.lit(True)
    for one, other in zip(_pivot_distances(a), _pivot_distances(b)):
        near &= F.abs(one - other) <= radius
    return near & (_distance(F.col(f"{a}fp"), F.col(f"{b}fp")) <= radius)


def block_masks(fingerprints_there: int, radius: int = RADIUS) -> list[int]:
    """Masks of all choices of equal blocks, with as many blocks as keep a random bucket to a few fingerprints."""
    blocks = radius + 2
    while blocks < 16 and 64 * (blocks - radius) / blocks < math.log2(max(2, fingerprints_there)) + 1:
        blocks += 1
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(some)) for some in itertools.combinations(parts, blocks - radius)]


def _bucketed(nodes: DataFrame, masks: list[int]) -> DataFrame:
    """A row per node and choice of blocks: ``k`` (the choice) and ``key`` (the bits there)."""
    keys = F.array(*(F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)))
    return nodes.select("*", F.explode(keys).alias("b")).select(*nodes.columns, "b.k", "b.key")


def _renamed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("k", "key")) -> DataFrame:
    return df.select(*(F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns))


def near_roots(distinct: DataFrame, ws: Workspace, radius: int = RADIUS) -> DataFrame:
    """``fp, root``: for every distinct fingerprint the smallest one that links reach from it."""
    nodes = settled(with_pivot_table(distinct), ws, "pivot_table")
    masks = block_masks(nodes.count(), radius)
    extremes = _bucketed(nodes.select("fp"), masks).groupBy("k", "key").agg(
        F.min("fp").alias("low"), F.max("fp").alias("high")
    )
    # Most buckets hold one fingerprint and end here.
    shared = settled(extremes.where("low < high"), ws, "buckets")
    members = settled(_bucketed(nodes, masks).join(shared, ["k", "key"]), ws, "members")

    ends = with_pivot_table(
        shared.select("k", "key", F.explode(F.array("low", "high")).alias("fp"))
    )
    tried = _renamed(members.drop("low", "high"), "a_").join(_renamed(ends, "b_"), ["k", "key"])
    stars = tried.where((F.col("a_fp") != F.col("b_fp")) & _near("a_", "b_", radius))
    first = component_roots(stars.select(F.col("a_fp").alias("u"), F.col("b_fp").alias("v")), ws, "stars")

    known = first.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    labelled = members.drop("low", "high").join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labelled = settled(labelled, ws, "labelled")
    sizes = labelled.groupBy("k", "key", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("k", "key").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("roots")
    )
    still_apart = settled(labelled.join(largest.where("roots > 1").drop("roots"), ["k", "key"]), ws, "apart")
    across = pairs_across(still_apart, radius)
    links = across.select(F.col("a_root").alias("u"), F.col("b_root").alias("v"))
    second = component_roots(links, ws, "links").select(F.col("u").alias("root"), F.col("v").alias("top"))

    roots = nodes.select("fp").join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return roots.join(second, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))


def _pivot_distances(prefix: str = "") -> list[Column]:
    return [
        F.shiftrightunsigned(F.col(f"{prefix}p{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255)) for i in range(PIVOTS)
    ]


def met_by_pivot(members: DataFrame, radius: int) -> DataFrame:
    """Pairs of a bucket's members (``a_...``, ``b_...``), one outside its largest component and one of another component,
    whose distances to the bucket's pivot let them be within the radius.

    Of each bucket that pivot is taken whose distances are spread most. They are cut into ranges of ``radius + 1``, so two
    members within the radius are in the same range or in neighbouring ones: the pivot table decides who meets.
    """
    distances = _pivot_distances()
    spread = F.array(*((F.max(d) - F.min(d)) for d in distances))
    pivot = members.groupBy("k", "key").agg(spread.alias("s")).select("k", "key", F.array_position("s", F.array_max("s")).cast("int").alias("pivot"))
    chosen = F.element_at(F.array(*distances), F.col("pivot"))
    ranged = members.join(pivot, ["k", "key"]).withColumn("range", F.floor(chosen / F.lit(radius + 1)).cast("int")).drop("pivot")
    outside = ranged.where(F.col("root") != F.col("largest")).withColumn(
        "range", F.explode(F.array(*(F.col("range") + i for i in (-1, 0, 1))))
    )
    met = ("k", "key", "range")
    pairs = _renamed(outside.drop("largest"), "a_", met).join(_renamed(ranged.drop("largest"), "b_", met), list(met))
    return pairs.where(F.col("a_root") != F.col("b_root"))


def pairs_across(members: DataFrame, radius: int) -> DataFrame:
    """Of those pairs the ones that link."""
    return met_by_pivot(members, radius).where(_near("a_", "b_", radius))


def near_duplicates(docs: DataFrame, ws: Workspace, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest ``doc_id`` that links reach, the row itself included."""
    rows = settled(fingerprints(docs).drop("digest"), ws, "fingerprints")
    # Copies meet in one row before anything is compared.
    distinct = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), ws, "distinct")
    roots = settled(near_roots(distinct.select("fp"), ws, radius), ws, "roots")
    rooted = distinct.join(roots, "fp")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = roots.join(smallest, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_digits(fp: Column) -> Column:
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, ws: Workspace, radius: int = RADIUS) -> DataFrame:
    """The documents, all columns, with one of each component: the row of the smallest ``doc_id`` (ties: by its text's
    digest; of rows equal in both, one)."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    found = settled(fingerprints(docs), ws, "fingerprints")
    roots = settled(near_roots(found.select("fp").distinct(), ws, radius), ws, "roots")
    kept = found.join(roots, "fp").groupBy("root").agg(F.min(key).alias("kept"))
    name = free_name(docs, "__row")
    kept = kept.select(row_key(F.col("kept.doc_id"), F.col("kept.digest")).alias(name))
    marked = docs.withColumn(name, row_key(col("doc_id"), F.md5(text_or_empty())))
    # Equal rows meet where the join has brought them: texts are moved once.
    return marked.join(kept, name, "left_semi").dropDuplicates([name]).select(*map(col, docs.columns))
