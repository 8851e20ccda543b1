"""Hard negatives by Four-Russians scoring of quantised embeddings.

An anchor's integer vector is cut into groups of eight dimensions; for each group a table holds the sums of all 256
subsets of its components. A candidate's components are cut into bit planes (two's complement, as many as its block needs),
and eight dimensions of a plane are one byte. A plane's part of the inner product is then the sum of one table entry per
group, and planes are put together from the top one down by shift and add: the full exact score.

Rows and anchors are dealt into stripes of bounded size, and each pair of stripes is one task's cell of a grid, so the
anchors, a stated query set, meet all rows in blocks. A cell keeps the few best per anchor before the shuffle; the best of
all cells are found by a window over those. The first grid finds the positives (same labels only), the second the
negatives, within each positive's window of scores. No cell depends on how many rows share a label, a vector or an id.

Defined cases: rows with a null id, label or vector, or with a null, NaN or infinite component, take no part; a vector
shorter than another counts as filled up with zeros (an empty one scores 0); repeated rows are rows of their own, so a
copy of an anchor's row may be its positive, and each copy of an anchor is an anchor; rows that tie in score and id are
interchangeable; anchors without positives, or positives without negatives, have no rows; an empty table gives an empty
table; other columns are ignored. Scores beyond 62 bits raise ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablekeep.llm.common import settled
from tablekeep.session import Workspace, col

# Dimensions per table: the subsets of eight are what a byte names.
GROUP = 8
# Rows and anchors per stripe: a cell scores at most their product in pairs.
ROW_STRIPE = 8192
ANCHOR_STRIPE = 256
# Candidates scored at once, so that the scores in work stay in the processor's cache.
CHUNK = 512
SAFE_BITS = 62


# ---- scoring


def subset_tables(vectors: np.ndarray) -> np.ndarray:
    """Of each row of integers the sums of all subsets of every eight dimensions: ``(groups, 256, rows)``."""
    n, dims = vectors.shape
    groups = -(-dims // GROUP)
    padded = np.zeros((n, groups * GROUP), np.int64)
    padded[:, :dims] = vectors
    parts = padded.reshape(n, groups, GROUP).transpose(1, 2, 0)
    tables = np.zeros((groups, 1 << GROUP, n), np.int64)
    for bit in range(GROUP):
        # Subsets with this bit as their highest: those without it, plus its component.
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + parts[:, bit, None]
    return tables


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """The bits of integers in two's complement, a byte per eight dimensions: ``(planes, groups, rows)``, top plane first."""
    n, dims = vectors.shape
    groups = -(-dims // GROUP)
    least, most = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
    planes = max(most.bit_length(), (~least).bit_length() if least < 0 else 0) + 1
    padded = np.zeros((n, groups * GROUP), np.int64)
    padded[:, :dims] = vectors
    out = np.empty((planes, groups, n), np.uint8)
    for i in range(planes):
        bits = (padded >> np.int64(planes - 1 - i)) & 1
        out[i] = np.packbits(bits.astype(np.uint8).reshape(n, groups, GROUP), axis=2, bitorder="little")[:, :, 0].T
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products, ``(rows, anchors)``."""
    groups = min(len(tables), planes.shape[1])
    tables, planes = tables[:groups], planes[:, :groups]
    count, n = len(planes), planes.shape[2]
    largest = int(np.abs(tables).max(initial=0))
    bits = (max(1, groups) * largest).bit_length() + count
    if bits > SAFE_BITS:
        raise OverflowError("inner products beyond 62 bits")
    kind = np.int32 if bits <= 30 else np.int64
    tables = tables.astype(kind)
    out = np.zeros((n, tables.shape[2]), kind)
    entry = np.empty((min(n, CHUNK), tables.shape[2]), kind)
    for a in range(0, n, CHUNK):
        part = planes[:, :, a : a + CHUNK]
        total, held = out[a : a + CHUNK], entry[: part.shape[2]]
        for plane in range(count):
            total <<= 1
            for group in range(groups):
                np.take(tables[group], part[plane, group], axis=0, out=held, mode="clip")
                total += held
            if plane == 0:
                # The top bit of two's complement counts below zero.
                np.negative(total, out=total)
    return out


# ---- stripes


STRIPE = "stripe int, n int, dims int, row binary, id binary, label binary, vector binary"
WITH_POSITIVES = STRIPE + ", positive binary, positive_score binary"


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of integers as the rows of a matrix, the shorter ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(lists) else np.zeros(0, np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _stripe(batches: Iterator[pa.RecordBatch], packed: bool) -> Iterator[pa.RecordBatch]:
    """One row for all rows of a task, their vectors as bit planes (``packed``) or as they are."""
    tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not tables:
        return
    rows = pa.concat_tables(tables).combine_chunks()
    # By id, so that the first of equal scores is the one with the smaller id.
    rows = rows.take(pa.array(np.lexsort((rows["row"].to_numpy(), rows["vec_id"].to_numpy()))))
    vectors = _vectors(rows["vector"])
    held = bit_planes(vectors) if packed else vectors
    out = {
        "stripe": pa.array([TaskContext.get().partitionId()], pa.int32()),
        "n": pa.array([len(vectors)], pa.int32()),
        "dims": pa.array([vectors.shape[1]], pa.int32()),
        "row": [rows["row"].to_numpy().tobytes()],
        "id": [rows["vec_id"].to_numpy().tobytes()],
        "label": [rows["label"].to_numpy().tobytes()],
        "vector": [held.tobytes()],
    }
    if "positives" in rows.column_names:
        listed = rows["positives"].to_pylist()
        most = max(map(len, listed))
        for name, key, missing in (("positive", "vec_id", 0), ("positive_score", "score", -1)):
            # A score below zero has no window, so it also stands for "there are no more".
            filled = [[p[key] for p in ps] + [missing] * (most - len(ps)) for ps in listed]
            out[name] = [np.array(filled, np.int64).tobytes()]
    yield pa.RecordBatch.from_pydict(out)


def _stripes(rows: DataFrame, number: int, packed: bool) -> DataFrame:
    """Deal rows evenly into stripes, whatever their values."""
    positives = "positives" in rows.columns
    dealt = rows.repartition(number)
    return dealt.mapInArrow(lambda batches: _stripe(batches, packed), WITH_POSITIVES if positives else STRIPE)


def _int64(cell) -> np.ndarray:
    return np.frombuffer(cell.as_py(), np.int64)


class _Candidates:
    def __init__(self, row: dict):
        self.n = row["n"].as_py()
        self.row, self.id, self.label = (_int64(row[k]) for k in ("row", "id", "label"))
        groups = -(-row["dims"].as_py() // GROUP)
        data = np.frombuffer(row["vector"].as_py(), np.uint8)
        self.planes = data.reshape(-1, groups, self.n) if groups else np.zeros((1, 0, self.n), np.uint8)


class _Anchors(_Candidates):
    def __init__(self, row: dict):
        self.n = row["n"].as_py()
        self.row, self.id, self.label = (_int64(row[k]) for k in ("row", "id", "label"))
        self.vectors = _int64(row["vector"]).reshape(self.n, row["dims"].as_py())
        if "positive" in row:
            self.positive = _int64(row["positive"]).reshape(self.n, -1)
            self.positive_score = _int64(row["positive_score"]).reshape(self.n, -1)


def _rows_of(table: pa.Table) -> Iterator[dict]:
    for i in range(table.num_rows):
        yield {name: table.column(name)[i] for name in table.column_names}


def _best(ids: np.ndarray, found: np.ndarray, number: int) -> np.ndarray:
    """Places of the first ``number`` by falling score, then id; ids come sorted."""
    return np.argsort(-found.astype(np.int64), kind="stable")[:number]


def _grid(anchors: DataFrame, rows: DataFrame, anchor_stripes: int, row_stripes: int, of_cell, schema: str) -> DataFrame:
    """Every stripe of anchors with every stripe of rows, each pair one group of two bounded tables."""
    a = anchors.withColumnRenamed("stripe", "a").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(row_stripes - 1))))
    r = rows.withColumnRenamed("stripe", "r").withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(anchor_stripes - 1))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [
            of_cell(_Anchors(x), _Candidates(y))
            for x in _rows_of(left)
            for y in _rows_of(right)
        ]
        names = [part.split()[0] for part in schema.split(", ")]
        return pa.table({n: np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i, n in enumerate(names)})

    return a.groupBy("a", "r").cogroup(r.groupBy("a", "r")).applyInArrow(cell, schema)


POSITIVES = "anchor_row long, vec_id long, score long"
NEGATIVES = "anchor_row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"


def _columns(parts: list[list], width: int) -> list[np.ndarray]:
    if not parts:
        return [np.zeros(0, np.int64)] * width
    return [np.concatenate([np.asarray(p[i], np.int64) for p in parts]) for i in range(width)]


def _positives(number: int):
    def of_cell(anchors: _Anchors, rows: _Candidates) -> list[np.ndarray]:
        parts = []
        for label in np.unique(anchors.label):
            mine, same = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
            if not len(same):
                continue
            found = scores(subset_tables(anchors.vectors[mine]), rows.planes[:, :, same])
            for k, a in enumerate(mine):
                others = np.flatnonzero(rows.row[same] != anchors.row[a])
                first = others[_best(rows.id[same][others], found[others, k], number)]
                parts.append([np.full(len(first), anchors.row[a]), rows.id[same][first], found[first, k]])
        return _columns(parts, 3)

    return of_cell


def _negatives(number: int, low: int, high: int):
    def of_cell(anchors: _Anchors, rows: _Candidates) -> list[np.ndarray]:
        parts = []
        found = scores(subset_tables(anchors.vectors), rows.planes).T
        for k in range(anchors.n):
            wanted = anchors.positive_score[k]
            # Of integers: 100 s >= low p is s >= ceil(low p / 100), and so on.
            least, most = -(-low * wanted // 100), high * wanted // 100
            held = np.flatnonzero(
                (found[k] >= least[wanted >= 0].min(initial=SAFE)) & (found[k] <= most[wanted >= 0].max(initial=-SAFE)) & (rows.label != anchors.label[k])
            )
            if not len(held):
                continue
            held = held[_best(rows.id[held], found[k][held], len(held))]
            falling = -found[k][held].astype(np.int64)
            for place in np.flatnonzero(wanted >= 0):
                begin = np.searchsorted(falling, -most[place], "left")
                end = np.searchsorted(falling, -least[place], "right")
                first = held[begin : max(begin, min(end, begin + number))]
                same = [np.full(len(first), v) for v in (anchors.row[k], anchors.id[k], place, anchors.positive[k, place], wanted[place])]
                parts.append([*same, rows.id[first], found[k][first]])
        return _columns(parts, 7)

    return of_cell


SAFE = np.int64(1) << np.int64(SAFE_BITS)


# ---- mining


def quantised(vector: Column, scale: int) -> Column:
    """Each component, as a double, times ``scale``, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    ws: Workspace,
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of ``vec_id, label, <vector>`` rows: for each anchor and each of its first ``positives`` rows of the
    same label, the first ``negatives`` rows of other labels that score from ``low`` to ``high`` percent of the positive."""
    picked = rows.select(
        col("vec_id").cast("long").alias("vec_id"),
        col("label").cast("long").alias("label"),
        quantised(col(vector), scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        usable(col(vector)).alias("__usable"),
    ).where(F.col("__usable") & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    numbered = picked.drop("__usable").withColumn("row", F.monotonically_increasing_id())
    known = settled(numbered, ws, "vectors")
    sizes = known.agg(F.count("*").alias("rows"), F.count_if("is_anchor").alias("anchors")).first()
    row_stripes = max(1, -(-sizes["rows"] // ROW_STRIPE))
    anchor_stripes = max(1, -(-sizes["anchors"] // ANCHOR_STRIPE))

    fields = ["row", "vec_id", "label", "vector"]
    candidates = settled(_stripes(known.select(*fields), row_stripes, packed=True), ws, "bit_planes")
    anchors = known.where("is_anchor").select(*fields)
    asking = settled(_stripes(anchors, anchor_stripes, packed=False), ws, "anchors")

    near = _grid(asking, candidates, anchor_stripes, row_stripes, _positives(positives), POSITIVES)
    first = W.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    listed = near.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives"))
    asked = anchors.join(listed, F.col("row") == F.col("anchor_row")).select(*fields, "positives")
    asking = settled(_stripes(asked, anchor_stripes, packed=False), ws, "anchors_with_positives")

    far = _grid(asking, candidates, anchor_stripes, row_stripes, _negatives(negatives, low, high), NEGATIVES)
    best = W.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
