"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations alone.

An item's windows are its sequences of ten words (an item of fewer words is one window). A window is a set of shingles of
three words (fewer in shorter windows). Shingles are ordered by rarity, their number in all documents. As a window must
be contained whole, its prefix is one shingle: its rarest. The documents' shingles meet the prefixes by hash; where one
meets, the window can only begin so many words earlier (positional bound) and must end within the document (length
bound), and there the words themselves are compared. The verification happens where the shingle meets its prefix, so a
document's words never leave their task.

Defined cases: null texts and texts without a word have no words and no windows; equal items, also repeated rows of one
item, are looked up once and all reported; rows of one ``doc_id`` with different texts stay rows of their own, equal rows
too; a null ``item_id`` is listed as nothing; empty tables give empty or uncontaminated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablekeep.llm.common import LOWER, UPPER, doc_texts, free_name, row_key, settled, text_or_empty
from tablekeep.operators.matching import fits_broadcast
from tablekeep.session import Workspace, col

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
NOT_A_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# Memory of a window beside its words, and of each word beside its letters, on the broadcast side.
WINDOW_BYTES, WORD_BYTES = 200, 16


def words_of(text: Column) -> Column:
    """Words of a text after A-Z went to lower case: runs of digits, a-z and anything outside ASCII."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NOT_A_WORD), "")


def shingle_hash(size: int, words: list[Column]) -> Column:
    """A hash by which shingles meet; words are compared afterwards, so a collision does no harm."""
    return F.xxhash64(F.lit(size), *words[:size])


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``items`` (class, item_id) and ``windows`` (words, classes): items of equal words are one class."""
    worded = benchmark.select(col("item_id").cast("string").alias("item_id"), words_of(text_or_empty()).alias("words"))
    worded = worded.where(F.size("words") > 0).withColumn("class", F.sha2(F.array_join("words", " "), 256))
    items = worded.select("class", "item_id").distinct()
    classes = worded.groupBy("class").agg(F.first("words").alias("words"))
    last = F.greatest(F.size("words") - WINDOW_WORDS, F.lit(0))
    starts = classes.select("class", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    windows = starts.select("class", F.slice("words", F.col("at") + 1, WINDOW_WORDS).alias("window"))
    return items, windows.groupBy("window").agg(F.collect_set("class").alias("classes"))


def _positions(words: DataFrame, keep: list[str], sizes: list[int], closing: str, closed: bool = True) -> DataFrame:
    """A row per word: its position ``at``, and the hash ``token`` of each shingle that begins there.

    ``closing`` is put after the last word, so there is one row for an empty document too, unless not ``closed``.
    """
    after = [F.lit(closing)] * SHINGLE_WORDS
    padded = words.withColumn("__w", F.concat("words", F.array(*after)))
    shifted = [F.slice("__w", k + 1, F.size("words") + 1) for k in range(SHINGLE_WORDS)]
    at = padded.select(*keep, F.posexplode(F.arrays_zip(*(s.alias(f"w{k}") for k, s in enumerate(shifted)))).alias("at", "s"))
    parts = [F.col("s").getField(f"w{k}") for k in range(SHINGLE_WORDS)]
    if not closed:
        at = at.where(parts[0] != closing)
    hashes = [shingle_hash(size, parts) for size in sizes]
    first = F.when(parts[0] == closing, F.lit(0)).otherwise(1)
    if len(hashes) == 1:
        return at.select(*keep, "at", F.when(first == 0, F.lit(0)).otherwise(hashes[0]).alias("token"))
    tokens = F.when(first == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array(*hashes))
    return at.select(*keep, "at", F.explode(tokens).alias("token"))


def prefixes(documents: DataFrame, windows: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """Each window with its prefix: the ``token`` of its rarest shingle in the documents, and that shingle's place."""
    size = F.least(F.size("window"), F.lit(SHINGLE_WORDS))
    each = windows.select("window", "classes", size.alias("k"), F.explode(F.sequence(F.lit(0), F.size("window") - size)).alias("place"))
    words = [F.get("window", F.col("place") + k) for k in range(SHINGLE_WORDS)]
    token = F.lit(None).cast("long")
    for k in sizes:
        token = F.when(F.col("k") == k, shingle_hash(k, words)).otherwise(token)
    each = each.withColumn("token", token)
    wanted = each.select("token").distinct()
    met = _positions(documents, [], sizes, "").join(F.broadcast(wanted) if small else wanted, "token", "left_semi")
    common = met.groupBy("token").agg(F.count("*").alias("number"))
    rarity = F.struct(F.coalesce("number", F.lit(0)).alias("number"), "place", "token")
    rarest = each.join(common, "token", "left").groupBy("window").agg(F.min(rarity).alias("r"), F.first("classes").alias("classes"))
    return rarest.select("window", "classes", F.col("r.place").alias("place"), F.col("r.token").alias("token"))


def window_hits(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """``hits`` (doc_id, digest, n_words, begin, length, classes), with one row without a window per document, and ``items``."""
    items, windows = item_windows(benchmark)
    items, windows = settled(items, ws, "items"), settled(windows, ws, "windows")
    size = F.sum(
        WINDOW_BYTES
        + F.aggregate("window", F.lit(0), lambda n, w: n + F.octet_length(w) + WORD_BYTES)
        + F.size("classes") * 64
    )
    measured = windows.agg(size.alias("b"), F.collect_set(F.least(F.size("window"), F.lit(SHINGLE_WORDS))).alias("k")).first()
    sizes = sorted(measured["k"]) or [SHINGLE_WORDS]
    small = fits_broadcast(docs.sparkSession, measured["b"] or 0)

    texts = doc_texts(docs)
    worded = texts.select("doc_id", F.md5("text").alias("digest"), words_of(F.col("text")).alias("words"))
    chosen = settled(prefixes(worded, windows, sizes, small), ws, "prefixes")
    # The closing row of each document meets this one row, so every document has a row in the result.
    closing = docs.sparkSession.range(1).select(
        F.lit(None).cast("array<string>").alias("window"),
        F.lit(None).cast("array<string>").alias("classes"),
        F.lit(0).alias("place"),
        F.lit(0).cast("long").alias("token"),
    )
    begin = F.col("at") - F.col("place")
    length = F.size("window")
    fits = (begin >= 0) & (begin + length <= F.size("words"))
    found = F.col("window").isNull() | (fits & (F.slice("words", begin + 1, length) == F.col("window")))
    keep = ["doc_id", "digest", F.size("words").alias("n_words"), F.when(F.col("window").isNotNull(), begin).alias("begin"), length.alias("length"), "classes"]
    wanted = chosen.union(closing).withColumnRenamed("token", "t")
    if small:
        rows = _positions(worded, ["doc_id", "digest", "words"], sizes, "")
        met = rows.join(F.broadcast(wanted), (F.col("token") == F.col("t")) & _verified(begin, found))
        return met.select(*keep), items
    # A large benchmark: shingles and prefixes are shuffled without the words; candidates go back to their documents. The
    # closing rows are no one's candidates: they are put beside the hits, a row per document row, and copies count as such.
    rows = _positions(worded, ["doc_id", "digest"], sizes, "", closed=False)
    candidates = rows.join(chosen, "token").select(row_key(F.col("doc_id"), F.col("digest")).alias("r"), "at", "window", "classes", "place")
    whole = worded.withColumn("r", row_key(F.col("doc_id"), F.col("digest"))).dropDuplicates(["r"])
    met = candidates.join(whole, "r").where(fits & (F.slice("words", F.greatest(begin, F.lit(0)) + 1, length) == F.col("window")))
    nothing = worded.select(
        "doc_id",
        "digest",
        F.size("words").alias("n_words"),
        F.lit(None).cast("int").alias("begin"),
        F.lit(None).cast("int").alias("length"),
        F.lit(None).cast("array<string>").alias("classes"),
    )
    return met.select(*keep).union(nothing), items


def _verified(begin: Column, found: Column) -> Column:
    # The bound comes first: slice() refuses a start below 1.
    return F.when(F.col("window").isNull(), F.lit(True)).when(begin < 0, F.lit(False)).otherwise(found)


def contamination(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> DataFrame:
    """Per document row ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, and ``digest`` (MD5 of its text)."""
    hits, items = window_hits(docs, benchmark, ws)
    span = F.when(F.col("begin").isNotNull(), F.struct(F.col("begin").cast("long").alias("a"), (F.col("begin") + F.col("length")).cast("long").alias("b")))
    per_doc = settled(
        hits.groupBy("doc_id", "digest").agg(
            F.first("n_words").cast("long").alias("n_words"),
            F.count(F.when(F.col("begin").isNull(), 1)).alias("copies"),
            F.sort_array(F.collect_set(span)).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("classes"))).alias("classes"),
        ),
        ws,
        "per_doc",
    )
    # Words covered by spans in order of their start: what each adds beyond the furthest end so far.
    nothing = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    added = F.aggregate(
        "spans",
        nothing,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["b"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(s["end"], x["a"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    dirty = per_doc.where(F.size("classes") > 0).select("doc_id", "digest", F.explode("classes").alias("class"))
    named = dirty.join(items, "class").groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    named = named.withColumnsRenamed({"doc_id": "d", "digest": "g"})
    joined = per_doc.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    out = joined.select(
        "doc_id",
        "digest",
        "n_words",
        added.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        "copies",
    ).withColumn("contaminated", F.col("n_hit") > 0)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("__copy", "copies")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    name = free_name(docs, "__row")
    bad = contamination(docs, benchmark, ws).where("contaminated")
    bad = bad.select(row_key(F.col("doc_id"), F.col("digest")).alias(name)).distinct()
    marked = docs.withColumn(name, row_key(col("doc_id"), F.md5(text_or_empty())))
    return marked.join(bad, name, "left_anti").select(*map(col, docs.columns))
