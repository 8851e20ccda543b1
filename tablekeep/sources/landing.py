"""Landing raw files: an increment goes, unparsed, into its own folder of the raw zone."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeep.session import col
from tablekeep.sources.files import file_listing

FROM_FILE = "from_file"
GROUP_BYTES = 64 * 1024**3

# One line per source file that has landed whole.
MANIFEST = (
    "increment string, source_path string, from_file string, bytes bigint, n_lines bigint, checksum decimal(38,0), landed_at timestamp"
)


class IncompleteCopyError(ValueError):
    """What was landed is not what the source file holds."""


def land_increment(
    spark: SparkSession, source: str, raw_dir: str, increment: str, compression: str | None = None
) -> str:
    """Copy the lines of ``source`` unchanged into ``raw_dir/increment`` and return that folder.

    The copy is a plain scan and write without a shuffle. An increment lands once: a second copy under the same name is
    refused, so that a stream over the raw zone never sees a file twice. ``land_files`` goes on where a copy broke off.
    """
    target = f"{raw_dir.rstrip('/')}/{increment}"
    lines = _lines(spark, source)
    writer = lines.write.mode("errorifexists").option("lineSep", "\n")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(target)
    return target


def _lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.options(lineSep="\n", recursiveFileLookup="true").text(list(paths))


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The source files that have landed, in whatever increments; none where there is no manifest yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(manifest)
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def land_files(
    spark: SparkSession,
    source: str,
    raw_dir: str,
    increment: str,
    manifest: str,
    compression: str | None = None,
    group_bytes: int = GROUP_BYTES,
) -> int:
    """Copy the files below ``source`` that the manifest does not have yet, and return how many they were.

    Lines go unchanged into ``raw_dir/increment/from_file=<id>``, a folder per source file, group by group of some
    ``group_bytes``. A group is compared with its source (lines, and a checksum that does not depend on their order), and
    only then are its files in the manifest. So a run that breaks off loses a group at most; the next one goes on with the
    files that lack, in place of whatever was left of them, and one with nothing new lands nothing. A file that has changed
    its length under the same path is another file; one without bytes is none. Read the folders with ``recursiveFileLookup``, and a stream over them
    only once this has returned.
    """
    target = f"{raw_dir.rstrip('/')}/{increment}"
    done = read_manifest(spark, manifest).where(F.col("increment") == increment)
    listed = file_listing(spark, source).select(F.col("path").alias("source_path"), F.col("length").alias("bytes"))
    lacking = listed.join(done.select("source_path", "bytes"), ["source_path", "bytes"], "left_anti")
    landed = 0
    # A row per file that is about to be copied, as for any listing of a scan.
    for group in _groups(lacking.orderBy("source_path").collect(), group_bytes):
        _land_group(spark, {r["source_path"]: r["bytes"] for r in group}, target, increment, manifest, compression)
        landed += len(group)
    return landed


def _groups(files: list, group_bytes: int) -> list[list]:
    out, size = [], 0
    for r in files:
        if not out or size + r["bytes"] > group_bytes:
            out.append([])
            size = 0
        out[-1].append(r)
        size += r["bytes"]
    return out


def _land_group(
    spark: SparkSession, sizes: dict[str, int], target: str, increment: str, manifest: str, compression: str | None
) -> None:
    path = F.col("_metadata.file_path")
    file_id = F.substring(F.sha2(path, 256), 1, 24).alias(FROM_FILE)
    lines = _lines(spark, *sizes).select("value", file_id)
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n")
    if compression:
        writer = writer.option("compression", compression)
    writer.partitionBy(FROM_FILE).text(target)

    given = _measured(_lines(spark, *sizes).select("value", path.alias("source_path"), file_id), "source_path", FROM_FILE)
    folders = [r[FROM_FILE] for r in given.where("n_lines > 0").select(FROM_FILE).collect()]
    landed_id = F.regexp_extract(path, FROM_FILE + "=([0-9a-f]+)/", 1).alias(FROM_FILE)
    there = _lines(spark, *(f"{target}/{FROM_FILE}={f}" for f in folders)) if folders else lines.where("false").select("value")
    held = _measured(there.select("value", landed_id) if folders else lines.where("false"), FROM_FILE)
    same = (F.col("given.n_lines") == F.col("held.n_lines")) & (F.col("given.checksum") == F.col("held.checksum"))
    pairs = given.alias("given").join(held.alias("held"), FROM_FILE, "left")
    bad = pairs.where(~F.coalesce(same, F.lit(False))).select("source_path").first()
    if bad is not None:
        raise IncompleteCopyError(f"{bad['source_path']} has not landed whole in {target}")

    listed = spark.createDataFrame(list(sizes.items()), "source_path string, bytes bigint")
    entries = listed.join(given, "source_path", "left").select(
        F.lit(increment).alias("increment"),
        "source_path",
        FROM_FILE,
        "bytes",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("checksum", F.lit(0)).cast("decimal(38,0)").alias("checksum"),
        F.lit(int(time.time())).cast("timestamp").alias("landed_at"),
    )
    entries.coalesce(1).write.mode("append").parquet(manifest)


def _measured(lines: DataFrame, *by: str) -> DataFrame:
    """Lines, and the sum of their hashes, per file: partial sums first, a row per task and file in the shuffle."""
    checksum = F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("decimal(38,0)")
    return lines.groupBy(*map(col, by)).agg(F.count("*").alias("n_lines"), checksum.alias("checksum"))

