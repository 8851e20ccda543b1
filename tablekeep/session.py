"""Helpers on a given session: the shared folder, a scratch workspace, identifiers.

Nothing here stops a session or changes its settings; only ``local_session`` (for tests and the bench) builds one.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(name: str) -> str:
    """``db.table`` with each part quoted."""
    return ".".join(quote(part) for part in name.split("."))


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col(quote(name))


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="tablekeep-")
    atexit.register(_remove_local, made)
    return made


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, so that it is not computed again and all its uses agree."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def local_conf(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session beside the caller's with other settings, which leaves the caller's alone."""
    other = spark.newSession()
    for key, value in settings.items():
        other.conf.set(key, value)
    return other


def with_conf(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """As ``local_conf``, with the caller's own settings otherwise."""
    own = {k: v for k, v in spark.conf.getAll.items() if spark.conf.isModifiable(k)}
    return local_conf(spark, {**own, **settings})


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all that is in it, on whatever file system it lies; one that is not there is fine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class Workspace:
    """A scratch area in the shared folder: files under ``path`` and tables in a database of its own.

    A ``name`` of the caller's makes it an area to come back to, such as that of a job that is run again.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, name: str | None = None):
        self.spark = spark
        self.name = name or "tablekeep_" + uuid.uuid4().hex[:12]
        self.root = (root or shared_dir(spark)).rstrip("/") + "/" + self.name
        self._has_database = False
        # Results are lazy, so the files must outlive the call that made them.
        if spark.sparkContext.master.startswith("local"):
            atexit.register(_remove_local, self.root)

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def table(self, name: str) -> str:
        if not self._has_database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(self.name)} LOCATION {text_literal(self.path('db'))}")
            self._has_database = True
        return f"{self.name}.{name}"

    def close(self) -> None:
        """Drop the tables and, on a local session, the files."""
        if self._has_database:
            self.spark.sql(f"DROP DATABASE IF EXISTS {quote(self.name)} CASCADE")
            self._has_database = False
        if self.spark.sparkContext.master.startswith("local"):
            _remove_local(self.root)


def _remove_local(root: str) -> None:
    path = root.removeprefix("file://").removeprefix("file:")
    if os.path.isdir(path):
        shutil.rmtree(path, ignore_errors=True)


def local_session(cpus: str | int = "*", app: str = "tablekeep", conf: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
