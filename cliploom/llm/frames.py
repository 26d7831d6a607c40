"""Columns by any name, and tables in the shared folder that are removed after use."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def named(df: DataFrame, name: str) -> Column:
    """The column of this very name, dots and all."""
    return df[quoted(name)]


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores as it takes to be no column of df."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def numbered(df: DataFrame) -> DataFrame:
    """df with columns c0, c1, ... in its order; toDF(*names) gives the names back. Spark's maps over Arrow batches take no others than plain names."""
    return df.select(*[named(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)])


def slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) of all rows."""
    return docs.select(named(docs, id_col).cast("long").alias("doc_id"), named(docs, text_col).cast("string").alias("text"))


_made: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset, one of this machine where all runs on it, as in tests, and an error on a cluster.

    What is made in a `scratch` block is removed at its end, all else when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/cliploom"  # one machine, so all that run share it
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def _remove(some: list[tuple[SparkSession, str]]) -> None:
    for spark, path in some:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def scratch(keep: list[str]) -> Iterator[None]:
    """Removes the folders made within it at its end, but those in keep (to which the block may add)."""
    since = len(_made)
    try:
        yield
    finally:
        gone = [x for x in _made[since:] if x[1] not in keep]
        _made[since:] = [x for x in _made[since:] if x[1] in keep]
        _remove(gone)


def discard(path: str) -> None:
    """Removes a folder that is no longer needed."""
    gone = [x for x in _made if x[1] == path]
    _made[:] = [x for x in _made if x[1] != path]
    _remove(gone)


@atexit.register
def _remove_all() -> None:
    with contextlib.suppress(Exception):  # the session may be gone with its gateway
        _remove(_made)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that is run within go when it ends, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage and its shuffle files end, and its size is known when joins are planned."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_as_struct(docs: DataFrame, without: str) -> Column:
    """All columns of docs but one as a struct; a filler where there is no other."""
    return F.struct(*([named(docs, c) for c in docs.columns if c != without] or [F.lit(0).alias("_")]))
