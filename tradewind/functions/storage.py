"""Cutting lineage through the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a query when the query ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written in the steps under way, the innermost last.
_steps: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A session on one machine, which has nobody to share with, may leave the setting out: it
    gets a folder of its own, put into the setting once. Any other session must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = "file://" + tempfile.mkdtemp(prefix="tradewind-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses neither recompute it
    nor depend on executors that may be lost, and its row count comes from footers."""
    path = fresh_path(df.sparkSession, label)
    if _steps:
        _steps[-1].append(path)
    with settings(df.sparkSession, {SHUFFLES_GO: "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` hold for the queries begun here. Shuffle files of a stored table may go: nothing reads them again."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, stored; the tables that it stored on the way are removed."""
    _steps.append([])
    try:
        rows = build()
        path = fresh_path(spark, label)
        with settings(spark, {SHUFFLES_GO: "true"}):
            rows.write.parquet(path)
    finally:
        for used in _steps.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(used)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
    if _steps:
        _steps[-1].append(path)
    out = spark.read.schema(rows.schema).parquet(path)
    vars(out)["_tradewind_stored"] = True
    return out


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``stored``, but a frame that is such a table already is returned as it is."""
    if vars(df).get("_tradewind_stored"):
        return df
    out = stored(df, label)
    vars(out)["_tradewind_stored"] = True
    return out
