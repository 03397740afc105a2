"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the cluster's shared checkpoint folder
    and read it back. Unlike ``checkpoint()`` the plan runs once, and the
    planner knows the size of the result (a join broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete the folders of frames that ``cut`` returned, once nothing reads
    them any more. Other frames are left alone."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            spark = df.sparkSession
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
            df._cut_path = None


def whole_rows(docs: DataFrame) -> Column:
    """All columns as one struct, so that no name clashes with an operator's own."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])


def unpacked(docs: DataFrame, row: str = "row") -> list[Column]:
    """The columns of ``docs`` from its struct."""
    return [F.col(row).getField(c).alias(c) for c in docs.columns]


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it often
    while it is computed once per row (an alias may be inlined into every use
    by the optimizer)."""
    return F.transform(F.array(value), body)[0]


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was
    started: Spark distributes a zip of its sources, once per context."""
    context = spark.sparkContext
    if not getattr(context, "_roadpulse_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="roadpulse-src-"), "roadpulse_src")
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        context._roadpulse_shipped = True
