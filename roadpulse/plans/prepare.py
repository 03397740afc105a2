"""Preparation jobs: raw CSV -> split, partitioned Parquet; time-sorted
compaction of a partitioned readings root."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.prepare import downcast as downcast_measures
from ..operators.prepare import in_range, with_partitions
from ..sources.readers import read_readings_csv
from ..sources.writers import compact_sorted

# Rows that one task of a compaction sorts.
SORTED_ROWS = 500_000
# Files that a task of the ingest keeps open; with more months it sorts the rest.
OPEN_MONTHS = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def ingest(spark: SparkSession, csv_path: str, out_root: str, historical: tuple, replay: tuple,
           downcast: bool = True) -> dict[str, int]:
    """Split raw readings into the historical and replay sets in one pass.

    Writes ``out_root/split=historical|replay/year=/month=`` (a row in both
    ranges is written to both), replacing all of ``out_root``: a re-run with
    other ranges leaves nothing behind. The rows are rebalanced by month before
    the write: a month is a few files of the advisory size, a hot month is split
    by AQE. Returns the row counters, gathered by an ``Observation`` during the
    same pass (no extra scan).
    """
    raw = read_readings_csv(spark, csv_path)
    obs = Observation("ingest")
    hist, rep = in_range(*historical), in_range(*replay)
    observed = raw.observe(obs, F.count(F.lit(1)).alias("total_rows"),
                           F.count_if(hist).alias("historical_rows"),
                           F.count_if(rep).alias("replay_rows"))
    labels = F.filter(F.array(F.when(hist, F.lit("historical")), F.when(rep, F.lit("replay"))),
                      lambda x: x.isNotNull())
    out = with_partitions(observed.select("*", F.explode(labels).alias("split")))
    if downcast:
        out = downcast_measures(out)
    # A rebalanced part holds few months: open files for them instead of a sort that spills.
    held = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(max(int(held), OPEN_MONTHS)))
    try:
        (out.hint("rebalance", "split", "year", "month")
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option("compression", "snappy").partitionBy("split", "year", "month").parquet(out_root))
    finally:
        spark.conf.set(_WRITERS, held)
    return {k: int(v) for k, v in obs.get.items()}


def compact_raw(spark: SparkSession, src_root: str, dst_root: str,
                max_records_per_file: int = 5_000_000,
                row_group_bytes: int = 128 * 1024 * 1024) -> None:
    """Rewrite a ``year=/month=`` readings root (of either ingest) as time-sorted files."""
    if src_root.rstrip("/") == dst_root.rstrip("/"):
        raise ValueError("compaction must write to a different root than it reads")
    rows = spark.read.parquet(src_root)
    # Sized by rows: parts of the advisory size hold so many well compressed rows that their sort spills.
    parts = max(1, -(-rows.count() // SORTED_ROWS))
    compact_sorted(rows.drop("source"), dst_root, num_partitions=parts, max_records_per_file=max_records_per_file,
                   row_group_bytes=row_group_bytes)
