"""Incremental preparation: raw CSV files are taken as they arrive.

The folder of CSV files is a streaming file source with an ``availableNow``
trigger: its checkpoint is the ledger of the files taken, and a batch that
failed is run again with the same files. Each file's rows go to partitions of
their own (``split``, ``year``, ``month``, ``source``), which a repeated batch,
or a run with a new checkpoint, overwrites: no file counts twice, none is lost.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.prepare import downcast as downcast_measures
from ..operators.prepare import in_range, with_partitions
from ..sources.readers import read_readings_csv
from ..streaming.live import MAX_FILE_AGE, run_id

LEDGER = "_ledger"
COUNTERS = ("total_rows", "historical_rows", "replay_rows")
_LEDGER_SCHEMA = "path string, " + ", ".join(f"{c} long" for c in COUNTERS)


def new_files(spark: SparkSession, root: str, max_files: int, pattern: str = "*.csv*", by_name: bool = False) -> DataFrame:
    """The files under ``root`` as a stream of paths; their contents are not read."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("maxFilesPerTrigger", str(int(max_files))).option("maxFileAge", MAX_FILE_AGE)
            .option("fileNameOnly", str(by_name).lower()).option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(root).select("path"))


class _Ingest:
    """``foreachBatch`` writer of one batch of files."""

    def __init__(self, out_root: str, run: str, historical: tuple, replay: tuple, downcast: bool, by_name: bool):
        self.out_root, self.run = out_root.rstrip("/"), run
        self.historical, self.replay, self.downcast, self.by_name = historical, replay, downcast, by_name
        self.counted: dict[int, dict[str, int]] = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = sorted(r["path"] for r in batch.collect())  # at most max_files
        if not paths:
            return
        # Columns are found by header name; files of one header are read together.
        by_header: dict[tuple, list[str]] = defaultdict(list)
        for path in paths:
            by_header[tuple(spark.read.option("header", "true").csv(path).columns)].append(path)
        rows = []
        for group in by_header.values():
            counts = self.write(read_readings_csv(spark, group, source="source_file"))
            rows.append((group, counts))
        total = {c: sum(n[c] for _, n in rows) for c in COUNTERS}
        # The batch's files, with the counts of their group of equal headers on its first.
        entries = [(path, *(n[c] if i == 0 else 0 for c in COUNTERS)) for group, n in rows for i, path in enumerate(group)]
        (spark.createDataFrame(entries, _LEDGER_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.out_root}/{LEDGER}/run={self.run}/batch={batch_id}"))
        self.counted[batch_id] = total

    def write(self, raw: DataFrame) -> dict[str, int]:
        obs = Observation()
        hist, rep = in_range(*self.historical), in_range(*self.replay)
        observed = raw.observe(obs, F.count(F.lit(1)).alias("total_rows"), F.count_if(hist).alias("historical_rows"),
                               F.count_if(rep).alias("replay_rows"))
        labels = F.filter(F.array(F.when(hist, F.lit("historical")), F.when(rep, F.lit("replay"))), lambda x: x.isNotNull())
        file = F.regexp_extract("source_file", "[^/]*$", 0) if self.by_name else F.col("source_file")
        out = with_partitions(observed.select("*", F.explode(labels).alias("split"), F.md5(file).alias("source")).drop("source_file"))
        out = downcast_measures(out) if self.downcast else out
        keys = ["split", "year", "month", "source"]
        (out.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "snappy").partitionBy(*keys).parquet(self.out_root))
        return {k: int(v) for k, v in obs.get.items()}


def ingest_new(spark: SparkSession, csv_root: str, out_root: str, checkpoint: str, historical: tuple, replay: tuple,
               downcast: bool = True, max_files: int = 100, by_name: bool = False) -> dict[str, int]:
    """Take the CSV files under ``csv_root`` that the checkpoint doesn't know
    yet into ``out_root/split=/year=/month=/source=``, at most ``max_files`` a
    batch. Returns the row counters of this call. ``by_name``: a file of a known
    name is not taken again from another folder. What earlier files gave stays.
    """
    writer = _Ingest(out_root, run_id(spark, checkpoint), historical, replay, downcast, by_name)
    query = (new_files(spark, csv_root, max_files, by_name=by_name).writeStream.foreachBatch(writer)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return {c: sum(n[c] for n in writer.counted.values()) for c in COUNTERS}


def read_ledger(spark: SparkSession, out_root: str) -> DataFrame:
    """Files taken, with ``run`` and ``batch``."""
    return spark.read.schema(f"{_LEDGER_SCHEMA}, run string, batch long").parquet(f"{out_root.rstrip('/')}/{LEDGER}")

