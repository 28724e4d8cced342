"""New vintages and decisions as streams of files; the checkpoint is the cursor."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.readers import DECISION


class Folder:
    """The few things that a cursor needs of a folder in any of Spark's stores."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.home = spark.sparkContext._jvm, path
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):  # noqa: ANN201
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.home}/{name}" if name else self.home)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(""))] if self.fs.exists(self.at("")) else []

    def mark(self, name: str) -> None:
        self.fs.create(self.at(name), True).close()


def vintages(spark: SparkSession, root: str) -> list[str]:
    """The ``source_version=`` folders under a root, in order; those without files too."""
    return sorted({m[1] for name in Folder(spark, root).names() if (m := re.fullmatch(r"source_version=(.+)", name))})


def on_new_vintage(spark: SparkSession, root: str, checkpoint: str, run: Callable[[str], None]) -> StreamingQuery:
    """Call ``run(vintage)`` once for each unseen ``source_version=`` folder that has files, then stop.

    The vintage is the cursor: one that was run is marked beside the checkpoint, and files that come later to it
    fire nothing.  A driver lost between run and mark runs it again, so ``run`` must replace what it wrote.
    Nothing starts on import.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).load(root)
    versions = files.select(F.regexp_extract("path", r"/source_version=([^/]+)/", 1).alias("vintage")).where("vintage <> ''")
    marks = Folder(spark, f"{checkpoint}/vintages")

    def each(batch: DataFrame, _: int) -> None:
        done = set(marks.names())
        for r in batch.distinct().orderBy("vintage").collect():  # one row per folder
            if quote(r["vintage"], "") not in done:
                run(r["vintage"])
                marks.mark(quote(r["vintage"], ""))

    return versions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batches_of(spark: SparkSession, target: str) -> list[int]:
    """The batches whose snapshots are whole, in order."""
    home = Folder(spark, target)
    return sorted(n for name in home.names() if (m := re.fullmatch(r"batch-(\d+)", name)) for n in [int(m[1])] if home.fs.exists(home.at(f"{name}/_SUCCESS")))


def latest_decisions(spark: SparkSession, target: str) -> DataFrame:
    """The newest whole snapshot of ``decisions_by_pair``."""
    if not (known := batches_of(spark, target)):
        raise ValueError(f"no decisions in {target}")
    return spark.read.parquet(f"{target}/batch-{known[-1]}").drop("order")


def decisions_by_pair(spark: SparkSession, folder: str, checkpoint: str, target: str) -> StreamingQuery:
    """Keep the latest decision of each pair while log files arrive: a snapshot ``batch-<number>`` in ``target`` for each batch.

    Nothing is replaced in place: a batch reads the snapshot before it and writes its own, and a replayed
    one does the same again, so that a driver lost at any time loses no decision.  Of a pair's lines the
    last one counts: by batch, by file (time, then name) and by line.  The snapshot before last goes.
    """
    lines = spark.readStream.text(folder).select(
        F.from_json("value", DECISION).alias("d"),
        F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")).alias("place"),
    )
    lines = lines.where("d.pair_id is not null").select("d.*", "place")

    def merge(batch: DataFrame, number: int) -> None:
        fresh = batch.withColumn("order", F.struct(F.lit(number).cast("bigint").alias("batch"), "place", F.monotonically_increasing_id().alias("line"))).drop("place")
        before = [n for n in batches_of(spark, target) if n < number]
        both = spark.read.parquet(f"{target}/batch-{before[-1]}").unionByName(fresh) if before else fresh
        rest = [c for c in both.columns if c != "pair_id"]
        latest = both.groupBy("pair_id").agg(F.max_by(F.struct(*rest), "order").alias("d")).select("pair_id", "d.*")
        latest.write.mode("overwrite").parquet(f"{target}/batch-{number}")
        home = Folder(spark, target)
        for n in before[:-1]:
            home.fs.delete(home.at(f"batch-{n}"), True)

    return lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
