"""Snapshotted tables in a folder: a write makes a new snapshot and then a new pointer to it; nothing is replaced in place."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NAMESPACES = ("raw", "geo", "resolution", "staging", "marts")


@dataclass(frozen=True)
class LakeConfig:
    root: str
    namespaces: tuple[str, ...] = NAMESPACES


class Lake:
    """Tables as ``root/namespace/name/v<number>``; of the pointers ``current-<number>.json`` the largest names the snapshot.

    Folders are reached through Hadoop's file system, so any store of Spark's will do.
    """

    def __init__(self, spark: SparkSession, config: LakeConfig) -> None:
        self.spark, self.config = spark, config
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(config.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, text: str):  # noqa: ANN201
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def home(self, namespace: str, name: str) -> str:
        if namespace not in self.config.namespaces:
            raise ValueError(f"no namespace {namespace!r}; there are {self.config.namespaces}")
        return f"{self.config.root}/{namespace}/{name}"

    def children(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def snapshots(self, namespace: str, name: str) -> list[int]:
        return sorted(int(m[1]) for c in self.children(self.home(namespace, name)) if (m := re.fullmatch(r"v(\d+)", c)))

    def pointer(self, namespace: str, name: str) -> dict | None:
        numbers = self.pointers(namespace, name)
        return json.loads(self.spark.read.text(f"{self.home(namespace, name)}/current-{numbers[-1]}.json", wholetext=True).first()[0]) if numbers else None

    def pointers(self, namespace: str, name: str) -> list[int]:
        return sorted(int(m[1]) for c in self.children(self.home(namespace, name)) if (m := re.fullmatch(r"current-(\d+)\.json", c)))

    def point(self, namespace: str, name: str, state: dict) -> None:
        """A new pointer, there at once or not at all; those before the last one go."""
        before = self.pointers(namespace, name)
        at = f"{self.home(namespace, name)}/current-{max(before, default=0) + 1}.json"
        out = self.fs.create(self.path(at + ".new"), True)
        out.write(bytearray(json.dumps(state), "utf-8"))
        out.close()
        if not self.fs.rename(self.path(at + ".new"), self.path(at)):
            raise ValueError(f"{at} is there already: another writer was first")
        for n in before[:-1]:
            self.fs.delete(self.path(f"{self.home(namespace, name)}/current-{n}.json"), False)

    def write(self, df: DataFrame, namespace: str, name: str, partition_by: tuple[str, ...] = (), evolve: bool = False) -> int:
        """Replace the table.  Columns and types are frozen from the first write on, unless ``evolve``."""
        before = self.pointer(namespace, name)
        if before and not evolve:
            kind = lambda s: {f.name: f.dataType.simpleString() for f in s}
            old, new = kind(StructType.fromJson(before["schema"])), kind(df.schema)
            if old != new:
                raise ValueError(f"{namespace}.{name} is frozen: lost {sorted(set(old) - set(new))}, new {sorted(set(new) - set(old))}, changed {sorted(c for c in old if c in new and old[c] != new[c])}")
        number = max(self.snapshots(namespace, name), default=0) + 1
        writer = df.write.mode("error")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.home(namespace, name)}/v{number}")
        self.point(namespace, name, {"snapshot": number, "schema": df.schema.jsonValue()})
        return number

    def read(self, namespace: str, name: str, snapshot: int | None = None) -> DataFrame:
        state = self.pointer(namespace, name)
        if state is None:
            raise ValueError(f"no table {namespace}.{name}")
        if snapshot is not None:
            return self.spark.read.parquet(f"{self.home(namespace, name)}/v{snapshot}")
        return self.spark.read.schema(StructType.fromJson(state["schema"])).parquet(f"{self.home(namespace, name)}/v{state['snapshot']}")

    def register(self, namespace: str, name: str, snapshot: int | None = None) -> None:
        """Point at the newest snapshot by number, or at the one named."""
        have = self.snapshots(namespace, name)
        number = snapshot or max(have, default=0)
        if number not in have:
            raise ValueError(f"{namespace}.{name} has no snapshot {number}; it has {have}")
        self.point(namespace, name, {"snapshot": number, "schema": self.read_at(namespace, name, number).schema.jsonValue()})

    def read_at(self, namespace: str, name: str, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.home(namespace, name)}/v{number}")

    def tables(self) -> list[tuple[str, str]]:
        return [(n, t) for n in self.config.namespaces for t in self.children(f"{self.config.root}/{n}") if self.pointer(n, t)]

    def create_views(self) -> list[str]:
        """A view ``namespace_name`` for every table; an empty lake is an error."""
        if not (tables := self.tables()):
            raise ValueError(f"the lake at {self.config.root} has no table")
        for n, t in tables:
            self.read(n, t).createOrReplaceTempView(f"{n}_{t}")
        return [f"{n}_{t}" for n, t in tables]

    def counts(self) -> DataFrame:
        out = self.spark.createDataFrame([], "namespace string, name string, rows long")
        for n, t in self.tables():
            out = out.union(self.read(n, t).agg(F.lit(n), F.lit(t), F.count("*")))
        return out
