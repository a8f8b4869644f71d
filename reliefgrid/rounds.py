"""Tables that outlive one plan: Parquet in the folder all executors share.

A loop writes what one round made and reads it back, so the next round's plan
starts at files that survive a lost executor. A table that a later one replaces
is deleted. A journal also outlives a lost driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_rounds").rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark can reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class Rounds:
    """The tables of one job, each in its own folder below the shared one."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"
        self._paths: dict[str, str] = {}
        self.count = 0

    def put(self, df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
        """Write ``df`` under ``label``, with the writer's ``options``; an earlier table of that label goes once this one is whole."""
        self.count += 1
        path = f"{self.base}/{label}-{self.count}"
        df.write.options(**(options or {})).parquet(path)
        if old := self._paths.get(label):
            delete(self.spark, old)
        self._paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def again(self, label: str) -> DataFrame:
        """A table read anew, for joins of a table with itself."""
        return self.spark.read.parquet(self._paths[label])

    def drop(self, *labels: str) -> None:
        for label in labels:
            delete(self.spark, self._paths.pop(label))

    def clear(self) -> None:
        """Delete every table of the job."""
        self._paths.clear()
        delete(self.spark, self.base)


class Journal:
    """The state of a job after its last whole round, from which a later run goes on.

    A round first writes its tables, each to a new path, and last its entry: the number
    of the round and every table of the state with path and schema. What a broken round
    left behind is named by no entry and is deleted by the next run. Tables that a new
    entry no longer names are deleted once it is whole.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: dict | None = None):
        """Opens the journal in ``folder``; one of another job's ``settings`` raises."""
        self.spark, self.base = spark, folder.rstrip("/")
        self.settings = json.dumps(settings or {}, sort_keys=True)
        self.number = -1  # of the last whole round
        self._held: dict[str, tuple[str, str]] = {}  # label -> (path, "" for a table without rows; schema)
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())
        self._open()

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _names(self) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._path(self.base))] if self._exists(self.base) else []

    def _open(self) -> None:
        whole = [n for n in self._names() if n.startswith("entry-") and self._exists(f"{self.base}/{n}/_SUCCESS")]
        if whole:
            rows = self.spark.read.parquet(f"{self.base}/{max(whole)}").collect()  # a row per table of the state
            if rows[0]["settings"] != self.settings:
                raise ValueError(f"the journal in {self.base} is of a job with settings {rows[0]['settings']}, not {self.settings}")
            self.number = rows[0]["number"]
            self._held = {r["label"]: (r["path"], r["schema"]) for r in rows}
        self._tidy(max(whole, default=""))

    def _tidy(self, entry: str) -> None:
        held = [path[len(self.base) + 1:] for path, _ in self._held.values() if path]
        for name in self._names():
            parts = [h.split("/", 1)[1] for h in held if h.startswith(f"{name}/")]
            if name == entry or name in held:
                continue
            if not parts:
                delete(self.spark, f"{self.base}/{name}")
                continue
            for inner in self._fs.listStatus(self._path(f"{self.base}/{name}")):  # the two halves of a split table
                if inner.isDirectory() and inner.getPath().getName() not in parts:
                    delete(self.spark, f"{self.base}/{name}/{inner.getPath().getName()}")

    def labels(self, prefix: str) -> list[str]:
        return sorted(label for label in self._held if label.startswith(prefix))

    def table(self, label: str) -> DataFrame:
        path, schema = self._held[label]
        kind = StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(path) if path else self.spark.createDataFrame([], kind)

    def put(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df``; it is part of the state once the round is closed."""
        path = f"{self.base}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self._held[label] = (path, df.schema.json())
        return self.table(label)

    def put_split(self, df: DataFrame, flag: str, label: str, other: str) -> DataFrame:
        """Write ``df`` once; rows whose ``flag`` is true become ``label``, the rest, if any, ``other``."""
        path = f"{self.base}/{label}-{uuid.uuid4().hex}"
        df.write.partitionBy(flag).parquet(path)
        schema = df.drop(flag).schema.json()
        for name, value in ((label, "true"), (other, "false")):
            part = f"{path}/{flag}={value}"
            if self._exists(part):
                self._held[name] = (part, schema)
            elif name == label:
                self._held[name] = ("", schema)
        return self.table(label)

    def close(self) -> None:
        """The tables put so far are the state after one more round."""
        self.number += 1
        rows = [(self.number, self.settings, label, path, schema) for label, (path, schema) in self._held.items()]
        entry = f"entry-{self.number:09d}"
        if self._exists(f"{self.base}/{entry}"):  # broken off while it was written
            delete(self.spark, f"{self.base}/{entry}")
        kind = "number int, settings string, label string, path string, schema string"
        self.spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{self.base}/{entry}")
        # object stores and jobs without a marker file: an entry counts once its marker is there
        if not self._exists(f"{self.base}/{entry}/_SUCCESS"):
            self._fs.create(self._path(f"{self.base}/{entry}/_SUCCESS")).close()
        self._tidy(entry)

    def clear(self) -> None:
        """Delete the journal with all its tables."""
        self._held.clear()
        delete(self.spark, self.base)
