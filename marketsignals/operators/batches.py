"""Parquet tables that a run publishes batch by batch, all of them at once.

A batch writes its rows of every table into folders of its own attempt
(``<table>/batch_id=<n>/attempt=<id>``), which nobody reads yet.  One small file,
``commits/<kind>-<n>.json``, then names these folders and the highest id that each
table has reached; it appears by one atomic rename.  Readers resolve the commits,
so they see a batch whole or not at all, also while it is replaced by a replay
(the new commit names the new folders).  What a crash leaves behind is named by no
commit, and ``vacuum`` removes it.

The commit file is also the ledger of ids: the next batch goes on after the
highest id of the latest earlier commit, without reading a table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = "batch_id long, kind string, tables map<string,string>, last_ids map<string,bigint>"


@dataclass
class Attempt:
    """The folders that one attempt at a batch has written."""

    batch_id: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, str] = field(default_factory=dict)
    last_ids: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)      # of tables with ids, as their writes observed them


class BatchStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self, kind: str | None = None, before: int | None = None) -> list[dict]:
        """Commits in batch order (one small row a batch)."""
        try:
            rows = self.spark.read.schema(_COMMIT).json(f"{self.root}/commits").collect()
        except AnalysisException as e:      # no batch was committed so far
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        found = [r.asDict() for r in rows if kind in (None, r["kind"]) and (before is None or r["batch_id"] < before)]
        return sorted(found, key=lambda c: c["batch_id"])

    def last_ids(self, before: int, kind: str = "batch") -> dict[str, int]:
        """The highest id of each table that batches before ``before`` have given."""
        found = self.commits(kind, before)
        return dict(found[-1]["last_ids"] or {}) if found else {}

    def stage(self, df: DataFrame, table: str, attempt: Attempt, by: str | None = None, base: int | None = None) -> None:
        """Write the rows of an attempt; ``by`` names a column whose values get a folder each.

        With ``base``, the highest id before this attempt, the write itself observes how many rows it has and
        their highest id, which the attempt then knows without a job of its own.
        """
        place = f"batch_id={attempt.batch_id}/attempt={attempt.name}"
        df, seen = df.drop("batch_id"), Observation()
        if base is not None:
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("id").alias("last"))
        (df.write.partitionBy(by) if by else df.write).mode("overwrite").parquet(f"{self.root}/{table}/{place}")
        attempt.tables[table] = place
        if base is not None:     # a write of no partition observes nothing
            attempt.rows[table] = seen.get.get("rows") or 0
            attempt.last_ids[table] = seen.get.get("last") or base

    def staged(self, table: str, attempt: Attempt, schema: T.StructType) -> DataFrame:
        """The rows that an attempt has written, read back before they are published."""
        return self._folders(table, [attempt.tables[table]], schema)

    def commit(self, attempt: Attempt, kind: str = "batch") -> None:
        """Publish the attempt's folders; replaces an earlier commit of the batch."""
        known = {"batch_id": attempt.batch_id, "kind": kind, "tables": attempt.tables, "last_ids": attempt.last_ids}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs = jvm.org.apache.hadoop.fs
        target = fs.Path(f"{self.root}/commits/{kind}-{attempt.batch_id:012d}.json")
        staged = fs.Path(f"{self.root}/commits/.{kind}-{attempt.batch_id}-{attempt.name}")
        out = target.getFileSystem(conf).create(staged, True)
        out.write(bytearray(json.dumps(known).encode()))
        out.close()
        rename = getattr(fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = fs.FileContext.getFileContext(target.toUri(), conf)
        context.rename(context.makeQualified(staged), context.makeQualified(target), how)

    def read(self, table: str, schema: T.StructType | None = None, before: int | None = None,
             batch_id: int | None = None) -> DataFrame:
        """The published rows of a table (with batch_id), of all batches, those before one, or one.

        Without ``schema`` that of the files; a table without a published batch then has no columns.
        """
        places = [c["tables"][table] for c in self.commits(before=before)
                  if table in (c["tables"] or {}) and batch_id in (None, c["batch_id"])]
        return self._folders(table, places, schema)

    def _folders(self, table: str, places: list[str], schema: T.StructType | None) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], schema or T.StructType([]))
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        df = (reader.schema(schema) if schema else reader).parquet(*[f"{self.root}/{table}/{p}" for p in places])
        return df.select(*schema.fieldNames()) if schema else df.drop("attempt")

    def remove(self, folder: str) -> None:
        """Delete a folder below the root that no commit names."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def vacuum(self) -> int:
        """Delete attempts that no commit names; none may be running.  Returns how many went."""
        named = {f"{t}/{place}" for c in self.commits() for t, place in (c["tables"] or {}).items()}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        files, gone = root.getFileSystem(conf), 0
        for found in files.globStatus(jvm.org.apache.hadoop.fs.Path(root, "*/batch_id=*/attempt=*")) or []:
            path = found.getPath()
            if "/".join(path.toString().rsplit("/", 3)[1:]) not in named:
                files.delete(path, True)
                gone += 1
        return gone
