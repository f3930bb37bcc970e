"""Tables of batches under one manifest (OP-08, 10, 11).

A table is a list of batch folders, and all tables' lists are one document.
So the retrain append and the clearing of the log that fed it are one commit:
whatever fails before it leaves both tables as they were, and whatever fails
after it has happened. No rows are moved or rewritten; folders that no version
names any more are removed later."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skydrift.operators.manifest import Manifest


class BatchTables:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, f"{self.root}/manifest")

    # -- reading
    def exists(self, table: str) -> bool:
        return table in self.manifest.read()[1].get("tables", {})

    def batches(self, table: str, version: int | None = None) -> list[int]:
        document = self.manifest.read()[1] if version is None else self.manifest.at(version)
        return sorted(int(b) for b in document["tables"][table]["batches"])

    def read(self, table: str, batches: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a table's batches (all of them unless some are named), now
        or as of an earlier version."""
        document = self.manifest.read()[1] if version is None else self.manifest.at(version)
        held = document["tables"][table]
        schema = T.StructType.fromJson(held["schema"])
        chosen = held["batches"] if batches is None else {str(b): held["batches"][str(b)] for b in batches}
        paths = [f"{self.root}/{folder}" for folder in chosen.values()]
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*paths)

    # -- writing
    def create(self, table: str, schema: T.StructType) -> bool:
        """OP-08: the table, without rows, unless it exists; returns whether it was made."""
        made = False

        def change(document: dict) -> dict | None:
            nonlocal made
            made = table not in document.setdefault("tables", {})
            if not made:
                return None
            document["tables"][table] = {"schema": schema.jsonValue(), "batches": {}, "seen": -1}
            return document

        self.manifest.update(change)
        return made

    def write(self, df: DataFrame, table: str, batch: int) -> str:
        """A batch's rows in a folder that no version names yet."""
        folder = f"{table}/batch-{batch}-{uuid.uuid4().hex[:12]}"
        schema = T.StructType.fromJson(self.manifest.read()[1]["tables"][table]["schema"])
        df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(f"{self.root}/{folder}")
        return folder

    def append(self, df: DataFrame, table: str, batch: int) -> bool:
        """OP-10: one batch. A batch that the table has, or has had, is left as it
        is (a retry after a failure that came after the commit)."""
        if self._seen(self.manifest.read()[1], table, batch):
            return False
        return self._commit({table: {batch: self.write(df, table, batch)}}, {})

    def move(self, source: str, batches: Iterable[int], target: str, batch: int,
             project: Callable[[DataFrame], DataFrame]) -> bool:
        """OP-10/11: ``project`` of some batches of ``source`` becomes one batch of
        ``target``, and ``source`` loses those batches, in one commit. Batches of
        the source that arrive meanwhile stay. Returns False if it was done before."""
        batches = list(batches)
        if self._seen(self.manifest.read()[1], target, batch):
            return False
        folder = self.write(project(self.read(source, batches)), target, batch)
        return self._commit({target: {batch: folder}}, {source: batches})

    @staticmethod
    def _seen(document: dict, table: str, batch: int) -> bool:
        held = document["tables"][table]
        return str(batch) in held["batches"] or str(batch) in held.get("cleared", {})

    def _commit(self, add: dict[str, dict[int, str]], remove: dict[str, list[int]]) -> bool:
        done = False

        def change(document: dict) -> dict | None:
            nonlocal done
            for table, new in add.items():
                for batch, folder in new.items():
                    if self._seen(document, table, batch):
                        return None  # another attempt has committed it
                    document["tables"][table]["batches"][str(batch)] = folder
            for table, gone in remove.items():
                held = document["tables"][table]
                for batch in gone:
                    folder = held["batches"].pop(str(batch), None)
                    if folder is None:
                        raise ValueError(f"{table} has no batch {batch}")
                    held.setdefault("cleared", {})[str(batch)] = folder
            done = True
            return document

        self.manifest.update(change)
        return done

    def vacuum(self) -> int:
        """Remove the folders that the newest version does not name (cleared
        batches, and what failed attempts left); returns how many. Only while
        nothing is being written, and no reader needs an earlier version."""
        document = self.manifest.read()[1]
        hadoop = self._spark._jvm.org.apache.hadoop.fs
        named = {f for held in document.get("tables", {}).values() for f in held["batches"].values()}
        gone = 0
        for table in document.get("tables", {}):
            path = hadoop.Path(f"{self.root}/{table}")
            fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(path) if fs.exists(path) else ():
                if f"{table}/{status.getPath().getName()}" not in named:
                    gone += bool(fs.delete(status.getPath(), True))
        return gone
