"""Tables replaced in one step.

Every version of a table is a folder of its own, schema included; a commit says which one counts.
A job that dies while it writes, or between writing and committing, leaves the old version as
readable as before. Earlier versions can be read by their number or by the time of the load until
they are discarded.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.commits import CommitLog

COMMITS = "_commits"


@dataclass(frozen=True)
class Staged:
    """A version that is written and not yet committed."""

    folder: str
    schema: T.StructType


class VersionedTable:
    """The versions of one table under ``path``."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.log = CommitLog(spark, f"{self.path}/{COMMITS}")

    def stage(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Staged:
        """Write a version that nobody sees yet.

        A partitioned one is written after a rebalance on its partition columns: partitions get
        few files, and a large one is still written by several tasks.
        """
        folder = f"data-{int(time.time() * 1000)}-{uuid.uuid4().hex[:12]}"
        writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self.path}/{folder}")
        return Staged(folder, df.schema)

    def commit(self, staged: Staged) -> int:
        """Make a staged version the table; its number."""
        content = {"folder": staged.folder, "schema": staged.schema.jsonValue()}
        self.log.change(lambda before: {**content, "version": before.get("version", 0) + 1})
        return self.log.last()[1]["version"]

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Replace the table, its schema included; the folder of the new version."""
        staged = self.stage(df, partition_by)
        self.commit(staged)
        return f"{self.path}/{staged.folder}"

    def history(self) -> list[dict]:
        """The commits, oldest first: ``version``, ``at`` (seconds since 1970), ``folder``, ``schema``."""
        return [self.log.read(number) for number in self.log.numbers()]

    def read(self, version: int | None = None, as_of: float | None = None) -> DataFrame:
        """The table now, at a version, or as it was at a time (seconds since 1970)."""
        if version is None and as_of is None:
            found = [self.log.last()[1]]
        else:
            found = [c for c in self.history() if (version is None or c["version"] == version)]
            found = [c for c in found if as_of is None or c["at"] <= as_of]
        if not found or not found[-1]:
            raise LookupError(f"{self.path} has no such version")
        schema = T.StructType.fromJson(found[-1]["schema"])
        rows = self.spark.read.format(self.fmt).schema(schema).load(f"{self.path}/{found[-1]['folder']}")
        return rows.select(*[f"`{name}`" for name in schema.names])

    def discard(self, keep: int = 1, hours: float = 24.0) -> list[str]:
        """Delete the data of all but the last ``keep`` versions, and what was never committed.

        Folders younger than ``hours`` stay: somebody may be reading or writing them.
        """
        kept = {commit["folder"] for commit in self.history()[-keep:]}
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        limit = (time.time() - hours * 3600) * 1000
        gone = []
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if name.startswith("data-") and name not in kept and int(name.split("-")[1]) <= limit:
                files.delete(status.getPath(), True)
                gone.append(name)
        return sorted(gone)
