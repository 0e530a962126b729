"""Event time: days counted by a stream, whatever order the events arrive in.

Every event belongs to the day of its time. The stream keeps one row of state per day, kind and
salt: number, sum, and how many of them came late. A day is closed once the watermark, the
latest event time seen less a delay, has passed its end; an event for a closed day is late.
Late events are counted as such and still added, so that the sums always equal those of a
batch over all events. The salt deals a kind with a third of all events over several groups.

Each micro-batch writes the rows it changed to its own folder, which a repeated batch overwrites;
readers take the latest row of every group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATE = "n long, units long, n_late long"
COUNTED = f"day int, kind string, salt int, {STATE}, watermark long"
DAY_MS = 86_400_000


def _counter():
    """The function of one group; it is sent to the workers by value."""

    def counted(key, chunks, state):
        import pandas as pd

        day, kind, salt = key
        n, units, late = state.get if state.exists else (0, 0, 0)
        watermark = state.getCurrentWatermarkMs()
        closed = (int(day) + 1) * 86_400_000 <= watermark
        for chunk in chunks:
            n += len(chunk)
            units += int(chunk["units"].sum())
            late += len(chunk) if closed else 0
        state.update((n, units, late))
        row = (day, kind, salt, n, units, late, watermark)
        names = ["day", "kind", "salt", "n", "units", "n_late", "watermark"]
        yield pd.DataFrame([row], columns=names)

    return counted


@dataclass(frozen=True)
class EventWindows:
    """One-day windows of a folder of event files, kept under ``folder``.

    ``time``, ``kind`` and ``value`` name the events' columns, ``identity`` what tells events apart (it
    chooses the salt). Values are summed exactly to ``decimals`` digits; absent ones and NaN count
    as an event without a value. Events without a time or kind have no window and are left out.
    """

    folder: str
    time: str = "ts"
    kind: str = "event_type"
    value: str = "value"
    identity: str = "event_id"
    delay: str = "1 day"
    decimals: int = 2
    salts: int = 16

    def _events(self, events: DataFrame) -> DataFrame:
        number = F.nanvl(F.col(self.value).cast("double"), F.lit(None).cast("double"))
        units = F.rint(number * 10**self.decimals).cast("long")
        return events.select(
            F.col(self.time).cast("timestamp").alias("at"),
            F.unix_date(F.col(self.time).cast("date")).alias("day"),
            F.col(self.kind).cast("string").alias("kind"),
            F.pmod(F.xxhash64(self.identity), F.lit(self.salts)).cast("int").alias("salt"),
            F.coalesce(units, F.lit(0)).alias("units"),
        ).where("at IS NOT NULL AND kind IS NOT NULL")

    def stream(self, spark: SparkSession, source: str, schema) -> StreamingQuery:
        """Count every Parquet file that has arrived in ``source`` since the last call."""
        arriving = spark.readStream.schema(schema).parquet(source)
        timed = self._events(arriving).withWatermark("at", self.delay)
        changed = timed.groupBy("day", "kind", "salt").applyInPandasWithState(
            _counter(), COUNTED, STATE, "update", "NoTimeout"
        )

        def write(rows: DataFrame, batch: int) -> None:
            rows.write.mode("overwrite").parquet(f"{self.folder}/windows/batch={batch}")

        return (
            changed.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{self.folder}/progress")
            .trigger(availableNow=True)
            .start()
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """``(day, kind, n, total, n_late, is_closed)`` as counted so far."""
        rows = spark.read.schema(f"{COUNTED}, batch int").parquet(f"{self.folder}/windows")
        passed = rows.agg(F.max("watermark")).first()[0] or 0
        latest = rows.groupBy("day", "kind", "salt").agg(
            F.max_by(F.struct("n", "units", "n_late"), "batch").alias("last")
        )
        sums = latest.groupBy("day", "kind").agg(
            *[F.sum(f"last.{name}").alias(name) for name in ("n", "units", "n_late")]
        )
        end: Column = (F.col("day").cast("long") + 1) * DAY_MS
        return sums.select(
            F.date_from_unix_date("day").alias("day"),
            "kind",
            "n",
            (F.col("units").cast("double") / 10**self.decimals).alias("total"),
            "n_late",
            (end <= passed).alias("is_closed"),
        )
