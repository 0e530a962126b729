"""Incremental refresh: new raw files update the tables instead of a full reload.

The result equals a full reload in which earlier loads come first; within a load the order
of rows is that of a full reload, the path of the file and the place in it. Per load the work
follows the load, not the history: Bronze gets one more part, and the facts are rewritten
for the years the load touches. Only the change fact looks further, for the neighbours of those
years, because a late observation alters the change of the one that follows it, maybe years on.

Besides its Bronze rows a load leaves two small things that merge. Its profile has a row per date:
the counters behind quality report and funnel, and the first row of the date, from which Silver is
taken (a date belongs to its earliest load). Its moments have a row per pair of series, over the
dates it brought first, from which the correlations of all loads follow. So quality and
correlation are renewed without reading old Bronze.

Bronze, profiles and moments are parts named by a commit (``CommitLog``). What a load writes before its
commit is invisible; a load that is repeated after it only derives its years again. Parts
of equal rank are merged into one of the next rank (``compact``), also while loads arrive, so that a
reader opens a number of files that grows with the logarithm of the number of loads.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.names import quoted
from tidemark.operators.change import flag_outliers, step_change
from tidemark.operators.cleaning import cleaning_funnel, keep_first, merged_profiles, non_negative
from tidemark.operators.conform import calendar_parts
from tidemark.operators.ingest import FILE, locate, number_rows
from tidemark.operators.quality import quality_report
from tidemark.operators.relation import correlations, merge_moments, mirrored, row_moments
from tidemark.plans.layout import Layout
from tidemark.plans.medallion import annual, bronze, load_profile, monthly
from tidemark.session import discard
from tidemark.sources.commits import CommitLog
from tidemark.sources.readers import EMPTY, empty_texts, text_schema

LOAD, PART = "_load", "_part"

# The benchmark's key among the series whose moments are kept.
BENCHMARK = -1


def _holds(ranges: list[list[int]], number: int) -> bool:
    """Whether a load is among those committed, which are kept as ranges of numbers."""
    return any(first <= number <= last for first, last in ranges)


def _with(ranges: list[list[int]], number: int) -> list[list[int]]:
    """The ranges with one more load, which has to come after all others."""
    if ranges and number <= ranges[-1][1]:
        raise ValueError(f"load {number} comes after load {ranges[-1][1]}")
    if ranges and number == ranges[-1][1] + 1:
        return [*ranges[:-1], [ranges[-1][0], number]]
    return [*ranges, [number, number]]


@dataclass(frozen=True)
class Refresh:
    """The tables of one layout under ``folder``, kept current load by load.

    Loads have whole numbers and arrive in their order. ``fan_in`` parts of a rank are merged into one.
    """

    layout: Layout
    folder: str
    order_by: Sequence[Column] | None = None
    fan_in: int = 8

    def path(self, layer: str) -> str:
        return f"{self.folder}/{self.layout.tables.get(layer, layer)}"

    def read(self, spark: SparkSession, layer: str) -> DataFrame:
        """A table as it now stands."""
        if layer == "silver":
            return self._silver(self._parts(spark, "silver"))
        if layer == "bronze":
            return self._parts(spark, "bronze")
        rows = spark.read.parquet(self.path(layer))
        return rows.where(F.col(self.layout.change).isNotNull()) if layer == "change" else rows

    # --- loads ---------------------------------------------------------------------------

    def apply(self, load: DataFrame, number: int) -> None:
        """Bring one load of Bronze rows into all tables.

        Rows that come from files carry their place (``locate``); others need ``order_by``.
        """
        spark, log = load.sparkSession, self._log(load.sparkSession)
        content = log.last()[1]
        if not _holds(content.get("loads", []), number):
            content = self._add(load, number, log)
        years = content["open"].get(str(number))
        if years:
            self._derive(spark, years)
        if years is not None:

            def close(content: dict) -> dict:
                rest = {key: value for key, value in content["open"].items() if key != str(number)}
                return {**content, "open": rest}

            log.change(close)

    def _add(self, load: DataFrame, number: int, log: CommitLog) -> dict:
        """Write and commit a load's parts; ``open`` then lists the years to be derived."""
        spark, lay = load.sparkSession, self.layout
        _with(log.last()[1].get("loads", []), number)
        name = f"{number:08d}-{uuid.uuid4().hex[:12]}"
        places = number_rows(load) if FILE in load.columns else load
        places.withColumn(LOAD, F.lit(number)).write.parquet(self._place("bronze", name))
        arrived = spark.read.parquet(self._place("bronze", name)).drop(LOAD)
        profile = load_profile(arrived, lay, self.order_by).withColumn(LOAD, F.lit(number))
        profile = profile.withColumn(lay.year, F.year(lay.date))
        profile.write.partitionBy(lay.year).parquet(self._place("silver", name))

        schema = self._profile_schema(profile.schema)
        dated = spark.read.schema(schema).parquet(self._place("silver", name)).where(F.col(lay.date).isNotNull())
        years = sorted(row[0] for row in dated.select(lay.year).distinct().collect())
        known = self._parts(spark, "silver", schema).where(F.col(lay.year).isin(years)).select(lay.date)
        new = self._silver(dated.join(known.distinct(), lay.date, "left_anti"))
        moments = row_moments(new, {lay.benchmark: BENCHMARK, **lay.entity_columns})
        moments.write.parquet(self._place("moments", name))
        part = {"name": name, "first": number, "last": number, "rank": 0}

        def add(content: dict) -> dict:
            opened = {**content.get("open", {}), str(number): years}
            parts, ranges = [*content.get("parts", []), part], _with(content.get("loads", []), number)
            return {"parts": parts, "loads": ranges, "open": opened, "profile": profile.schema.jsonValue()}

        return log.change(add)

    def _derive(self, spark: SparkSession, years: list[int]) -> None:
        """The facts of some years, from Silver as it now stands."""
        lay = self.layout
        here = F.col(lay.year).isin(years)
        self._replace(monthly(self._silver(self._parts(spark, "silver").where(here)), lay), "monthly")
        facts = spark.read.parquet(self.path("monthly"))
        self._replace(annual(facts.where(here), lay), "annual")
        self._replace(self._altered_changes(facts, years), "change")

    def stream(self, spark: SparkSession, source: str, columns: list[str]) -> StreamingQuery:
        """Apply every file that has arrived in ``source`` since the last call.

        The files' columns are given, as a stream cannot look into files yet to come.
        """
        arriving = (
            spark.readStream.schema(text_schema(columns))
            .options(header=True, enforceSchema=False, emptyValue=EMPTY)
            .csv(source)
        )
        return (
            locate(bronze(empty_texts(arriving)))
            .writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.folder}/_progress")
            .trigger(availableNow=True)
            .start()
        )

    # --- what is asked of all loads ------------------------------------------------------

    def profile(self, spark: SparkSession) -> DataFrame:
        """The cleaning profile of all loads together, from one row per date and load."""
        lay = self.layout
        return merged_profiles(
            self._parts(spark, "silver").drop(lay.year, PART),
            date=lay.date,
            measures=lay.measures,
            order_by=LOAD,
        )

    def quality(self, spark: SparkSession) -> DataFrame:
        """The quality report of all loads; reads no Bronze."""
        lay = self.layout
        flagged = flag_outliers(self.read(spark, "change"), entity=lay.entity, change=lay.change)
        silver = self.read(spark, "silver")
        return quality_report(self.profile(spark), flagged, date=lay.date, measures=lay.measures, output=silver)

    def funnel(self, spark: SparkSession) -> DataFrame:
        """The cleaning funnel of all loads; reads no Bronze."""
        return cleaning_funnel(self.profile(spark), date=self.layout.date, measures=self.layout.measures)

    def correlation(self, spark: SparkSession) -> DataFrame:
        """``(entity_a, entity_b, corr, n)`` of all pairs with a common date; reads moments only."""
        pairs = correlations(merge_moments(self._parts(spark, "moments")))
        return mirrored(pairs.where(F.col("entity_a") != BENCHMARK))

    def benchmark_correlation(self, spark: SparkSession) -> DataFrame:
        """``(entity, corr, n)``: every entity with the benchmark; reads moments only."""
        pairs = correlations(merge_moments(self._parts(spark, "moments")))
        with_benchmark = pairs.where((F.col("entity_a") == BENCHMARK) & (F.col("entity_b") != BENCHMARK))
        return with_benchmark.select(F.col("entity_b").alias(self.layout.entity), "corr", "n")

    # --- parts -----------------------------------------------------------------------------

    def compact(self, spark: SparkSession) -> int:
        """Merge parts of equal rank while there are ``fan_in`` of them; the number of merges.

        A date keeps its first row and its earliest load, counters add up, moments merge, Bronze
        rows are copied. The new part takes the place of the old ones in one commit, which loads
        and readers of the meantime do not notice; ``discard_merged`` deletes the old files later.
        """
        log, merges = self._log(spark), 0
        while True:
            parts = log.last()[1].get("parts", [])
            ranks = sorted({part["rank"] for part in parts})
            full = [[p for p in parts if p["rank"] == rank][: self.fan_in] for rank in ranks]
            full = [group for group in full if len(group) == self.fan_in]
            if not full:
                return merges
            old = full[0]
            names = [part["name"] for part in old]
            name = f"{old[0]['first']:08d}-{old[-1]['last']:08d}-{uuid.uuid4().hex[:12]}"
            lay = self.layout
            self._parts(spark, "bronze", only=names).drop(PART).hint("rebalance").write.parquet(self._place("bronze", name))
            profiles = self._parts(spark, "silver", only=names).drop(lay.year, PART)
            firsts = merged_profiles(profiles, date=lay.date, measures=lay.measures, order_by=LOAD, keep_order=True)
            firsts = firsts.withColumn(lay.year, F.year(lay.date)).select(*profiles.columns, lay.year)
            firsts.hint("rebalance", lay.year).write.partitionBy(lay.year).parquet(self._place("silver", name))
            moments = merge_moments(self._parts(spark, "moments", only=names))
            moments.write.parquet(self._place("moments", name))
            part = {"name": name, "first": old[0]["first"], "last": old[-1]["last"], "rank": old[0]["rank"] + 1}

            def exchange(content: dict) -> dict:
                there = [p["name"] for p in content["parts"]]
                if not set(names) <= set(there):
                    return content  # merged by somebody else
                kept = [p for p in content["parts"] if p["name"] not in names]
                return {**content, "parts": sorted([*kept, part], key=lambda p: p["first"])}

            log.change(exchange)
            merges += 1

    def discard_merged(self, spark: SparkSession) -> int:
        """Delete parts that no commit names; to be called while nothing else runs. Their number."""
        named = {part["name"] for part in self._log(spark).last()[1].get("parts", [])}
        gone = 0
        for layer in ("bronze", "silver", "moments"):
            place = spark._jvm.org.apache.hadoop.fs.Path(self.path(layer))
            files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
            for status in files.listStatus(place):
                name = status.getPath().getName()
                if name.startswith(f"{PART}=") and name.removeprefix(f"{PART}=") not in named:
                    discard(spark, f"{self.path(layer)}/{name}")
                    gone += 1
        return gone

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.folder}/_commits")

    def _place(self, layer: str, name: str) -> str:
        return f"{self.path(layer)}/{PART}={name}"

    def _profile_schema(self, schema: T.StructType) -> T.StructType:
        """As stored: the year and the part, which are folders, come last."""
        year = T.StructField(self.layout.year, T.IntegerType())
        inside = [field for field in schema if field.name != self.layout.year]
        return T.StructType([*inside, T.StructField(PART, T.StringType()), year])

    def _parts(
        self,
        spark: SparkSession,
        layer: str,
        schema: T.StructType | None = None,
        only: list[str] | None = None,
    ) -> DataFrame:
        """The committed parts of a layer, or the named ones."""
        content = self._log(spark).last()[1]
        names = [part["name"] for part in content.get("parts", [])] if only is None else only
        if layer == "silver" and schema is None and "profile" in content:
            schema = self._profile_schema(T.StructType.fromJson(content["profile"]))
        if not names:
            return spark.createDataFrame([], schema or T.StructType([]))
        reader = spark.read.option("basePath", self.path(layer))
        return (reader.schema(schema) if schema else reader).parquet(*[self._place(layer, name) for name in names])

    # --- Silver and facts ------------------------------------------------------------------

    def _silver(self, profiles: DataFrame) -> DataFrame:
        """Of the loads' first rows per date the earliest, if it is in domain."""
        lay = self.layout
        dated = profiles.where(F.col(lay.date).isNotNull()).select(lay.date, *[quoted(m) for m in lay.measures], LOAD)
        kept = non_negative(keep_first(dated, [lay.date], [LOAD]), lay.measures).drop(LOAD)
        return calendar_parts(kept, lay.date, year=lay.year, month=lay.month)

    def _altered_changes(self, facts: DataFrame, years: list[int]) -> DataFrame:
        """Changes of all years in which an observation or its predecessor is touched.

        Besides the touched years an entity's next observation after each of them is altered;
        what a year's first observation changed from is the entity's last one before. Both
        neighbours are found by aggregates over the other years, combined before they are
        shuffled; only the altered years go through a window.

        Observations without a change are stored too: a late value of 0 takes the change
        from its successor, and a year left without rows would not be replaced.
        """
        lay = self.layout
        year, present = F.col(lay.year), facts.where(F.col(lay.value).isNotNull())
        later = present.where(year > min(years)).groupBy(lay.entity).agg(
            *[
                F.min(F.when(year > touched, F.struct(lay.date, lay.year)))[lay.year].alias(f"after_{touched}")
                for touched in years
            ]
        )
        following = F.explode(F.array(*[f"after_{touched}" for touched in years]))
        next_years = later.select(following.alias("y")).where("y IS NOT NULL").distinct()
        altered = sorted({*years, *[row[0] for row in next_years.collect()]})

        rows = present.where(year.isin(altered))
        columns = F.struct(lay.date, *[name for name in facts.columns if name not in (lay.date, lay.entity)])
        opening = [y for y in altered if y - 1 not in altered]
        earlier = present.where((year < max(altered)) & ~year.isin(altered))
        before = earlier.groupBy(lay.entity).agg(
            *[F.max(F.when(year < y, columns)).alias(f"before_{y}") for y in opening]
        )
        each = F.explode(F.array_distinct(F.array(*[f"before_{y}" for y in opening])))
        neighbours = before.select(lay.entity, each.alias("row")).where("row IS NOT NULL")
        neighbours = neighbours.select(lay.entity, "row.*").select(*facts.columns)
        moves = step_change(rows.unionByName(neighbours), **lay.grain, change=lay.change)
        return moves.where(year.isin(altered))

    def _replace(self, rows: DataFrame, layer: str) -> None:
        """Replace the partitions (years) that ``rows`` has; others stay."""
        rows.hint("rebalance", self.layout.year).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(self.layout.year).parquet(self.path(layer))
