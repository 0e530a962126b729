"""How series move together."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.functions.values import pearson
from tidemark.operators.change import require_calendar

# Entities side by side in one row of the blocked form. Six keep the aggregate below
# the 100 fields up to which Spark generates code for a whole stage.
LANES = 6

# Copies of the blocked form over which the series of a date are dealt.
SALTS = 16

# What two series have in common, from which their correlation follows and which merges.
# Each as an aggregate of (b, a).
MOMENTS = {
    "n": F.regr_count,
    "mean_a": F.regr_avgx,
    "mean_b": F.regr_avgy,
    "m2_a": F.regr_sxx,
    "m2_b": F.regr_syy,
    "c_ab": F.regr_sxy,
}


def align_benchmark(
    panel: DataFrame, benchmark: DataFrame, *, date: str = "date", out: str = "benchmark"
) -> DataFrame:
    """Every panel row with the benchmark's value of its date, NULL if there is none.

    ``benchmark`` has the date and one value column; several values of a date count with
    their mean. That makes it one row per calendar date, at most 36,525 per century, which
    is what allows the broadcast: joined by shuffle, a panel of any size would be spread
    over no more tasks than it has dates.
    """
    require_calendar(benchmark, date)
    (value,) = [name for name in benchmark.columns if name != date]
    by_date = benchmark.groupBy(date).agg(F.avg(value).alias(out))
    return panel.join(F.broadcast(by_date), date, "left")


def correlation_with_benchmark(
    panel: DataFrame,
    benchmark: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """Correlation of every entity with the benchmark, and the number of common dates."""
    aligned = align_benchmark(panel, benchmark, date=date)
    both = F.col(value).isNotNull() & F.col("benchmark").isNotNull()
    return aligned.groupBy(entity).agg(
        pearson(F.col(value), F.col("benchmark")).alias("corr"),
        F.count_if(both).alias("n"),
    )


def correlation_matrix(
    panel: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity_id",
    value: str = "value",
    entities: Sequence[int] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """All pairs: ``(entity_a, entity_b, corr, n)``, each over the dates both have.

    The result has as many rows as the square of the number of entities: of all in the
    panel, those without a value included, or of the chosen ``entities``. A pair without a
    common date has ``n`` 0 and no correlation.

    ``entity`` is an integer key, as in a star schema. See ``pair_moments`` for how series meet; the
    other half of the matrix is the mirror image of theirs.
    """
    if entities is not None:
        panel = panel.where(F.col(entity).isin([int(key) for key in entities]))
    met = pair_moments(panel, date=date, entity=entity, value=value, salts=salts)
    both = mirrored(correlations(met))
    # Every cell there is: entities meet entities over a grid of salts, each dealt over its own
    # and copied to the other's. They count their values, so that they need what the series need
    # and share its shuffle.
    counted = panel.where(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("entity_a"))
    names = counted.agg(F.count(value).alias("_values")).where("_values >= 0").select("entity_a")
    grid = max(salts, math.isqrt(int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1)
    own = F.coalesce(F.pmod(F.xxhash64("entity_a"), F.lit(grid)).cast("int"), F.lit(0))  # see ``pair_moments``
    each = F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    left = names.select("entity_a", own.alias("_row"), each.alias("_column"))
    right = names.select(F.col("entity_a").alias("entity_b"), own.alias("_column"), each.alias("_row"))
    cells = left.join(right, ["_row", "_column"]).select(
        "entity_a", "entity_b", F.lit(None).cast("double").alias("corr"), F.lit(0).cast("long").alias("n")
    )
    return cells.union(both).groupBy("entity_a", "entity_b").agg(
        F.max("corr").alias("corr"), F.max("n").alias("n")
    )


def pair_moments(
    panel: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity_id",
    value: str = "value",
    salts: int = SALTS,
) -> DataFrame:
    """``(entity_a, entity_b, n, mean_a, mean_b, m2_a, m2_b, c_ab)`` of the pairs that share a date.

    Each pair once, ``entity_a <= entity_b``: number of common dates, means, sums of squared distances
    from the means and of their products. ``merge_moments`` adds those of other dates.

    The panel is laid out a second time with ``LANES`` entities per row, ``(date, block, lane_0,
    lane_1 ...)``, where a block is named by its first possible key. A series meets such rows on
    the date and a salt: the blocks of series are dealt over ``salts`` copies of the lanes, as a
    panel has few dates. The moments of all pairs of a row are accumulated before anything is
    shuffled. Only blocks at or after the entity's own are met. The plan does not grow with the
    number of entities.
    """
    key_type = panel.schema[entity].dataType
    # Never NULL as far as the optimiser can tell: what it infers from join keys would reach
    # below the panel's shuffle, differently on each side, and keep them from sharing it.
    block = F.coalesce(F.col(entity) - F.pmod(entity, F.lit(LANES)), F.lit(0).cast(key_type))
    salt = F.coalesce(F.pmod(F.xxhash64("entity_a"), F.lit(salts)).cast("int"), F.lit(0))
    series = panel.where(F.col(value).isNotNull()).select(
        date, F.col(entity).alias("entity_a"), block.alias("_block_a"), F.col(value).alias("_value")
    )
    lanes = series.groupBy(date, F.col("_block_a").alias("_block")).agg(
        *[
            F.avg(F.when(F.pmod("entity_a", F.lit(LANES)) == lane, F.col("_value"))).alias(
                f"_lane_{lane}"
            )
            for lane in range(LANES)
        ]
    )
    each_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = series.withColumn("_salt", salt)
    met = salted.join(lanes.withColumn("_salt", each_salt), [date, "_salt"])
    moments = met.where("_block_a <= _block").groupBy("entity_a", "_block").agg(
        *[
            moment(F.col(f"_lane_{lane}"), F.col("_value")).alias(f"_{name}_{lane}")
            for lane in range(LANES)
            for name, moment in MOMENTS.items()
        ]
    )
    each_lane = [
        F.struct(
            (F.col("_block") + lane).cast(key_type).alias("entity_b"),
            *[F.col(f"_{name}_{lane}").alias(name) for name in MOMENTS],
        )
        for lane in range(LANES)
    ]
    pairs = moments.select("entity_a", F.inline(F.array(*each_lane)))
    return pairs.where((F.col("n") > 0) & (F.col("entity_a") <= F.col("entity_b")))


def row_moments(wide: DataFrame, measures: Mapping[str, int]) -> DataFrame:
    """The moments of ``pair_moments`` from rows that have the series side by side, one row per date.

    ``measures`` maps columns to entity keys. Pairs are made within a row, so nothing is joined.
    """
    cells = [F.struct(F.lit(key).alias("e"), F.col(quoted(name)).cast("double").alias("v")) for name, key in measures.items()]
    pairs = wide.select(F.array(*cells).alias("cells")).select("cells", F.explode("cells").alias("a"))
    pairs = pairs.select("a", F.explode("cells").alias("b")).where("a.e <= b.e AND a.v IS NOT NULL AND b.v IS NOT NULL")
    return pairs.groupBy(F.col("a.e").alias("entity_a"), F.col("b.e").alias("entity_b")).agg(
        *[moment(F.col("b.v"), F.col("a.v")).alias(name) for name, moment in MOMENTS.items()]
    )


def merge_moments(parts: DataFrame) -> DataFrame:
    """Moments of the same pairs over different dates as those over all of them.

    Distances are taken from the common mean before they are added, so nothing large is subtracted
    from anything large, however many parts there are.
    """
    pair = Window.partitionBy("entity_a", "entity_b")
    total = F.sum("n").over(pair)
    # Means are added as distances from one of them, so that equal means stay what they are.
    parts = parts.withColumns({f"_base_{side}": F.min(f"mean_{side}").over(pair) for side in "ab"})

    def mean(side: str):
        apart = F.col(f"mean_{side}") - F.col(f"_base_{side}")
        return F.col(f"_base_{side}") + F.sum(F.col("n") * apart).over(pair) / total

    centred = parts.withColumns({f"_mean_{side}": mean(side) for side in "ab"})
    off = {side: F.col(f"mean_{side}") - F.col(f"_mean_{side}") for side in "ab"}
    return centred.groupBy("entity_a", "entity_b").agg(
        F.sum("n").alias("n"),
        F.first("_mean_a").alias("mean_a"),
        F.first("_mean_b").alias("mean_b"),
        F.sum(F.col("m2_a") + F.col("n") * off["a"] * off["a"]).alias("m2_a"),
        F.sum(F.col("m2_b") + F.col("n") * off["b"] * off["b"]).alias("m2_b"),
        F.sum(F.col("c_ab") + F.col("n") * off["a"] * off["b"]).alias("c_ab"),
    )


def correlations(moments: DataFrame) -> DataFrame:
    """``(entity_a, entity_b, corr, n)``; NULL where one of the two is constant on the common dates."""
    ratio = F.try_divide(F.col("c_ab"), F.sqrt("m2_a") * F.sqrt("m2_b"))
    clipped = F.when(F.abs(ratio) > 1, F.signum(ratio)).otherwise(ratio)
    return moments.select("entity_a", "entity_b", clipped.alias("corr"), "n")


def mirrored(pairs: DataFrame) -> DataFrame:
    """Pairs that are there once, in both orders."""
    one = F.struct("entity_a", "entity_b")
    other = F.struct(F.col("entity_b").alias("entity_a"), F.col("entity_a").alias("entity_b"))
    sides = F.when(F.col("entity_a") == F.col("entity_b"), F.array(one)).otherwise(F.array(one, other))
    return pairs.select(F.explode(sides).alias("_side"), "corr", "n").select(
        "_side.entity_a", "_side.entity_b", "corr", "n"
    )
