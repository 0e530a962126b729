"""Mixing sources to target weights by iterative proportional fitting.

Documents are added up to cells, one per source, language and topic. The cells' token
weights are raked: scaled to the target share of every source, then of every language, then
of every topic, and again, until all three hold. A cell's calibrated factor, weight over
tokens, is scaled so that the expected sample has the wanted share of all tokens, and no
document more than probability one. Cells cut at one leave the sample off its targets;
``bounded`` rakes with the bound inside instead, and lowers the share where no sample of that
size can meet the targets. Documents are only touched by Spark expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.quality import SPACE, count_of, replaced
from tidemark.llm.store import stored, table

ROUNDS = 8
SHARE = 0.5
SEED = "mix-1"

# A target is an exponent, which flattens what is there (1 leaves it, 0 makes all equal), or
# weights by value.
TARGETS: dict[str, float | dict] = {"source": 0.5, "lang": 0.7, "topic": 1.0}


def n_tokens(text: Column | None = None) -> Column:
    """Words of a text and its end: the length that weights and sequences are counted in."""
    text = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    words = F.array_remove(F.split(replaced(text, SPACE[1:], " "), " "), "")
    return (F.size(words) + 1).cast("long")


def genre() -> Column:
    """A topic for tables without one, from a text's ``n_tokens``, markup and lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        F.when(F.col("n_tokens") < 50, "note")
        .when(50 * count_of(text, "<>|{}") >= F.octet_length(text), "markup")
        .when(F.octet_length(text) < 80 * (count_of(text, "\n") + 1), "list")
        .when(F.col("n_tokens") >= 2000, "book")
        .otherwise("article")
    )


def _shares(cells: DataFrame, dimension: str, target: float | Mapping) -> DataFrame:
    """``(value, share)`` of one dimension, shares adding up to one over the values there are."""
    totals = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    if isinstance(target, Mapping):
        weight = F.lit(0.0)
        for value, share in target.items():
            weight = F.when(F.col(dimension).eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(weight)
    else:
        weight = F.pow(F.col("tokens").cast("double"), F.lit(float(target)))
    totals = totals.select(F.col(dimension).alias("value"), weight.alias("weight"))
    total = totals.agg(F.sum("weight")).first()[0]
    return totals.select("value", (F.col("weight") / F.lit(float(total or 1.0))).alias("share"))


def raked(cells: DataFrame, targets: Mapping[str, float | Mapping], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: token shares raked to the targets in turn, ``rounds`` times.

    ``cells`` has one row per combination of the dimensions, with its ``tokens``. A window
    task holds the cells of one value, never documents.
    """
    current = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dimension, target in targets.items():
        shares = _shares(cells, dimension, target).withColumnRenamed("share", f"share_{dimension}")
        same = F.col(dimension).eqNullSafe(F.col("value"))
        current = current.join(shares, same, "left").drop("value")
    current = stored(current, "mix-cells")
    for _ in range(rounds):
        for dimension in targets:
            there = F.sum("weight").over(Window.partitionBy(dimension))
            scaled = F.col("weight") * F.col(f"share_{dimension}") / there
            current = current.withColumn("weight", F.when(there > 0, scaled).otherwise(0.0))
    return current.drop(*[f"share_{d}" for d in targets])


def probabilities(cells: DataFrame, share: float = SHARE) -> DataFrame:
    """``cells`` with ``probability``, the expected sample being ``share`` of all tokens.

    Probability is ``scale`` x weight / tokens, at most one. The scale is found in a few
    steps, each of which sets the cells that would exceed one to it; only sums of the cells
    come to the driver.
    """
    cells = stored(cells.withColumn("factor", F.col("weight") / F.col("tokens")), "mix-raked")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale, full = 0.0, -1
    while True:
        at_one = F.col("factor") * F.lit(scale) >= 1
        row = cells.agg(
            F.sum(F.when(at_one, F.col("tokens")).otherwise(0)),
            F.sum(F.when(~at_one, F.col("weight")).otherwise(0.0)),
            F.count_if(at_one),
        ).first()
        if row[2] == full or not row[1]:
            break
        scale, full = max(scale, (share * total - row[0]) / row[1]), row[2]
    if total and not row[1]:
        scale = float("inf")
    p = F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.col("factor") * F.lit(scale))).otherwise(0.0)
    return cells.withColumn("probability", p)


def _chances(
    tokens: np.ndarray, codes: list[np.ndarray], wanted: list[np.ndarray], sweeps: int = 1000, near: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Probabilities that give each value its ``wanted`` tokens, and the largest miss as a share of all.

    A cell's probability is the product of one factor per dimension, at most one. Each factor
    in turn is set to what its value needs, the cells it cuts included, until all hold.
    """
    factors = [np.ones(len(w)) for w in wanted]
    total = wanted[0].sum()
    miss = np.inf
    for _ in range(sweeps):
        for k, code in enumerate(codes):
            rest = np.prod([f[c] for j, (f, c) in enumerate(zip(factors, codes)) if j != k], axis=0, initial=1.0)
            rest = np.broadcast_to(rest, tokens.shape)
            order = np.lexsort((-rest, code))
            there, full, part = code[order], tokens[order], (tokens * rest)[order]
            # Tokens before a cell among those of its value, and weights from it on.
            starts = np.flatnonzero(np.append(True, there[1:] != there[:-1]))
            sizes = np.diff(np.append(starts, len(there)))
            before = np.cumsum(full) - full
            before -= np.repeat(before[starts], sizes)
            after = np.cumsum(part[::-1])[::-1]
            after = after - np.repeat(np.append(after[starts[1:]], 0.0), sizes)
            need = wanted[k][there] - before
            factor = np.divide(need, after, out=np.zeros(len(need)), where=(after > 1e-300) & (need > 0))
            factors[k][there[starts]] = np.clip(np.maximum.reduceat(factor, starts), 0.0, 1e12)
        chance = np.minimum(1.0, np.prod([f[c] for f, c in zip(factors, codes)], axis=0))
        got = [np.bincount(c, chance * tokens, len(w)) for c, w in zip(codes, wanted)]
        miss = max(float(np.abs(g - w).max()) for g, w in zip(got, wanted)) / total
        if miss <= near:
            break
    return chance, miss


def bounded(cells: DataFrame, targets: Mapping[str, float | Mapping], share: float = SHARE) -> DataFrame:
    """``cells`` with ``probability``: a sample that meets all targets, ``share`` of all tokens or less.

    Where a value has fewer tokens than its target, or values only occur together, the share is
    the largest at which the targets hold, to 2e-4 of the sample. Where they hold at no share, as
    with a value found only beside one of target zero, cells are raked without the bound and cut.

    One row per cell comes to the driver, and none per document.
    """
    dimensions = list(targets)
    table = cells.select(*dimensions, "tokens").toArrow().combine_chunks()
    if not table.num_rows:
        return cells.withColumn("probability", F.lit(0.0))
    tokens = table["tokens"].to_numpy().astype(np.float64)
    codes, shares = [], []
    for dimension in dimensions:
        found = table[dimension].combine_chunks().dictionary_encode(null_encoding="encode")
        codes.append(found.indices.to_numpy().astype(np.int64))
        values, target = found.dictionary.to_pylist(), targets[dimension]
        totals = np.bincount(codes[-1], tokens)
        if isinstance(target, Mapping):
            weight = np.array([float(target.get(v, 0.0)) for v in values])
        else:
            weight = totals ** float(target)
        shares.append(weight / (weight.sum() or 1.0))

    def at(size):
        return _chances(tokens, codes, [s * size for s in shares])

    # No more than a value has, whatever the others.
    high = share * tokens.sum()
    for code, part in zip(codes, shares):
        have = np.bincount(code, tokens)
        high = min(high, float((have[part > 0] / part[part > 0]).min(initial=np.inf)))
    low, best = 0.0, None
    if all(s.sum() > 0 for s in shares):
        chance, miss = at(high)
        best = chance if miss <= 2e-4 else None
        for _ in range(0 if best is not None else 16):
            size = (low + high) / 2
            chance, miss = at(size)
            if miss <= 2e-4:
                low, best = size, chance
            else:
                high = size
    if best is None:
        return probabilities(raked(cells, targets), share).drop("weight", "factor")
    return cells.sparkSession.createDataFrame(table.append_column("probability", pa.array(best)))


def ticket() -> Column:
    """What a row is drawn by: its ``doc_id``, or its text and place where there is none."""
    row = F.concat(F.xxhash64("text").cast("string"), F.lit("/"), F.monotonically_increasing_id().cast("string"))
    return F.coalesce(F.col("doc_id").cast("string"), row)


def draw(seed: str = SEED) -> Column:
    """A number in [0, 1) that follows from the row's ``ticket``."""
    name = F.concat(F.lit(seed), F.lit("/"), F.col("ticket"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mixed_sample(
    docs: DataFrame,
    *,
    targets: Mapping[str, float | Mapping] = TARGETS,
    topic: Column | None = None,
    rounds: int = ROUNDS,
    share: float = SHARE,
    seed: str = SEED,
    keep: tuple[str, ...] = (),
    exact: bool = False,
) -> DataFrame:
    """``(doc, source, lang, topic, n_tokens, probability, sampled)`` for every document.

    ``doc`` holds ``doc_id`` and the ``keep`` columns. Without ``topic`` the topic is ``genre()``.
    A document is sampled if its draw, fixed by ``doc_id`` and ``seed``, is below its
    probability: rows with the same ``doc_id`` in one cell fare alike, rows without one are drawn
    each by itself. ``exact`` puts the targets
    before the share, see ``bounded``; otherwise cells cut at one leave the targets missed.

    Null source or language is a value of its own; null or empty text has one token. An empty
    table gives an empty result. A value whose target weight is zero is never sampled.
    """
    columns = dict.fromkeys(["doc_id", *keep])
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        "doc_id",
        "source",
        "lang",
        ticket().alias("ticket"),
        n_tokens().alias("n_tokens"),
        F.col("text"),
        *([topic.alias("topic")] if topic is not None else []),
    )
    if topic is None:
        rows = rows.withColumn("topic", genre())
    rows = rows.drop("text")
    if not keep:  # narrow rows are written once instead of being counted twice
        rows = stored(rows, "mix-rows")
    dimensions = list(targets)
    cells = stored(rows.groupBy(*dimensions).agg(F.sum("n_tokens").alias("tokens")), "mix-tokens")
    chances = bounded(cells, targets, share) if exact else probabilities(raked(cells, targets, rounds), share)
    chances = chances.select(*[F.col(d).alias(f"cell_{d}") for d in dimensions], "probability")
    same = F.lit(True)
    for d in dimensions:
        same = same & F.col(d).eqNullSafe(F.col(f"cell_{d}"))
    return rows.join(chances, same, "left").select(
        "doc", "source", "lang", "topic", "n_tokens", "probability",
        (draw(seed) < F.col("probability")).alias("sampled"),
    )


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents with their sampling probabilities and whether they are drawn."""
    result = mixed_sample(table(spark, sf_dir, "documents"))
    return result.select(
        "doc.doc_id", "source", "lang", "topic", "n_tokens",
        F.round("probability", 6).alias("probability"), "sampled",
    )
