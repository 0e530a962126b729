"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Every document is measured once. The sketch of a measure is a histogram over log-linear
bins (whole numbers of at most seven significant bits, so a bin is within 1/64 of its
values): counts that add up in any order, which makes sketches of tasks, sources and
languages mergeable without loss. From the sketch of its language and source a document
gets upper and lower fences where the fixed cutoffs of a rule set would otherwise stand: the
median plus ``reach`` times the distance of an outer tenth from it, on each side by itself, which
is about 3.8 standard deviations of normal values. Only Spark expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored, table

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SHOUTS = "!?"

# Least distance of an outer tenth from the median, against groups without any spread.
FLOOR = {"symbols": 10, "shouts": 10, "dup_lines": 50, "repeats": 30, "word_length": 20}
REACH = 3
MIN_DOCUMENTS = 200


def replaced(text: Column, characters: str, by: str) -> Column:
    """Every one of the characters replaced: far cheaper than ``translate``, which decodes all."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(by))
    return text


def count_of(text: Column, characters: str) -> Column:
    """How often any of the characters, single bytes in UTF-8, occur."""
    return (F.octet_length(text) - F.octet_length(replaced(text, characters, ""))).cast("long")


def measured(docs: DataFrame, keep: Sequence[str] = ("doc_id", "lang", "source")) -> DataFrame:
    """``(doc, m)``: the kept columns of each row, and its measures.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]``; a null text has none.
    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_shouts``, ``n_lines``
    and ``n_dup_lines`` (lines with a word; those equal to an earlier one),
    ``n_repeat_words`` (words in windows of three words that occur twice or more).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x, F.lit(SPACE))) > 0)
    words = F.array_remove(F.split(replaced(F.col("text"), SPACE[1:], " "), " "), "")
    rows = rows.select("doc", "text", words.alias("words"), lines.alias("lines"))
    windows = F.when(
        F.size("words") >= 3,
        F.expr(
            "transform(sequence(0, size(words) - 3),"
            " i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
        ),
    )
    rows = rows.select("*", windows.alias("windows"))
    # Most texts have no window twice, which a hash set tells; of the others, sorting tells
    # the hashes that occur twice.
    twice = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows")
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("*", twice.alias("sorted")).select(
        "*", F.expr("array_distinct(filter(sorted, (x, j) -> x <=> get(sorted, j + 1)))").alias("twice")
    )
    # Where they stand: looked up if they are few, otherwise by sorting windows with places.
    rows = rows.select(
        "*",
        F.expr(
            "CASE WHEN size(twice) = 0 THEN cast(array() AS array<int>)"
            " WHEN size(twice) <= 24 THEN filter(sequence(0, size(words) - 3),"
            "  i -> array_contains(twice, windows[i]))"
            " END"
        ).alias("few"),
    )
    rows = rows.select(
        "*",
        F.when(
            F.col("few").isNull(),
            F.expr("sort_array(transform(windows, (x, i) -> struct(x AS k, i AS i)))"),
        ).alias("pairs"),
    )
    rows = rows.select(
        "*",
        F.coalesce(
            "few",
            F.expr(
                "sort_array(transform(filter(pairs, (x, j) -> x.k <=> get(pairs, j - 1).k"
                " OR x.k <=> get(pairs, j + 1).k), x -> x.i))"
            ),
        ).alias("places"),
    )
    # In order of position, each repeated window covers as many new words as it is ahead of
    # the one before, three at most.
    covered = F.expr(
        "aggregate(transform(places, (p, j) -> least(3, coalesce(p - get(places, j - 1), 3))),"
        " 0L, (s, x) -> s + x)"
    )
    return rows.select(
        "doc",
        F.struct(
            F.size("words").cast("long").alias("n_words"),
            F.length(replaced(F.col("text"), SPACE, "")).cast("long").alias("word_chars"),
            count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
            count_of(F.col("text"), SHOUTS).alias("n_shouts"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        ).alias("m"),
    )


def base_failed() -> Column:
    """The two rules that stay fixed: too short, or mostly repeated windows."""
    return (F.col("m.n_words") < 50) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))


def _ratio(part: str, whole: str, scale: int = 1000) -> Column:
    return F.coalesce(F.expr(f"{scale} * m.{part} div nullif(m.{whole}, 0)"), F.lit(0)).cast("long")


# Measure -> (part, whole, scale): whole numbers, so that every engine agrees on them.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 1000),
    "shouts": ("n_shouts", "word_chars", 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 1000),
    "repeats": ("n_repeat_words", "n_words", 1000),
    "word_length": ("word_chars", "n_words", 100),
}


def _levels() -> Column:
    """The groups whose sketches a language and source belongs to, the narrowest first."""
    none = "cast(null AS string)"
    levels = [("lang", "source"), ("lang", none), (none, none)]
    return F.array(
        *[
            F.expr(f"named_struct('level', {i}, 'lang', {lang}, 'source', {source})")
            for i, (lang, source) in enumerate(levels)
        ]
    )


def sketches(measures: DataFrame) -> DataFrame:
    """Sketches at three levels: language and source, language, all.

    ``(level, lang, source, measure, bin, n)``. A task passes on one row per bin, so a
    source with a third of all documents is no larger in the shuffle than any other.
    """
    values = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), _ratio(*spec).alias("value"))
            for name, spec in RATIOS.items()
        ]
    )
    leaf = (
        measures.where(~base_failed())
        .select("doc.lang", "doc.source", F.explode(values).alias("v"))
        .select("lang", "source", "v.measure", "v.value")
        .withColumn("drop", F.greatest(F.length(F.bin("value")) - 7, F.lit(0)))
        .withColumn("bin", F.expr("shiftleft(shiftright(value, drop), drop)"))
        .groupBy("lang", "source", "measure", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    levels = _levels()
    merged = leaf.select(F.explode(levels).alias("g"), "measure", "bin", "n")
    return merged.groupBy("g", "measure", "bin").agg(F.sum("n").alias("n"))


def _least(values: dict[str, int]) -> Column:
    """The value that belongs to ``measure``."""
    found = F.lit(0)
    for name, least in values.items():
        found = F.when(F.col("measure") == name, F.lit(least)).otherwise(found)
    return found


def fences(sketch: DataFrame, reach: int = REACH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``(lang, source, limits)`` for each language and source, a low and high fence per measure.

    A group of fewer than ``min_documents`` takes the fences of its language, and a language
    of so few those of all documents.
    """
    group = Window.partitionBy("g", "measure")  # no more rows than a sketch has bins
    up_to = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketch.select("g", "measure", "bin", up_to.alias("up_to"), F.sum("n").over(group).alias("n"))

    def quantile(part: int, of: int) -> Column:
        return F.min(F.when(of * F.col("up_to") >= part * F.col("n"), F.col("bin")))

    quantiles = ranked.groupBy("g", "measure").agg(
        quantile(1, 10).alias("p10"), quantile(1, 2).alias("p50"), quantile(9, 10).alias("p90"),
        F.first("n").alias("n"),
    )
    floor = _least(FLOOR)
    low = F.col("p50") - reach * F.greatest(F.col("p50") - F.col("p10"), floor)
    high = F.col("p50") + reach * F.greatest(F.col("p90") - F.col("p50"), floor)
    limits = quantiles.groupBy("g").agg(
        F.max("n").alias("n"),
        *[
            F.max(F.when(F.col("measure") == name, F.struct(low.alias("low"), high.alias("high")))).alias(name)
            for name in RATIOS
        ],
    )
    limits = limits.select("g", "n", F.struct(*RATIOS).alias("limits"))
    groups = sketch.where("g.level = 0").select(F.col("g.lang"), F.col("g.source")).distinct()
    wanted = groups.select("lang", "source", F.explode(_levels()).alias("g"))
    found = wanted.select("lang", "source", "g", F.to_json("g").alias("key")).join(
        limits.select(F.to_json("g").alias("key"), "n", "limits"), "key"
    )
    usable = found.where((F.col("n") >= min_documents) | (F.col("g.level") == 2))
    return usable.groupBy("lang", "source").agg(F.min_by("limits", "g.level").alias("limits"))


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``(doc, m, base_failed, kept)``: the measures met with the fences of their group."""
    inside = F.lit(True)
    for name, spec in RATIOS.items():
        value = _ratio(*spec)
        inside = inside & (value >= F.col(f"limits.{name}.low")) & (value <= F.col(f"limits.{name}.high"))
    same = F.col("doc.lang").eqNullSafe(F.col("lang")) & F.col("doc.source").eqNullSafe(F.col("source"))
    return measures.join(limits, same, "left").select(
        "doc", "m", base_failed().alias("base_failed"), (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept")
    )


def quality_rules(docs: DataFrame, keep: Sequence[str] = ("doc_id", "lang", "source")) -> DataFrame:
    """Measure, derive the thresholds, and judge every document.

    ``docs`` needs ``text``, ``lang`` and ``source``. Returns ``(doc, m, base_failed, kept)``
    with the ``keep`` columns inside ``doc``, so that no name can clash.

    Null language or source is a group of its own. A null, empty or short text fails the
    fixed rules. Repeated rows are judged each, alike. An empty table gives an empty result.
    Measures are written to the shared folder once: thresholds and verdicts read those, not
    the texts again.
    """
    measures = stored(measured(docs, keep), "quality")
    return judged(measures, fences(sketches(measures)))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents with their measures and verdicts."""
    result = quality_rules(table(spark, sf_dir, "documents"))
    return result.select(
        "doc.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        "base_failed", "kept",
    )
