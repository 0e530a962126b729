"""Run registered queries on a skewed copy of the given tables, beside their oracle SQL.

    python skew.py FOLDER COPIES SCRATCH [query ...]

Writes ``orders`` and ``lineitem`` of ``FOLDER`` (the other tables as they are) ``COPIES`` times
into ``SCRATCH``, with a third of all rows on one part, customer, ship date and order line, and
reports seconds, rows, and whether the result equals the oracle's.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

from check import TABLES, compare
from tidemark.session import build

HOT = {
    "orders": {"o_custkey": 1, "o_orderpriority": "1-URGENT"},
    "lineitem": {"l_partkey": 1, "l_shipdate": None, "l_orderkey": 1, "l_linenumber": 1},
}


def skewed(df, hot: dict, copies: int):
    """``copies`` of every row; every third row gets the hot values (None: the first date)."""
    copied = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    chosen = F.pmod(F.xxhash64("_copy", *df.columns), F.lit(3)) == 0
    for name, value in hot.items():
        if value is None:
            value = df.agg(F.min(name)).first()[0]
        kind = df.schema[name].dataType
        copied = copied.withColumn(name, F.when(chosen, F.lit(value).cast(kind)).otherwise(F.col(name)))
    return copied.drop("_copy")


def main() -> None:
    folder, copies, scratch = sys.argv[1], int(sys.argv[2]), Path(sys.argv[3])
    scratch.mkdir(parents=True)
    spark = build(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "16",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in TABLES:
        source, target = Path(folder, f"{name}.parquet"), scratch / f"{name}.parquet"
        if name in HOT:
            df = skewed(spark.read.parquet(str(source)), HOT[name], copies)
            df.coalesce(1).write.parquet(f"{target}.parts")
            (part,) = Path(f"{target}.parts").glob("part-*.parquet")
            target.symlink_to(part)
        else:
            target.symlink_to(source)
    for name in sys.argv[4:]:
        start = time.perf_counter()
        outcome = compare(spark, str(scratch), name)
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
