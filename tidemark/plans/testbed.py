"""Panels and dirty inputs over the given tables; all rows of the tables are used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pricevolume import unit_prices
from tidemark.operators.reshape import panel_sums, roll_up, to_panel
from tidemark.plans.layout import Layout

# The order priorities of the test tables, keyed by their leading digit.
PRIORITIES = {1: "1-URGENT", 2: "2-HIGH", 3: "3-MEDIUM", 4: "4-NOT SPECIFIED", 5: "5-LOW"}

# The raw names under which `lineitem` plays the wide monthly file.
SHIPMENTS = Layout(
    mapping={
        "Ship Date": "day",
        "Net Price (index)": "idx",
        "Quantity": "quantity",
        "Extended Price, USD": "extended_price",
        "Tax %": "tax",
    },
    date="day",
    benchmark="idx",
    entities=(
        {"entity_id": 1, "entity_name": "Quantity", "source_column": "quantity"},
        {"entity_id": 2, "entity_name": "Extended price", "source_column": "extended_price"},
        {"entity_id": 3, "entity_name": "Tax", "source_column": "tax"},
    ),
    tables={
        "bronze": "bronze_shipments",
        "silver": "silver_shipments",
        "dimension": "gold_dim_entity",
        "monthly": "gold_values",
        "annual": "gold_annual",
        "change": "gold_change",
    },
    focus=("Quantity", "Extended price"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def panel_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Mean order price by month and order priority."""
    return to_panel(
        table(spark, folder, "orders"),
        date=F.col("o_orderdate"),
        entity=F.col("o_orderpriority"),
        value=F.col("o_totalprice"),
        decimals=2,
    )


def fact_priority(spark: SparkSession, folder: str) -> DataFrame:
    """The same panel as a fact: the priority's digit is the entity key."""
    panel = to_panel(
        table(spark, folder, "orders"),
        date=F.col("o_orderdate"),
        entity=F.substring("o_orderpriority", 1, 1).cast("int"),
        value=F.col("o_totalprice"),
        decimals=2,
    )
    return panel.withColumnRenamed("entity", "entity_id")


def benchmark_price(spark: SparkSession, folder: str) -> DataFrame:
    """Mean order price by month, rolled up from the sums behind `panel_priority`.

    Both start with the same shuffle, so a query that needs both reads the orders once.
    """
    sums = panel_sums(
        table(spark, folder, "orders"),
        date=F.col("o_orderdate"),
        entity=F.col("o_orderpriority"),
        value=F.col("o_totalprice"),
        decimals=2,
    )
    return roll_up(sums, ["date"], decimals=2)


def panel_brand(spark: SparkSession, folder: str) -> DataFrame:
    """Mean line price by month and brand; the brand's number is the entity key.

    Lines meet `part` as they are read and are then combined by month and brand, of which there
    are few: hardly anything is shuffled where `part` is broadcast. The join carries no hint, as
    `part` grows with the data: Spark's size check has to decide, and beyond it a part with
    very many lines is split while the join runs.
    """
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    brands = table(spark, folder, "part").select(
        "p_partkey", F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("brand")
    )
    panel = to_panel(
        lines.join(brands, F.col("l_partkey") == F.col("p_partkey")),
        date=F.col("l_shipdate"),
        entity=F.col("brand"),
        value=F.col("l_extendedprice"),
        decimals=2,
    )
    return panel.withColumnRenamed("entity", "entity_id")


def unit_price_part(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """What a unit of each part cost by month, in the lines that are fulfilled."""
    lines = table(spark, folder, "lineitem").where("l_linestatus = 'F'")
    return unit_prices(
        lines,
        date=F.col("l_shipdate"),
        entity=F.col("l_partkey"),
        amount=F.col("l_extendedprice"),
        quantity=F.col("l_quantity"),
        tasks=tasks,
    )


def volume_part(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """Units of each part that were shipped and not returned, by month."""
    lines = table(spark, folder, "lineitem").where("l_returnflag <> 'R'")
    panel = to_panel(
        lines,
        date=F.col("l_shipdate"),
        entity=F.col("l_partkey"),
        value=F.col("l_quantity"),
        how="sum",
        decimals=0,
        tasks=tasks,
    )
    return panel.withColumnRenamed("value", "volume")


def list_price_part(spark: SparkSession, folder: str) -> DataFrame:
    """The list price of each part."""
    return table(spark, folder, "part").select(F.col("p_partkey").alias("entity"), F.col("p_retailprice").alias("base"))


def panel_year(spark: SparkSession, folder: str) -> DataFrame:
    """Order price by month; an entity is a priority within one year.

    Entities of different years have no month in common.
    """
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    panel = to_panel(
        table(spark, folder, "orders"),
        date=F.col("o_orderdate"),
        entity=F.year("o_orderdate") * 10 + priority,
        value=F.col("o_totalprice"),
        decimals=2,
    )
    return panel.withColumnRenamed("entity", "entity_id")


def panel_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Line price sold by month and return/line status."""
    return to_panel(
        table(spark, folder, "lineitem"),
        date=F.col("l_shipdate"),
        entity=F.concat("l_returnflag", "l_linestatus"),
        value=F.col("l_extendedprice"),
        how="sum",
        decimals=2,
    )


def panel_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Order price by month and customer: many short series."""
    return to_panel(
        table(spark, folder, "orders"),
        date=F.col("o_orderdate"),
        entity=F.col("o_custkey"),
        value=F.col("o_totalprice"),
        how="sum",
        decimals=2,
    )


def panel_event(spark: SparkSession, folder: str) -> DataFrame:
    """Event value by day and event type."""
    return to_panel(
        table(spark, folder, "events"),
        date=F.col("ts"),
        entity=F.col("event_type"),
        value=F.col("value"),
        how="sum",
        grain="day",
        decimals=2,
    )


def _mean_price(rule: Column | None = None) -> Column:
    """Aggregate: exact mean of the order price, over the rows of ``rule``."""
    cents = F.rint(F.col("o_totalprice") * 100).cast("long")
    chosen = cents if rule is None else F.when(rule, cents)
    return F.try_divide(F.sum(chosen).cast("double") / 100, F.count(chosen))


def wide_priority(spark: SparkSession, folder: str) -> DataFrame:
    """One row per month: a column per priority, and the mean over all as ``idx``."""
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date")).agg(
        *[
            _mean_price(F.col("o_orderpriority") == name).alias(f"p{key}")
            for key, name in PRIORITIES.items()
        ],
        _mean_price().alias("idx"),
    )


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text with unreadable dates, negative, absent and non-numeric prices.

    No row is left out: the remainders of the key only decide which cells are spoiled.
    """
    key = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        F.when(key % 97 == 0, F.lit("n/a"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("raw_date"),
        F.when(key % 89 == 0, (-price).cast("string"))
        .when(key % 83 == 0, F.lit(None).cast("string"))
        .when(key % 79 == 0, F.lit("x"))
        .otherwise(price.cast("string"))
        .alias("raw_price"),
        F.col("o_orderpriority").alias("entity"),
        "o_orderkey",
    )


def raw_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """`lineitem` as a wide raw text file with free-form names and dirty cells.

    No row is left out: the remainders of the key only decide which cells are spoiled.
    """
    key = F.col("l_orderkey")
    price = F.col("l_extendedprice")
    net = price * (1 - F.col("l_discount"))
    return table(spark, folder, "lineitem").select(
        F.when(key % 97 == 0, F.lit("n/a"))
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("Ship Date"),
        F.round(net, 4).cast("decimal(18,4)").cast("string").alias("Net Price (index)"),
        F.when(key % 83 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("Quantity"),
        F.when(key % 89 == 0, (-price).cast("string"))
        .when(key % 79 == 0, F.lit("x"))
        .otherwise(price.cast("string"))
        .alias("Extended Price, USD"),
        F.col("l_tax").cast("string").alias("Tax %"),
        F.col("l_orderkey").cast("string").alias("Order Key"),
        F.col("l_linenumber").cast("string").alias("Line Number"),
        F.col("l_partkey").cast("string").alias("Part Key"),
        F.col("l_suppkey").cast("string").alias("Supplier Key"),
    )


def shipment_order() -> list[Column]:
    """The total order in which duplicate dates of the shipments are resolved."""
    keys = ["Order_Key", "Line_Number", "Part_Key", "Supplier_Key"]
    texts = ["Quantity", "Extended_Price_USD", "Tax"]
    return [*[F.col(name).cast("bigint") for name in keys], *[F.col(name) for name in texts]]
