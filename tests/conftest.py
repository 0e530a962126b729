import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build(
        "tidemark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def panel(spark):
    """Rows ``(ISO date, entity, value)`` as a panel."""
    from pyspark.sql import functions as F

    def make(rows, entity="string"):
        df = spark.createDataFrame(rows, f"d string, entity {entity}, value double")
        return df.select(F.to_date("d").alias("date"), "entity", "value")

    return make
