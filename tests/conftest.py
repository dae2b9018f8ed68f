import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from billweave.session import tune

    folder = tmp_path_factory.mktemp("spark")
    session = (
        tune(SparkSession.builder.master("local[4]"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def report(spark):
    """Makes a raw report: rows given as dicts, all other columns blank."""
    from billweave.schema import REPORT_COLUMNS, text_schema

    def make(rows, **common):
        filled = [{**common, **r} for r in rows]
        return spark.createDataFrame(
            [tuple(str(r.get(c, "")) for c in REPORT_COLUMNS) for r in filled], text_schema()
        )

    return make
