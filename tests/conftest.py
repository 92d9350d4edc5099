import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadrisk.session import session  # noqa: E402

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def rows_of(spark):
    """A frame of the given schema from dicts; absent fields are NULL."""
    def build(schema, *records, **defaults):
        from pyspark.sql.types import StructType
        fields = StructType.fromDDL(schema)
        data = [tuple({**defaults, **record}.get(f.name) for f in fields) for record in records]
        return spark.createDataFrame(data, fields)
    return build


def one(df, *columns):
    """The values of the only row."""
    (row,) = df.select(*columns).collect() if columns else df.collect()
    return tuple(row) if len(columns) != 1 else row[0]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
