import datetime

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from ctrflow.schema import IMPRESSIONS
from ctrflow.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="10000", spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def raw(spark):
    """All small impressions."""
    return fx.impressions(spark, SMALL).cache()


@pytest.fixture(scope="session")
def clean(spark):
    return fx.clean(spark, SMALL).cache()


DEFAULTS = {
    "session_id": 1, "DateTime": datetime.datetime(2024, 1, 1), "user_id": 1, "product": "A",
    "campaign_id": 1, "webpage_id": 1, "product_category_1": 1, "product_category_2": 1.0,
    "user_group_id": 1.0, "gender": "Male", "age_level": 1.0, "user_depth": 1.0,
    "city_development_index": 1.0, "is_click": 0,
}


@pytest.fixture(scope="session")
def rows_of(spark):
    """Impressions from partial rows: {column: value}; the time may be given in minutes."""

    def build(*rows):
        data = []
        for i, row in enumerate(rows, 1):
            full = DEFAULTS | {"session_id": i} | row
            if isinstance(full["DateTime"], int):
                full["DateTime"] = DEFAULTS["DateTime"] + datetime.timedelta(minutes=full["DateTime"])
            data.append(tuple(full[c] for c in IMPRESSIONS.names))
        return spark.createDataFrame(data, IMPRESSIONS)

    return build


def table(df, *order):
    """Rows as tuples, sorted."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def same(a, b):
    """Whether two frames hold the same rows."""
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    return df._jdf.queryExecution().toString()


def executed(df):
    """The plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(df):
    """A third of all rows belong to one user, and half of those share one point in time."""
    hot = F.col("session_id") % 3 == 0
    one_time = hot & (F.col("session_id") % 2 == 0)
    return df.withColumn("user_id", F.when(hot, 1).otherwise(F.col("user_id"))).withColumn(
        "DateTime",
        F.when(one_time, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")).otherwise(F.col("DateTime")),
    )
