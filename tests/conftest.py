import json

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tributary.session import prepare


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return prepare(session)


@pytest.fixture
def docs(spark):
    """Documents (dicts or JSON texts) as ``page_no, ordinal, raw, doc``, in the order given."""

    def build(*documents):
        texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
        rows = [(0, i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "page_no long, ordinal long, raw string").withColumn("doc", F.parse_json("raw"))

    return build


@pytest.fixture
def rows():
    """Rows of a DataFrame as dicts, in order of its columns named, or as they come."""

    def collect(df, *order):
        return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]

    return collect


def plan(df) -> str:
    return df._jdf.queryExecution().toString()
