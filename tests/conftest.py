import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rowsieve_checks.inputs import PERSON_RULES as PRODUCTION_RULES  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def database(spark, request):
    import uuid

    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def rules():
    return PRODUCTION_RULES


@pytest.fixture
def people(spark):
    rows = [
        ("ada", 41, "RIO"),
        ("bo", 12, ""),
        ("cy", None, "RIO"),
        ("di", 65, "MADRID"),
        ("ed", 18, None),
        ("flo", 64, "MADRID"),
    ]
    return spark.createDataFrame(rows, "name STRING, age INT, office STRING")


def plan_of(df, mode="formatted"):
    """The text of ``df.explain(mode)``."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def multiset(df):
    from collections import Counter

    return Counter(repr(tuple(row)) for row in df.collect())
