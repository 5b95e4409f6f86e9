import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from paritylake.session import ensure_session
    s = (SparkSession.builder.master("local[*]").appName("paritylake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_session(s)
    yield s


@pytest.fixture(scope="session")
def sf0001():
    return SF0001


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
