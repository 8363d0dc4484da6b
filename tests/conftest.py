import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SAMPLE_CSV = os.path.join(DATA, "messy_transactions.csv")
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import checkpoint_dir, get_spark

    s = get_spark(master="local[*]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sample_df(spark):
    from ledgerloom.sources.csv_ingest import read_transactions

    return read_transactions(spark, SAMPLE_CSV).cache()


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")
