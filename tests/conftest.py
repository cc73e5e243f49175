import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from condoledger.session import checkpoint_dir, local_session
    s = local_session("*", 8)
    checkpoint_dir(s)
    yield s


def values(spark, fn, inputs, col_type="string"):
    """Apply a column rule to a list of literal inputs, return outputs in order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {col_type}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def values_df(spark, transform, inputs, col_type="string"):
    """Apply a DataFrame rule (src 'v' -> 'o') to literal inputs, outputs in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {col_type}")
    return [r["o"] for r in df.transform(transform).orderBy("i").collect()]
