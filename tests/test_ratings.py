"""The text rating rule equals a non-ANSI cast to int."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revisor.functions.ratings import text_rating_is_int

FIXED = ["4.5", "5.", "+3", "-0.4", " 5 ", "1e3", "3000000000", "NaN", "", "4.x", ".5", ".", "+", "-", "+.",
         "-2147483648", "2147483647", "2147483648", "00000000000000000001", "\t7\n", "1 2", "--1", None]


def _compare(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "r string")
    ours = [r[0] for r in df.select(text_rating_is_int(F.col("r"))).collect()]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        ref = [r[0] for r in df.select(F.col("r").cast("int").isNotNull()).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    for v, a, b in zip(values, ours, ref):
        if v is None:
            assert a is None
        else:
            assert a == b, (v, a, b)


def test_fixed_values(spark):
    _compare(spark, FIXED)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. e\t", max_size=12), min_size=1, max_size=40))
def test_random_text(spark, values):
    _compare(spark, values)
