"""Column operators: add-if-missing (B1), coercion (B4), stamp."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisor.operators.columns import coerce, ensure_column, project_reviews, stamp
from revisor.schemas import BRONZE_SCHEMA, REVIEW_COLUMNS


def _raw(spark):
    rows = [("a", "d", "1", "i", 5, "4.5", None, "s", "t", "extra")]
    schema = ("avatar string, date string, id string, iso_date string, likes int, rating string, "
              "response map<string,string>, snippet string, title string, other string")
    return spark.createDataFrame(rows, schema)


def test_ensure_column_uses_declared_type(spark):
    df = _raw(spark).drop("response")
    out = ensure_column(df, "response")
    assert out.schema["response"].dataType == BRONZE_SCHEMA["response"].dataType
    assert ensure_column(out, "response") is out  # present: unchanged


def test_coerce_default_casts_only_int_and_string(spark):
    out = coerce(_raw(spark))
    assert out.columns == REVIEW_COLUMNS  # schema order, extra column dropped
    types = dict(out.dtypes)
    assert types["likes"] == "int"  # long field: passed through uncast
    assert types["rating"] == "string"  # double field: passed through uncast
    with pytest.raises(ValueError):
        coerce(_raw(spark).drop("title"))


def test_coerce_strict_converts_every_field(spark):
    df = _raw(spark).union(_raw(spark).withColumn("rating", F.lit("bad")))
    out = coerce(df, strict=True)
    assert out.schema == BRONZE_SCHEMA
    assert sorted(r["rating"] for r in out.collect() if r["rating"] is not None) == [4.5]


def test_stamp_and_projection(spark):
    out = stamp(project_reviews(_raw(spark).withColumn("app", F.lit("x")), ["app"]), "20240101")
    assert out.columns == ["app", *REVIEW_COLUMNS, "odate"]
    assert out.first()["odate"] == "20240101"
    assert isinstance(out.schema["odate"].dataType, T.StringType)
