"""Column operators: add-if-missing, fixed projection, schema coercion and
load-date stamp.  All are single ``select``/``withColumn`` projections, so they
fuse into the scan's codegen stage and never shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisor.schemas import BRONZE_SCHEMA, RAW_RATING, REVIEW_COLUMNS


def ensure_column(df: DataFrame, name: str, data_type: T.DataType | None = None) -> DataFrame:
    """Add ``name`` as a NULL column when absent (B1).  The type defaults to
    the bronze schema's type, so every run writes the same Parquet type."""
    if name in df.columns:
        return df
    if data_type is None:
        data_type = BRONZE_SCHEMA[name].dataType
    return df.withColumn(name, F.lit(None).cast(data_type))


def project_reviews(df: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The fixed review projection (B2), after the ``keep`` columns
    (grouping keys such as ``app``/``type_client``); a rating kept as it came
    stays with its row."""
    raw = [RAW_RATING] if RAW_RATING in df.columns else []
    return df.select(*keep, *REVIEW_COLUMNS, *raw)


def keep_raw_rating(df: DataFrame) -> DataFrame:
    """The rating's text in a column of its own, so that a typed write loses
    nothing of a rating that is not a number."""
    if RAW_RATING in df.columns:
        return df
    return df.withColumn(RAW_RATING, F.col("rating").cast("string"))


def coerce(df: DataFrame, schema: T.StructType = BRONZE_SCHEMA, strict: bool = False,
           keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Select the schema's columns in schema order.

    Default mode casts only ``int`` and ``string`` fields and passes the rest
    through with their current type; a missing column raises, extra columns
    are dropped.  ``strict=True`` converts every field to the declared type
    with ``try_cast`` (a value that does not convert becomes NULL), so the
    written type never drifts.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the schema: {missing}")
    current = dict(df.dtypes)
    exprs = [F.col(c) for c in keep]
    for field in schema.fields:
        c = F.col(field.name)
        if strict:
            if current[field.name] != field.dataType.simpleString():
                c = c.try_cast(field.dataType)
        elif isinstance(field.dataType, (T.IntegerType, T.StringType)):
            c = c.cast(field.dataType)
        exprs.append(c.alias(field.name))
    return df.select(*exprs)


def stamp(df: DataFrame, odate: str, column: str = "odate") -> DataFrame:
    """Load-date partition column (B5); ``odate`` is a ``yyyyMMdd`` string
    chosen once per run by the caller."""
    return df.withColumn(column, F.lit(odate))
