"""The rating type rule.

A rating passes the type check when a *non-ANSI* cast to ``int`` gives a
value.  Spark 4 runs with ANSI casts on by default (where ``'bad'`` raises and
``'4.5'`` does not convert), so the rule is spelled out with built-in
functions instead of depending on the session's ANSI flag:

* numeric ratings: a non-ANSI numeric cast never yields NULL for a non-NULL
  input, so only NULL fails;
* text ratings: after trimming ASCII whitespace/control characters, the text
  must be an optional sign, digits, and an optional ``.`` fraction of digits,
  must not be empty or a bare sign, and the integer part must fit in 32 bits.
  ``'.5'`` and ``'.'`` pass (they convert to 0), ``'1e3'`` and
  ``'3000000000'`` fail.

Everything stays a JVM expression inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that converts: optional sign, then digits with an optional fraction,
# or a bare fraction; ASCII whitespace/control characters around it.
_INT_TEXT = r"^[\x00-\x20\x7f]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*)[\x00-\x20\x7f]*\z"
# The signed integer part of such text (may be just a sign or empty).
_INT_PART = r"^[\x00-\x20\x7f]*([+-]?[0-9]*)"


def text_rating_is_int(rating: Column) -> Column:
    """TRUE when the text converts to int, FALSE otherwise, NULL for NULL.
    What ``try_cast`` converts passes; one ``rlike`` and one ``regexp_extract``
    decide the rest, such as ``'4.5'`` (far dearer, so only there)."""
    int_part = F.regexp_extract(rating, _INT_PART, 1)
    no_digits = int_part.isin("", "+", "-")  # ".5", "-.": the value is 0
    in_range = no_digits | int_part.try_cast(T.IntegerType()).isNotNull()
    return (F.when(rating.isNull(), F.lit(None).cast("boolean")).when(rating.try_cast(T.IntegerType()).isNotNull(), F.lit(True))
            .otherwise(rating.rlike(_INT_TEXT) & in_range))


def rating_fails_type_check(rating: Column, data_type: T.DataType) -> Column:
    """Predicate of rows whose rating does not cast to int (NULL counts)."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(~text_rating_is_int(rating), F.lit(True))
    if isinstance(data_type, T.NumericType) or isinstance(data_type, T.BooleanType):
        return rating.isNull()
    raise TypeError(f"rating column of unsupported type {data_type.simpleString()}")
