"""Row filters, per-key statistics and duplicate detection.

Scale notes
-----------
* ``key_stats`` is the only wide aggregation: one ``groupBy(group…, id)``
  whose partial (map-side) aggregation collapses every hot key — the NULL-id
  group included — to one row per map task before the shuffle.  Only the key
  columns and five small flags are read from the scan.
* ``duplicate_rows`` measures the duplicated-key set first (keys, key bytes and
  rows, one small action).  If its bytes fit under the broadcast limit it is
  broadcast and the semi-join is map-side.  Otherwise keys with at least
  ``hot_rows`` copies, a fixed number, are split off and answered map-side; their
  set is broadcast behind a check of its bytes (only where it would not fit does
  the number of copies rise, and AQE splits what stays).  The other keys make a
  Bloom filter, a broadcast table of bit blocks with a fixed largest size, probed
  by built-in functions.  A staged run makes the answer exact by keys alone
  (``_flagged``): the unique keys that pass are counted out of the key columns
  and make a second filter, the duplicated keys that pass that one too, very few,
  are broadcast, and the rows are flagged in one map-side pass: no column beyond
  the keys is ever shuffled.  Where those few would not fit, and in a run that
  stages nothing, rows that the first filter lets pass are joined with the keys
  in one pass (``_one_pass``): each leaves it once for every reason it has, and
  only the reason "perhaps duplicated" is still checked behind the exchange.
* NULL ids never match a key (inner-join semantics), so Catalyst's inferred
  ``isnotnull(id)`` drops them before any exchange.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisor.functions.ratings import rating_fails_type_check
from revisor.operators.columns import project_reviews
from revisor.schemas import CRITICAL_COLUMNS, REQUIRED_COLUMNS

# Largest duplicated-key set (bytes of key text) joined by broadcast.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Copies from which a key is hot, and the largest hot-key set (bytes of key text)
# joined by broadcast.
HOT_ROWS = 100_000
HOT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_KEY_PREFIX = "_k_"


# -- C1 / C2 / C3 -----------------------------------------------------------

def is_valid() -> Column:
    """``id``, ``snippet`` and ``rating`` all present."""
    cond = None
    for c in REQUIRED_COLUMNS:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return cond


def is_null_invalid() -> Column:
    """Exact complement of C1."""
    cond = None
    for c in REQUIRED_COLUMNS:
        term = F.col(c).isNull()
        cond = term if cond is None else cond | term
    return cond


def bad_rating(df: DataFrame) -> Column:
    """Rating that does not cast to int, NULL included."""
    return rating_fails_type_check(F.col("rating"), df.schema["rating"].dataType)


def valid_rows(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return project_reviews(df, group_cols).where(is_valid())


def null_invalid_rows(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return project_reviews(df, group_cols).where(is_null_invalid())


def bad_rating_rows(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return project_reviews(df, group_cols).where(bad_rating(df))


# -- E1 / C4 ------------------------------------------------------------------

def key_counts(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Rows per key; NULL ids form one group per (app, client)."""
    return df.groupBy(*group_cols, "id").agg(F.count(F.lit(1)).alias("count"))


def duplicate_ids(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """E1 + C4: keys seen more than once (the NULL-id group included)."""
    return key_counts(df, group_cols).where(F.col("count") > 1)


# -- one-pass key statistics (E1-E4 together) ----------------------------------

def key_stats(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Per key: rows, NULLs of the critical columns, bad ratings and valid
    rows.  Summing these per group gives every count the checks need."""
    flags = {
        "n_null_snippet": F.col("snippet").isNull(),
        "n_null_rating": F.col("rating").isNull(),
        "n_null_date": F.col("date").isNull(),
        "n_bad_rating": bad_rating(df),
        "n_valid": is_valid(),
    }
    return df.groupBy(*group_cols, "id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(cond).alias(name) for name, cond in flags.items()],
    )


def group_summary(stats: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Per (app, client) totals from ``key_stats`` (a small second-level
    aggregation over one row per key)."""
    n = F.col("n")
    id_null = F.col("id").isNull()

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    out = stats.groupBy(*group_cols).agg(
        total(n).alias("total_records"),
        total(F.when(id_null, n).otherwise(0)).alias("null_id"),
        total(F.col("n_null_snippet")).alias("null_snippet"),
        total(F.col("n_null_rating")).alias("null_rating"),
        total(F.col("n_null_date")).alias("null_date"),
        total(F.col("n_bad_rating")).alias("bad_ratings"),
        total(F.col("n_valid")).alias("valid_records"),
        F.count_if(n > 1).cast("bigint").alias("duplicate_groups"),
        total(F.when(~id_null & (n > 1), n).otherwise(0)).alias("duplicate_rows"),
    )
    null_invalid = F.col("total_records") - F.col("valid_records")
    return out.withColumn("null_invalid_records", null_invalid).withColumn(
        "invalid_records", null_invalid + F.col("duplicate_rows")
    )


def null_counts(df: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """E3 + E4 straight from the rows (no per-key stage): total rows and
    NULLs per critical column."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS],
    )


# -- D1: rows of duplicated keys ----------------------------------------------

@dataclass(frozen=True)
class JoinPlan:
    """How ``duplicate_rows`` joined, for logs and tests."""

    strategy: str  # "empty" | "broadcast" | "shuffle" | "hot_split"
    keys: int
    key_bytes: int
    hot_keys: int = 0
    hot_rows: int = 0


def _renamed_keys(keys: DataFrame, cols: list[str]) -> DataFrame:
    return keys.select(*[F.col(c).alias(_KEY_PREFIX + c) for c in cols])


def _semi(df: DataFrame, keys: DataFrame, cols: list[str], how: str = "left_semi") -> DataFrame:
    """Semi/anti join on the key columns.  Grouping columns compare
    NULL-safely; ``id`` compares with ``=`` so NULL ids never match."""
    cond = None
    for c in cols:
        right = F.col(_KEY_PREFIX + c)
        term = (F.col(c) == right) if c == "id" else F.col(c).eqNullSafe(right)
        cond = term if cond is None else cond & term
    return df.join(keys, cond, how)


def _key_bytes(cols: list[str]) -> Column:
    """Bytes of one key's text, with a per-column overhead."""
    return sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in cols), F.lit(0)) + 16 * len(cols)


def _measure(keys: DataFrame, cols: list[str], count_col: str) -> tuple[int, int, int]:
    """One small action: number of duplicated keys, their key bytes and the rows under them."""
    m = keys.agg(
        F.count(F.lit(1)).alias("k"),
        F.coalesce(F.sum(_key_bytes(cols)), F.lit(0)).alias("b"),
        F.coalesce(F.sum(F.col(count_col)), F.lit(0)).alias("rows"),
    ).first()
    return int(m["k"]), int(m["b"]), int(m["rows"])


def _hot_keys(keys: DataFrame, cols: list[str], count_col: str, hot_rows: int | None) -> tuple[int, int]:
    """Copies from which a key counts as hot, and the number of such keys.

    The threshold is ``hot_rows`` (a constant by default) unless the hot keys
    would not fit under ``HOT_BROADCAST_MAX_BYTES``; then it is the first power of
    ten above it whose keys do."""
    steps = [(hot_rows or HOT_ROWS) * 10 ** k for k in range(8)]
    at_least = [F.col(count_col) >= n for n in steps]
    m = keys.agg(*[F.count_if(c).alias(f"k{i}") for i, c in enumerate(at_least)],
                 *[F.coalesce(F.sum(F.when(c, _key_bytes(cols))), F.lit(0)).alias(f"b{i}") for i, c in enumerate(at_least)]).first()
    i = next(i for i in range(len(steps)) if m[f"b{i}"] <= HOT_BROADCAST_MAX_BYTES or i == len(steps) - 1)
    return steps[i], int(m[f"k{i}"])


# -- a Bloom filter as a table of bit blocks -------------------------------------

FILTER_BITS_PER_KEY = 12
FILTER_MAX_BYTES = 32 * 1024 * 1024  # beyond it the filter lets more rows pass, all of which are checked
_WIDE_BITS = 1 << 15  # bits of one ``bitmap_construct_agg``
_BLOCK_BITS = 1 << 10
_BLOCKS = _WIDE_BITS // _BLOCK_BITS


def _places(cols: list[str], n_wide: int) -> tuple[Column, Column, list[Column]]:
    """A key's wide bitmap, its block there, and its three bits in that block."""
    h = F.xxhash64(*cols)
    block = F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(_BLOCKS - 1).cast("long"))
    bits = [F.shiftrightunsigned(h, at).bitwiseAND(F.lit(_BLOCK_BITS - 1).cast("long")) for at in (25, 36, 47)]
    return F.pmod(h, F.lit(n_wide).cast("long")), block, bits


def key_filter(keys: DataFrame, cols: list[str], n_keys: int) -> tuple[DataFrame, int]:
    """Bit blocks (``_block``, ``_bits``: 64-bit words) of the keys, and the number of wide bitmaps they were cut from."""
    most = FILTER_MAX_BYTES * 8 // _WIDE_BITS
    n_wide = max(1, min(most, -(-n_keys * FILTER_BITS_PER_KEY // _WIDE_BITS)))
    return _bit_blocks(keys, cols, n_wide), n_wide


def _bit_blocks(keys: DataFrame, cols: list[str], n_wide: int) -> DataFrame:
    wide, block, bits = _places(cols, n_wide)
    places = keys.select(wide.alias("wide"), F.explode(F.array(*[block * _BLOCK_BITS + b for b in bits])).alias("place"))
    made = places.groupBy("wide").agg(F.bitmap_construct_agg("place").alias("bits"))
    size = _BLOCK_BITS // 8

    def word(block: Column, i: Column) -> Column:  # eight bytes as one number, the first byte highest
        return F.conv(F.hex(F.substring("bits", block * size + i * 8 + 1, F.lit(8))), 16, -10).cast("long")

    cut = made.select("wide", "bits", F.explode(F.sequence(F.lit(0), F.lit(_BLOCKS - 1))).alias("block"))
    return cut.select((F.col("wide") * _BLOCKS + F.col("block")).alias("_block"),
                      F.transform(F.sequence(F.lit(0), F.lit(size // 8 - 1)), lambda i: word(F.col("block"), i)).alias("_bits"))


def _perhaps(bits: list[Column], blocks: str = "_bits") -> Column:
    """Whether all of a row's bits are set in ``blocks`` (NULL: no block)."""
    cond = F.col(blocks).isNotNull()
    for b in bits:
        word = F.get(F.col(blocks), F.shiftrightunsigned(b, 6).cast("int"))
        # bit 8k + j of a word's bytes is bit 8(7 - k) + j of the number
        cond = cond & (F.getbit(word, b.bitwiseAND(F.lit(63).cast("long")).bitwiseXOR(F.lit(56).cast("long")).cast("int")) == 1)
    return cond


def _hot_flagged(df: DataFrame, keys: DataFrame, cols: list[str], count_col: str, hot_rows: int, n_hot: int) -> tuple[DataFrame, Column]:
    """The rows, and whether their key has ``hot_rows`` copies or more."""
    if not n_hot:
        return df, F.lit(False)
    flags = F.broadcast(_renamed_keys(keys.where(F.col(count_col) >= hot_rows), cols).withColumn("_hot", F.lit(True)))
    return _semi(df, flags, cols, "left").drop(*[_KEY_PREFIX + c for c in cols]), F.coalesce(F.col("_hot"), F.lit(False))


def _plan(n_keys: int, n_bytes: int, n_hot: int, hot_rows: int) -> JoinPlan:
    return JoinPlan("hot_split" if n_hot else "shuffle", n_keys, n_bytes, n_hot, hot_rows)


def _flagged(df: DataFrame, keys: DataFrame, cols: list[str], count_col: str, hot_rows: int | None, n_keys: int, n_bytes: int,
             stage_path: str) -> tuple[DataFrame, Column, JoinPlan] | None:
    """The rows, whether their key is in ``keys`` (every key of ``df`` with more than one row), and the plan.

    Only key columns are shuffled: a key that passes the filter of ``keys`` and is
    not among them is unique, so counting the keys that pass finds it.  These make
    the second filter, and what passes both is looked up in ``unsure``, the
    duplicated keys that do.  None if ``unsure`` is too large to broadcast.
    """
    spark = df.sparkSession
    folder = os.path.join(stage_path, f"_keys-{uuid.uuid4().hex}")  # underscored: no part of the staged table beside it

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(os.path.join(folder, name))
        return spark.read.schema(frame.schema).parquet(os.path.join(folder, name))

    hot_rows, n_hot = _hot_keys(keys, cols, count_col, hot_rows)
    cold = keys.where(F.col(count_col) < hot_rows).select(*cols)
    first, n_wide = key_filter(cold, cols, max(1, n_keys - n_hot))
    first = kept(first, "first")
    wide, block, bits = _places(cols, n_wide)

    def placed(rows: DataFrame, blocks: DataFrame, how: str = "left") -> DataFrame:
        return rows.withColumn("_at", wide * _BLOCKS + block).join(F.broadcast(blocks), F.col("_at") == F.col("_block"), how)

    named, hot = _hot_flagged(df.select(*cols).where(F.col("id").isNotNull()), keys, cols, count_col, hot_rows, n_hot)
    passing = placed(named.where(~hot), first, "inner").where(_perhaps(bits))
    unique = passing.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 1).select(*cols)
    second = kept(_bit_blocks(unique, cols, n_wide), "second")
    unsure = kept(placed(cold, second, "inner").where(_perhaps(bits)).select(*cols), "unsure")
    if unsure.agg(F.coalesce(F.sum(_key_bytes(cols)), F.lit(0))).first()[0] > HOT_BROADCAST_MAX_BYTES:
        return None
    blocks = first.join(second.withColumnRenamed("_bits", "_unique"), "_block", "left")
    rows, hot = _hot_flagged(df, keys, cols, count_col, hot_rows, n_hot)
    rows = _semi(placed(rows, blocks), F.broadcast(_renamed_keys(unsure, cols).withColumn("_listed", F.lit(True))), cols, "left")
    passes = F.col("id").isNotNull() & _perhaps(bits) & (~_perhaps(bits, "_unique") | F.col("_listed").isNotNull())
    return rows, hot | passes, _plan(n_keys, n_bytes, n_hot, hot_rows)


def _one_pass(df: DataFrame, keys: DataFrame, cols: list[str], count_col: str, hot_rows: int | None, n_keys: int, n_bytes: int,
              reasons: list[Column]) -> tuple[DataFrame, JoinPlan]:
    """Every row once for each of the ``reasons`` (true, false) that holds, and once more if its key is in ``keys``.

    Keys with many copies are flagged by broadcast, rows of the others are marked
    by the filter, and only marked rows are compared with the keys behind an
    exchange.  Rows with a settled reason go along under any route, so a NULL or hot
    key of theirs meets in no one task.
    """
    hot_rows, n_hot = _hot_keys(keys, cols, count_col, hot_rows)
    cold = keys.where(F.col(count_col) < hot_rows)
    rows, hot = _hot_flagged(df, keys, cols, count_col, hot_rows, n_hot)
    blocks, n_wide = key_filter(cold, cols, max(1, n_keys - n_hot))
    wide, block, bits = _places(cols, n_wide)
    rows = rows.withColumn("_at", wide * _BLOCKS + block).join(F.broadcast(blocks), F.col("_at") == F.col("_block"), "left")
    settled = [*reasons, hot]
    open_ = F.col("id").isNotNull() & ~hot & _perhaps(bits)
    found = F.filter(F.array(*[F.when(c, F.lit(i + 1)) for i, c in enumerate(settled)], F.when(open_, F.lit(0))),
                     lambda x: x.isNotNull())
    marked = rows.select(*df.columns, F.explode(found).alias("_reason"))
    # the key's hash, or any number for a settled row: it only spreads those
    route = F.when(F.col("_reason") == 0, F.xxhash64(*cols)).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    cold = _renamed_keys(cold.withColumn("_route", F.xxhash64(*cols)), [*cols, "_route"])
    cond = F.col("_route") == F.col(_KEY_PREFIX + "_route")
    for c in cols:
        right = F.col(_KEY_PREFIX + c)
        cond = cond & ((F.col(c) == right) if c == "id" else F.col(c).eqNullSafe(right))
    # the keys are the smaller side and narrow: hashed, the rows, all their columns, need no sort
    joined = marked.withColumn("_route", route).join(cold.hint("shuffle_hash"), cond, "left")
    out = joined.where((F.col("_reason") > 0) | F.col(_KEY_PREFIX + "_route").isNotNull()).select(*df.columns)
    return out, _plan(n_keys, n_bytes, n_hot, hot_rows)


def duplicate_rows_planned(
    df: DataFrame,
    dup_keys: DataFrame,
    group_cols: list[str] | tuple[str, ...] = (),
    *,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    hot_rows: int | None = None,
    measured: tuple[int, int, int] | None = None,
) -> tuple[DataFrame, JoinPlan]:
    """Every row whose non-NULL key appears more than once.

    ``dup_keys`` holds ``group_cols…, id, count`` with ``count > 1`` (it may
    contain the NULL-id group; NULL ids never match).  Returns the rows and
    the join plan chosen.
    """
    cols = [*group_cols, "id"]
    count_col = "count" if "count" in dup_keys.columns else "n"
    keys = dup_keys.where(F.col("id").isNotNull())
    n_keys, n_bytes, _ = measured or _measure(keys, cols, count_col)

    if n_keys == 0:
        return df.where(F.lit(False)), JoinPlan("empty", 0, 0)

    if n_bytes <= broadcast_max_bytes:
        right = F.broadcast(_renamed_keys(keys, cols))
        return _semi(df, right, cols), JoinPlan("broadcast", n_keys, n_bytes)

    return _one_pass(df, keys, cols, count_col, hot_rows, n_keys, n_bytes, [])


def side_rows_planned(
    df: DataFrame,
    dup_keys: DataFrame,
    group_cols: list[str] | tuple[str, ...] = (),
    *,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    stage_path: str | None = None,
    **kwargs,
) -> tuple[DataFrame, JoinPlan]:
    """Both sides in one frame with a ``side`` column (``valid`` /
    ``invalid``): every valid row once on the valid side and the rows of F1
    on the invalid side.  When the duplicated keys are broadcast, or a staged
    run flags them by filters (``stage_path``), this is one map-side pass over
    ``df`` (each row is emitted once per side and reason); otherwise the valid
    filter is unioned with ``invalid_rows_planned``."""
    cols = [*group_cols, "id"]
    count_col = "count" if "count" in dup_keys.columns else "n"
    keys = dup_keys.where(F.col("id").isNotNull())
    n_keys, n_bytes, _ = _measure(keys, cols, count_col)
    review_cols = [*group_cols, *project_reviews(df).columns]
    found = None
    if n_keys == 0:
        found = df, F.lit(False), JoinPlan("empty", 0, 0)
    elif n_bytes <= broadcast_max_bytes:
        flags = F.broadcast(_renamed_keys(keys, cols).withColumn("_dup", F.lit(True)))
        found = _semi(df, flags, cols, "left"), F.coalesce(F.col("_dup"), F.lit(False)), JoinPlan("broadcast", n_keys, n_bytes)
    elif stage_path:
        found = _flagged(df, keys, cols, count_col, kwargs.get("hot_rows"), n_keys, n_bytes, stage_path)
    if found:
        flagged, dup, plan = found
        # every row has one side of its own (C2 is C1's complement); no lambda, which would be interpreted with all below it
        invalid = F.array(F.lit("invalid"))
        sides = F.concat(F.when(is_valid(), F.array(F.lit("valid"))).otherwise(invalid),
                         F.when(dup, invalid).otherwise(F.slice(invalid, 1, 0)))
        return flagged.select(*review_cols, F.explode(sides).alias("side")), plan
    invalid, plan = invalid_rows_planned(df, dup_keys, group_cols, broadcast_max_bytes=broadcast_max_bytes,
                                         **kwargs)
    valid = project_reviews(df, group_cols).where(is_valid())
    return (valid.withColumn("side", F.lit("valid"))
            .unionByName(invalid.select(*review_cols).withColumn("side", F.lit("invalid")))), plan


def invalid_rows_planned(
    df: DataFrame,
    dup_keys: DataFrame,
    group_cols: list[str] | tuple[str, ...] = (),
    *,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    stage_path: str | None = None,
    **kwargs,
) -> tuple[DataFrame, JoinPlan]:
    """F1 (NULL-invalid rows plus every copy of every duplicated key) with
    the fewest scans of ``df``.

    When the duplicated-key set is broadcast, one map-side pass does it: a
    left outer broadcast join flags duplicated rows, and each row is emitted
    once per reason (NULL-invalid, duplicated), so a duplicated row with a
    NULL required field appears twice, as in the union.  Keys too many to
    broadcast are looked for in one pass too: map-side where a ``stage_path``
    is given (``_flagged``), else behind an exchange (``_one_pass``).
    """
    cols = [*group_cols, "id"]
    count_col = "count" if "count" in dup_keys.columns else "n"
    keys = dup_keys.where(F.col("id").isNotNull())
    measured = _measure(keys, cols, count_col)
    n_keys, n_bytes, _ = measured
    null_invalid = project_reviews(df, group_cols).where(is_null_invalid())
    if n_keys == 0:
        return null_invalid, JoinPlan("empty", 0, 0)
    found = None
    if n_bytes <= broadcast_max_bytes:
        flags = F.broadcast(_renamed_keys(keys, cols).withColumn("_dup", F.lit(True)))
        found = _semi(df, flags, cols, "left"), F.coalesce(F.col("_dup"), F.lit(False)), JoinPlan("broadcast", n_keys, n_bytes)
    elif stage_path:
        found = _flagged(df, keys, cols, count_col, kwargs.get("hot_rows"), n_keys, n_bytes, stage_path)
    if found:
        joined, dup, plan = found
        copies = is_null_invalid().cast("int") + dup.cast("int")
        out = joined.where(copies > 0).select(
            *group_cols, *[F.col(c) for c in project_reviews(df).columns],
            F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
        ).drop("_copy")
        return out, plan
    rows = df.select(*group_cols, *project_reviews(df).columns)
    return _one_pass(rows, keys, cols, count_col, kwargs.get("hot_rows"), n_keys, n_bytes, [is_null_invalid()])


def duplicate_rows(df: DataFrame, dup_keys: DataFrame, group_cols: list[str] | tuple[str, ...] = (),
                   **kwargs) -> DataFrame:
    rows, _ = duplicate_rows_planned(df, dup_keys, group_cols, **kwargs)
    return project_reviews(rows, group_cols)


def invalid_rows(null_invalid: DataFrame, dup_rows: DataFrame) -> DataFrame:
    """NULL-invalid rows plus every copy of every duplicated key (a row
    that is both lands twice)."""
    return null_invalid.unionByName(dup_rows)
