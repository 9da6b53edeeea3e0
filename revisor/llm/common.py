"""Staged tables, Arrow helpers and fixed-size Bloom filters shared by the operators.

*Staging.*  ``staged`` writes a frame to the shared checkpoint folder as
Parquet and reads it back with its declared schema: lineage is cut, a lost
executor costs nothing that was staged, and an empty frame stays readable.
``revisor.session.release`` removes such a folder once a later table replaces it.

*Bloom filters.*  ``bloom`` fills segments of a bit set on the executors and
returns one filter whose size never passes ``max_bits``, however large the
input; beyond that only its false-positive rate rises.  Callers use it to skip
work, never to decide a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisor.session import release, stage_dir

MAX_BLOOM_BITS = 1 << 28  # 32 MiB, whatever the corpus size
SEGMENT_BITS = 1 << 20
BATCH_ROWS = 1000
BLOOM_HASHES = 4
BLOOM_BITS_PER_KEY = 12


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared checkpoint folder; return it reread, and its path."""
    spark = df.sparkSession
    path = stage_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def bound_batches(df: DataFrame) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows.

    Texts can be long: Spark's 10,000 rows would be gigabytes between the JVM and
    a Python worker where texts have 100 KB.  A smaller setting stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))


def rename_free(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: extra columns never clash."""
    bound_batches(df)
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def string_views(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Zero-copy byte views of an Arrow string or binary array; None for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        if valid is not None and not valid[i]:
            yield None
        else:
            yield data[offsets[i]:offsets[i + 1]]


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` (a longer row stands alone)."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * max_bytes / max(1, batch.nbytes)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


class Bloom:
    """Bits of a Bloom filter over 64-bit hashes, in segments; a key's bits lie in one segment.

    ``words`` has a row for each segment; both numbers are powers of two.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.flat = words.reshape(-1)

    @staticmethod
    def segment(hashes: np.ndarray, segments: int) -> np.ndarray:
        if segments == 1:
            return np.zeros(len(hashes), dtype=np.uint64)
        return hashes >> np.uint64(64 - (segments.bit_length() - 1))

    @staticmethod
    def positions(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        """Bits of the keys within their segments."""
        mask = np.uint64(bits - 1)
        step = (hashes >> np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        at = hashes.copy()
        for _ in range(BLOOM_HASHES):
            yield (at ^ (at >> np.uint64(31))) & mask
            at = at + step

    def has(self, hashes: np.ndarray) -> np.ndarray:
        segments, width = self.words.shape
        base = self.segment(hashes, segments) * np.uint64(width)
        found = np.ones(len(hashes), dtype=bool)
        for at in self.positions(hashes, width * 64):
            found &= (self.flat[base + (at >> np.uint64(6))] >> (at & np.uint64(63))) & np.uint64(1) != 0
        return found


def bloom_bits(count: int, max_bits: int = MAX_BLOOM_BITS) -> int:
    bits = 1 << 12
    while bits < count * BLOOM_BITS_PER_KEY and bits < max_bits:
        bits <<= 1
    return bits


def bloom(df: DataFrame, column: str, count: int, max_bits: int = MAX_BLOOM_BITS) -> Bloom:
    """Filter over the 64-bit hashes in ``column`` (nulls are left out).

    Hashes are dealt out by segment, so a task makes whole segments and the
    driver receives each segment once: ``max_bits`` bits at most.
    """
    bits = bloom_bits(count, max_bits)
    segments = max(1, bits // SEGMENT_BITS)
    width = bits // segments // 64

    def fill(batches):
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            own = Bloom.segment(hashes, segments)
            for segment in np.unique(own):
                words = made.setdefault(int(segment), np.zeros(width, dtype=np.uint64))
                for at in Bloom.positions(hashes[own == segment], width * 64):
                    np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        for segment, words in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([words.tobytes()], pa.binary())],
                                             names=["segment", "words"])

    h = F.col(column).cast("long")
    segment = F.lit(0) if segments == 1 else F.shiftrightunsigned(h, 64 - (segments.bit_length() - 1)).cast("int")
    dealt = df.select(h.alias("h"), segment.alias("segment")).where("h IS NOT NULL").repartition(segments, "segment")
    found = dealt.select("h").mapInArrow(fill, "segment int, words binary").toArrow()
    words = np.zeros((segments, width), dtype=np.uint64)
    for segment, data in zip(found.column("segment").to_pylist(), found.column("words").to_pylist()):
        words[segment] = np.frombuffer(data, dtype=np.uint64)
    return Bloom(words)


def numbered(docs: DataFrame) -> DataFrame:
    """The same columns named ``c0, c1, ...``: names with dots or clashing ones do no harm inside an operator."""
    bound_batches(docs)
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def split(docs: DataFrame, id_col: str, filter_: Bloom, hit: bool) -> DataFrame:
    """Rows, all columns, whose id's ``xxhash64``, as a long, passes the filter (``hit``) or surely is not in it.

    A null id is never a hit.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    rows = numbered(docs)
    own = F.col(f"c{docs.columns.index(id_col)}")
    n = len(docs.columns)

    def run(batches):
        filter_ = shared.value
        for batch in batches:
            named = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            found = named & filter_.has(batch.column(0).fill_null(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(found if hit else ~found)).select(list(range(1, n + 1)))

    keyed = rows.select(F.when(own.isNotNull(), F.xxhash64(own.cast("long"))).alias("key"), "*")
    return keyed.mapInArrow(run, rows.schema).toDF(*docs.columns)


def without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (one column, that name); a null id stays.

    Only rows that a filter of the ids lets pass take part in the join; the
    others, nearly all that stay, are not shuffled.
    """
    ids, _ = staged(ids.filter(F.col(id_col).isNotNull()), "drop-ids")
    keys = ids.select(F.xxhash64(F.col(id_col).cast("long")).alias("key"))
    filter_ = bloom(keys, "key", keys.count())
    hits = numbered(split(docs, id_col, filter_, True))
    own = f"c{docs.columns.index(id_col)}"
    left = hits.join(ids.toDF("__id"), F.col(own) == F.col("__id"), "left_anti")
    return split(docs, id_col, filter_, False).union(left.toDF(*docs.columns))


OWN_ID = "__own_id"


def with_own_ids(docs: DataFrame, id_col: str) -> tuple[DataFrame, bool]:
    """``docs`` and ``OWN_ID``, a long that no two rows share; whether it differs from the id anywhere.

    An id that is there and occurs once is a row's own.  Rows that repeat an id, or
    have none, get new ones beyond all others, so they come last in any order by
    id; these rows alone are staged, which makes their ids stable, however many
    share one id.  Ids are counted by an aggregation that combines on the map side.
    """
    spark = docs.sparkSession
    own = docs[id_col].cast("long")
    odd, path = staged(docs.select(own.alias("id")).groupBy("id").agg(F.count("*").alias("n"))
                       .filter("id IS NULL OR n > 1").select("id"), "odd-ids")
    if odd.isEmpty():
        release(spark, path)
        return docs.withColumn(OWN_ID, own), False
    repeated = odd.filter("id IS NOT NULL")
    keys = repeated.select(F.xxhash64("id").alias("key"))
    filter_ = bloom(keys, "key", keys.count())
    hits, others = split(docs, id_col, filter_, True), split(docs, id_col, filter_, False)
    ends = docs.agg(F.min(own).alias("low"), F.max(own).alias("high")).first()
    number = F.monotonically_increasing_id()
    after = ends["high"] is None or ends["high"] < 1 << 62
    new = number + F.lit((-1 if ends["high"] is None else ends["high"]) + 1) if after else F.lit(ends["low"] - 1) - number
    same = hits[id_col].cast("long") == repeated["id"]
    strange, _ = staged(numbered(hits.join(repeated, same, "left_semi").union(others.filter(others[id_col].isNull())))
                        .withColumn(OWN_ID, new), "odd-rows")
    plain = others.filter(others[id_col].isNotNull()).union(hits.join(repeated, same, "left_anti"))
    return plain.withColumn(OWN_ID, plain[id_col].cast("long")).union(strange.toDF(*docs.columns, OWN_ID)), True
