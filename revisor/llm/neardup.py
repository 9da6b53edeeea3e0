"""MinHash near-duplicate removal with SetSketch registers (operator 6).

A document's set is its distinct 5-word shingles; documents of Jaccard
similarity 0.75 or more are linked, links are confirmed on the full sets, and
one document of each component stays.

1. *Sketch.*  ``REGISTERS`` registers hold ``floor(1 - log_b(x))`` of the smallest
   exponential variate of the set, truncated to 16 bits: exponentially spaced
   minima.  Sketches merge by the larger register (``merge``).
2. *Classes.*  Documents of equal sets form a class; its smallest id stands for
   it from here on, so copies never meet each other in a bucket.
3. *Bands.*  ``BANDS`` bands of ``ROWS`` registers; at the threshold a pair shares
   no band with probability (1 - 0.75**ROWS)**BANDS, below 3e-7.  Buckets of one
   class end here.
4. *Stars.*  In every bucket each class is paired with the smallest one; pairs
   are kept if the joint likelihood of both register arrays (equal, larger,
   smaller) puts the similarity within ``MARGIN`` of the threshold, then both full
   sets are compared, and confirmed links are contracted to components.
5. *Rest.*  Buckets that still hold several components are compared across
   components, in blocks: first registers alone tell which members are in any
   likely pair, then the full sets of those are compared inside the task, most
   likely pairs first, until their components are linked.  Every likely pair
   across components is tested, so no link between different texts is lost; the
   pairs inside a component, nearly all of a hot group, are never made, and no
   pairs are emitted but the links that join components.

Defined cases: texts without words are linked with nothing; with fewer than five
words the whole sequence is the one shingle; rows that repeat an id, or have none,
are documents of their own that come after all others (``with_own_ids``), so each
is linked by its text alone, ``component_id`` is the smallest id in its component
(null if there is none), and one row of a component is kept; equal rows are one
class, however many; a text of any length is read whole; an empty table gives no
rows; columns beyond id and text are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import OWN_ID, bloom, rename_free, slices, staged, string_views, with_own_ids, without
from revisor.llm.components import components
from revisor.llm.hashing import mix, shingles, word_hashes
from revisor.session import release

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
ROWS, BANDS = 4, 40
REGISTERS = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
MARGIN = 0.15  # over four standard deviations of the estimate at the threshold
BLOCK, BLOCK_SHINGLES = 256, 1 << 18

_rng = np.random.default_rng(6)
_MULTIPLY = _rng.integers(1, 1 << 62, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        x = hashes[at:at + 512, None] * _MULTIPLY + _ADD
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        np.minimum(least, x.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 1.0) / 2.0 ** 64
    smallest = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union."""
    return np.maximum(a, b)


def estimate(n_a, n_b, equal, larger) -> np.ndarray:
    """Likeliest Jaccard similarity given both set sizes and the numbers of equal and larger registers of a."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    smaller = REGISTERS - equal - larger
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 101)[:, None] * top

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    above, below = p(u - v * grid), p(v - u * grid)
    like = (larger * np.log(np.maximum(above, 1e-300)) + smaller * np.log(np.maximum(below, 1e-300))
            + equal * np.log(np.maximum(1 - above - below, 1e-300)))
    return grid[like.argmax(axis=0), np.arange(grid.shape[1])]


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band."""
    r = registers.astype(np.uint64).reshape(BANDS, ROWS)
    key = r[:, 0] | r[:, 1] << np.uint64(16) | r[:, 2] << np.uint64(32) | r[:, 3] << np.uint64(48)
    return mix(mix(key) + np.arange(BANDS, dtype=np.uint64))


def shingle_hashes(data: np.ndarray) -> np.ndarray:
    return shingles(word_hashes(data), SHINGLE_WORDS)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on sorted distinct shingle hashes."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= THRESHOLD_PERCENT * (len(a) + len(b) - both)


def sketches(rows: DataFrame) -> DataFrame:
    """(doc_id, n, d1, d2, registers) of every document; no digest or registers for empty sets."""

    def run(batches):
        for batch in slices(batches, 4 << 20):
            n, d1, d2, registers = [], [], [], []
            for data in string_views(batch.column(1)):
                own = shingle_hashes(data) if data is not None else np.zeros(0, np.uint64)
                n.append(len(own))
                if len(own):
                    half = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), dtype=np.int64)
                    d1.append(int(half[0]))
                    d2.append(int(half[1]))
                    registers.append(sketch(own).tobytes())
                else:
                    d1.append(None)
                    d2.append(None)
                    registers.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(registers, pa.binary())], names=["doc_id", "n", "d1", "d2", "registers"])

    return rows.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, registers binary")


def _band_rows(classes: DataFrame, passing=None) -> DataFrame:
    """(bucket, cls) of every class and band, or of the buckets that pass the filter."""
    shared = classes.sparkSession.sparkContext.broadcast(passing)

    def run(batches):
        filter_ = shared.value
        for batch in slices(batches, 1 << 20):
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            buckets = np.concatenate([band_hashes(r) for r in registers])
            cls = np.repeat(batch.column(0).to_numpy(), BANDS)
            if filter_ is not None:
                keep = filter_.has(buckets)
                buckets, cls = buckets[keep], cls[keep]
            yield pa.RecordBatch.from_arrays([pa.array(buckets.view(np.int64)), pa.array(cls)], names=["bucket", "cls"])

    return classes.select("cls", "registers").mapInArrow(run, "bucket long, cls long")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose estimate is near or above the threshold."""
    side = classes.select("cls", "n", "registers")
    joined = (pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b")
              .select("a", "b", "n_a", "n_b", "r_a", "r_b"))

    def run(batches):
        for batch in slices(batches, 4 << 20):
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                    for c in ("r_a", "r_b"))
            near = estimate(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), (a == b).sum(axis=1),
                            (a > b).sum(axis=1)) >= THRESHOLD_PERCENT / 100 - MARGIN
            yield batch.filter(pa.array(near)).select(["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _texts(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(id, text) of the classes that share a bucket with another one, compressed."""
    keys = members.select("cls").distinct().select(F.xxhash64("cls").alias("key"))
    wanted = rows.sparkSession.sparkContext.broadcast(bloom(keys, "key", keys.count()))

    def press(batches):
        filter_ = wanted.value
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            own = batch.filter(pa.array(filter_.has(batch.column(0).to_numpy().view(np.uint64))))
            if own.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [own.column(1), pa.array([compressor.compress(d.tobytes()) for d in string_views(own.column(2))], pa.binary())],
                    names=["id", "text"])

    return (rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.xxhash64("doc_id").alias("key"), "doc_id", "text")
            .mapInArrow(press, "id long, text binary"))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (u, v): the pairs whose full sets are similar enough.

    The pairs arrive sorted by ``b``, whose set is made once for all its partners.
    """
    joined = pairs.join(texts.toDF("a", "t_a"), "a").join(texts.toDF("b", "t_b"), "b").select("a", "b", "t_a", "t_b")

    def verify(batches):
        unpack = zstandard.ZstdDecompressor()
        last, own = None, None

        def of(packed):
            return shingle_hashes(np.frombuffer(unpack.decompress(packed), dtype=np.uint8))

        for batch in slices(batches, 2 << 20):
            keep = []
            for b, t_a, t_b in zip(*(batch.column(c).to_pylist() for c in ("b", "t_a", "t_b"))):
                if b != last:
                    last, own = b, of(t_b)
                keep.append(linked(of(t_a), own))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return joined.mapInArrow(verify, "a long, b long").toDF("u", "v")


def _blocks(batches, columns: list[str]):
    """Runs of rows with equal (bucket, i, j), as tables; rows arrive sorted by them."""
    held: pa.Table | None = None
    for batch in slices(batches, 4 << 20):
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], axis=1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        for at, end in zip(starts[:-1], starts[1:]):
            yield table.slice(at, end - at).select(columns)
        held = table.slice(starts[-1])
    if held is not None:
        yield held.select(columns)


def _likely_partners(bucket: int, side, component, n, registers):
    """(k, its likely partners across components, likeliest first) for the compared rows of a block.

    A pair that shares several bands is taken up in the first of them only.
    """
    band = int(np.flatnonzero(band_hashes(registers[0]).view(np.int64) == bucket)[0])
    against = np.flatnonzero(side != 0)
    for k in np.flatnonzero(side != 1):
        others = against[(component[against] != component[k]) & ((side[against] == 1) | (against > k))]
        if not len(others):
            continue
        same = registers[others] == registers[k]
        near = same.sum(axis=1) >= REGISTERS * (THRESHOLD_PERCENT / 100 - MARGIN - 0.05)
        others, same = others[near], same[near]
        first = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        others, same = others[first], same[first]
        if not len(others):
            continue
        value = estimate(n[k], n[others], same.sum(axis=1), (registers[k] > registers[others]).sum(axis=1))
        near = value >= THRESHOLD_PERCENT / 100 - MARGIN
        if near.any():
            yield k, others[near][np.argsort(-value[near], kind="stable")]


_NARROW = ["bucket", "i", "j", "side", "cls", "component", "n", "registers"]


def _dealt(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def _with_partners(rows: DataFrame) -> DataFrame:
    """The rows of blocks that are in some likely pair."""

    def run(batches):
        for block in _blocks(batches, _NARROW):
            side, component, n = (block.column(c).to_numpy() for c in ("side", "component", "n"))
            registers = np.frombuffer(b"".join(block.column("registers").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            keep = np.zeros(len(side), dtype=bool)
            for k, others in _likely_partners(block.column("bucket")[0].as_py(), side, component, n, registers):
                keep[k] = True
                keep[others] = True
            if keep.any():
                yield from block.filter(pa.array(keep)).to_batches()

    return _dealt(rows).mapInArrow(run, rows.select(_NARROW).schema)


def _cross_links(rows: DataFrame) -> DataFrame:
    """Edges (u, v) between components: exact tests of the likely pairs in each block.

    A block tests a pair only if it has not linked their components yet, so it
    emits fewer edges than it has components.
    """

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for block in _blocks(batches, [*_NARROW, "text"]):
            side, cls, component, n = (block.column(c).to_numpy() for c in ("side", "cls", "component", "n"))
            registers = np.frombuffer(b"".join(block.column("registers").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            texts, sets, linked_to = block.column("text"), {}, {}

            def of(i):
                if i not in sets:
                    sets[i] = shingle_hashes(np.frombuffer(unpack.decompress(texts[i].as_py()), dtype=np.uint8))
                return sets[i]

            def root(c):
                while c in linked_to:
                    c = linked_to[c]
                return c

            out = []
            for k, others in _likely_partners(block.column("bucket")[0].as_py(), side, component, n, registers):
                for o in others.tolist():
                    a, b = root(int(component[k])), root(int(component[o]))
                    if a != b and linked(of(k), of(o)):
                        linked_to[a] = b
                        out.append((cls[k], cls[o]))
            if out:
                u, v = np.array(out, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(u.copy()), pa.array(v.copy())], names=["u", "v"])

    return _dealt(rows).mapInArrow(run, "u long, v long")


def _mixed_blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (bucket, cls, n) of the buckets that hold several components, dealt out in blocks.

    In a bucket the largest component needs no pairs of its own: its members are
    side 1, compared with the others only.  The others are split into ``i``
    chunks and meet every chunk ``j`` of either kind; side 0 or 2 marks a member
    that is compared, side 1 or 2 one that it is compared with.  A chunk holds
    about ``BLOCK`` classes and ``BLOCK_SHINGLES`` shingles at most.
    """
    named = members.join(labels.toDF("cls", "component"), "cls", "left") \
                   .withColumn("component", F.coalesce("component", "cls"))
    per = named.groupBy("bucket", "component").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    largest = F.max(F.struct("c", "component", "w"))
    mixed = per.groupBy("bucket").agg(largest.alias("major"), F.sum("c").alias("c_all"), F.sum("w").alias("w_all"),
                                      F.count("*").alias("k")).filter("k > 1")

    def chunks(count, weight):
        return F.ceil(F.greatest(count / F.lit(BLOCK), weight / F.lit(BLOCK_SHINGLES))).cast("int")

    mixed = mixed.select("bucket", F.col("major.component").alias("major"),
                         chunks(F.col("major.c"), F.col("major.w")).alias("majors"),
                         chunks(F.col("c_all") - F.col("major.c"), F.col("w_all") - F.col("major.w")).alias("minors"))
    placed = named.join(mixed, "bucket").withColumn("is_major", F.col("component") == F.col("major"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("cls"), F.when(F.col("is_major"), F.col("majors"))
                                             .otherwise(F.col("minors"))).cast("int"))
    every = F.sequence(F.lit(0), F.col("minors") - 1)
    # (i, j, side) of every block a member belongs to; j counts minor chunks, then major ones
    as_major = F.transform(every, lambda i: F.struct(i.alias("i"), (F.col("minors") + F.col("own")).alias("j"), F.lit(1).alias("side")))
    with_major = F.transform(F.sequence(F.lit(0), F.col("majors") - 1), lambda j: F.struct(
        F.col("own").alias("i"), (F.col("minors") + j).alias("j"), F.lit(0).alias("side")))
    with_minor = F.transform(every, lambda j: F.struct(
        F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j"),
        F.when(F.col("own") == j, 2).when(F.col("own") < j, 0).otherwise(1).alias("side")))
    blocks = F.when(F.col("is_major"), as_major).otherwise(F.concat(with_major, with_minor))
    return placed.select("bucket", "cls", "component", "n", F.explode(blocks).alias("at")).select(
        "bucket", "at.*", "cls", "component", "n")


def _linked(rows: DataFrame) -> DataFrame:
    """(doc_id, n, component) of (doc_id, text) with ids that no two rows share: the smallest id linked with each."""
    spark = rows.sparkSession
    made, _ = staged(sketches(rows), "near-sketches")
    named = made.filter("doc_id IS NOT NULL AND n > 0")
    leaders, _ = staged(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("cls")), "near-classes")
    # a class is stood for by its smallest id, which one row has
    classes, p_cls = staged(named.join(leaders.withColumnRenamed("cls", "doc_id"), ["d1", "d2", "doc_id"], "left_semi")
                            .select(F.col("doc_id").alias("cls"), "n", "registers"), "near-leaders")

    stars, p_stars = staged(_band_rows(classes).groupBy("bucket").agg(F.min("cls").alias("first"), F.max("cls").alias("last"))
                            .filter("first < last").select("bucket", "first"), "near-stars")
    shared = bloom(stars, "bucket", stars.count())
    members, p_members = staged(_band_rows(classes, shared).join(stars, "bucket")
                                .join(classes.select("cls", "n"), "cls"), "near-members")
    texts, p_texts = staged(_texts(rows, members), "near-texts")
    pairs, p_pairs = staged(_likely(members.filter("cls > first").select(F.col("cls").alias("a"), F.col("first").alias("b"))
                                    .distinct(), classes), "near-pairs")
    edges, p_edges = staged(_confirmed(pairs, texts), "near-edges")
    labels, p_labels = components(edges)
    paths = [p_cls, p_stars, p_members, p_texts, p_pairs, p_edges]

    mixed, p_mixed = staged(_mixed_blocks(members.select("bucket", "cls", "n"), labels), "near-mixed")
    near = _with_partners(mixed.join(classes.select("cls", "registers"), "cls").select(_NARROW))
    more, p_more = staged(_cross_links(near.join(texts.toDF("cls", "text"), "cls").select(*_NARROW, "text")), "near-links")
    paths += [p_mixed, p_more]
    if not more.isEmpty():
        paths.append(p_labels)
        labels, p_labels = components(edges.unionByName(more))
    release(spark, *paths)

    of_class = leaders.join(labels.toDF("cls", "component"), "cls", "left").select(
        "d1", "d2", F.coalesce("component", "cls").alias("component"))
    joined = made.select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    return joined.select("doc_id", "n", F.coalesce("component", "doc_id").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    found, _ = _near(docs, id_col, text_col)
    return found.drop(OWN_ID)


def _near(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``near_duplicates`` with each row's own id, and ``docs`` with it."""
    rows, odd = with_own_ids(docs, id_col)
    linked = _linked(rename_free(rows, doc_id=OWN_ID, text=text_col))
    kept = (F.col("doc_id") == F.col("component")).alias("kept")
    if not odd:
        return linked.select(F.col("doc_id").alias(OWN_ID), "doc_id", F.col("n").alias("n_shingles"),
                             F.col("component").alias("component_id"), kept), rows
    linked, _ = staged(linked, "near-linked")
    names = rows.select(F.col(OWN_ID).alias("doc_id"), rows[id_col].cast("long").alias("name"))
    named = linked.join(names, "doc_id")
    least = named.groupBy("component").agg(F.min("name").alias("component_id"))
    return named.join(least, "component").select(F.col("doc_id").alias(OWN_ID), F.col("name").alias("doc_id"),
                                                 F.col("n").alias("n_shingles"), "component_id", kept), rows


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of linked or equal rows."""
    found, rows = _near(docs, id_col, text_col)
    return without(rows, found.filter("NOT kept").select(OWN_ID), OWN_ID).drop(OWN_ID)
