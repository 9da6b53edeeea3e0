"""Document fingerprints by one-permutation MinHash (operator 1).

Each shingle is hashed once; the top bits of the hash choose one of ``BINS``
bins and a bin keeps its smallest remaining bits.  Empty bins are filled by
optimal densification: bin ``j`` probes the bins ``probe(j, 1), probe(j, 2), ...``
of a universal hash until it meets one that was filled by the document itself.
The ``BITS`` low-order bits of each bin are packed into the fingerprint.  Two
bins of unlike values still agree in ``BITS`` bits with probability ``2**-BITS``,
which ``likeness`` takes out of the share of equal bins.

Every document is paired with the next one by id without a global sort of
texts: the distinct keys (id and text hashes) are sorted in ranges, the first key
of each range cuts a bucket, texts are dealt to buckets, and the first document of
each bucket is also sent to the bucket before it.  Each bucket is read in order
as a stream.  Texts cross the network once, compressed.  Equal rows are one key:
they are counted, one of them is dealt out, and the others, whose successor is
equal to them, get their rows from one copy of the text.

Defined cases: a null text is empty; an empty text (or one of white space only)
has the empty fingerprint, which is like itself (1) and like nothing else (0);
documents are ordered by id, then by text hash, null ids last; rows that share
an id, or have none, are cut into buckets by their text hash, so they need no
task of their own; a repeated row follows its copy; a single document is its
own successor; a text of any length is read whole, by one task at a time; an
empty table gives no rows; columns beyond id and text are not read.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import bloom, rename_free, slices, staged
from revisor.llm.hashing import mix, shingles, word_hashes

BINS = 512  # a power of two
BITS = 4
SHINGLE_WORDS = 5
BUCKETS_PER_PARTITION = 16  # buckets are dealt to partitions by hash: many small ones come out even
_PROBES = 256  # rows of the probe table kept at once

_cache: dict[int, np.ndarray] = {}


def _probe_rows(at: int, bins: int) -> np.ndarray:
    """Rows ``at * _PROBES ...`` of the probe table: attempt by bin."""
    if at not in _cache or _cache[at].shape[1] != bins:
        attempt = np.arange(at * _PROBES, (at + 1) * _PROBES, dtype=np.uint64)[:, None]
        table = mix(attempt * np.uint64(0xD1342543DE82EF95) + mix(np.arange(1, bins + 1, dtype=np.uint64))[None, :])
        table = (table >> np.uint64(64 - (bins.bit_length() - 1))).astype(np.int32)
        if at >= 32:  # only a text of two or three shingles gets this far
            return table
        _cache[at] = table
    return _cache[at]


def fingerprint(hashes: np.ndarray, bins: int = BINS, bits: int = BITS) -> np.ndarray | None:
    """Low-order bits of the densified bins of distinct shingle hashes; None for no shingle."""
    if not len(hashes):
        return None
    hashes = np.sort(mix(hashes))
    rest = np.uint64(64 - (bins.bit_length() - 1))
    own_bin = (hashes >> rest).astype(np.int64)
    first = np.flatnonzero(np.r_[True, own_bin[1:] != own_bin[:-1]])
    values = np.zeros(bins, dtype=np.uint64)
    filled = np.zeros(bins, dtype=bool)
    filled[own_bin[first]] = True
    values[own_bin[first]] = hashes[first]
    empty = np.flatnonzero(~filled)
    if len(first) == 1:
        values[empty], empty = values[own_bin[0]], empty[:0]
    at = 0
    while len(empty):
        probes = _probe_rows(at, bins)[:, empty]
        met = filled[probes]
        hit = met.argmax(axis=0)
        found = met[hit, np.arange(len(empty))]
        values[empty[found]] = values[probes[hit, np.arange(len(empty))][found]]
        empty = empty[~found]
        at += 1
    # low-order bits of (value, bin): a short text repeats a value in many bins, and a chance
    # agreement of its bits must not repeat with it
    low = mix(values ^ (np.arange(bins, dtype=np.uint64) << np.uint64(32))) & np.uint64((1 << bits) - 1)
    return low.astype(np.uint8)


def pack_bits(values: np.ndarray | None, bits: int = BITS) -> str:
    """Hexadecimal form of the packed bins; the empty string for an empty text."""
    if values is None:
        return ""
    spread = (values[:, None] >> np.arange(bits, dtype=np.uint8)) & 1
    return np.packbits(spread.astype(np.uint8)).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None, bits: int = BITS) -> float:
    """Jaccard similarity as the share of equal bins, less the chance agreement of ``bits`` bits."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 2.0 ** -bits
    return float(min(1.0, max(0.0, (np.count_nonzero(a == b) / len(a) - chance) / (1 - chance))))


def text_fingerprint(data: bytes) -> np.ndarray | None:
    return fingerprint(shingles(word_hashes(np.frombuffer(data, dtype=np.uint8)), SHINGLE_WORDS))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) first ones of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


KEY = ["nameless", "doc_id", "t1", "t2"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``nameless, doc_id, t1, t2, text``: documents in order of the first four; rows that agree in them are equal."""
    rows = rename_free(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("t1"),
                       F.xxhash64(F.lit(1), "text").alias("t2"), "text")


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    """The key of each row, comparable: a missing id is 0, behind ``nameless``."""
    return list(zip(batch.column(0).to_pylist(), batch.column(1).fill_null(0).to_pylist(),
                    batch.column(2).to_pylist(), batch.column(3).to_pylist()))


def with_successor(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """One row a key of ``rows`` and guests, dealt out by bucket and sorted within it.

    Columns ``bucket, guest``, the key and ``text`` (zstd); in a bucket, each row's
    successor is the next row of another key, and the guest at the end is the
    first document of the next bucket.  Rows of one key are equal: a task sends one
    of them, so a bucket has one a task at most.  ``keys`` holds the keys of ``rows``.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stride = max(1, keys.count() // (parts * BUCKETS_PER_PARTITION))

    def cut(batches):
        seen = 0
        for batch in batches:
            yield batch.take(pa.array(range(-seen % stride, batch.num_rows, stride), pa.int64()))
            seen += batch.num_rows

    # the first key of each bucket reaches the driver: a range's first, and every stride-th after it
    ranged = keys.select(*KEY).repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY)
    firsts = sorted(key for batch in ranged.mapInArrow(cut, ranged.schema).toArrow().to_batches() for key in _keys(batch))
    shared = spark.sparkContext.broadcast(firsts)

    def deal(batches):
        firsts, press, sent = shared.value, zstandard.ZstdCompressor(level=1), set()
        for batch in slices(batches):
            bucket, guest, take = [], [], []
            for i, key in enumerate(_keys(batch)):
                if key in sent:
                    continue
                sent.add(key)
                own = bisect.bisect_right(firsts, key) - 1
                bucket.append(own)
                guest.append(False)
                take.append(i)
                if firsts[own] == key:
                    bucket.append((own or len(firsts)) - 1)
                    guest.append(True)
                    take.append(i)
            texts = {i: press.compress(batch.column(4)[i].as_buffer().to_pybytes()) for i in set(take)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(guest, pa.bool_()), *[c.take(pa.array(take, pa.int64())) for c in batch.columns[:4]],
                 pa.array([texts[i] for i in take], pa.binary())], names=["bucket", "guest", *batch.schema.names[:4], "text"])

    kind = dict(rows.dtypes)["doc_id"]
    dealt = rows.select(*KEY, "text").mapInArrow(
        deal, f"bucket long, guest boolean, nameless boolean, doc_id {kind}, t1 long, t2 long, text binary")
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", *KEY)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text, without the pairing: id, ``fingerprint``."""
    rows = rename_free(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))

    def run(batches):
        for batch in slices(batches):
            found = [pack_bits(text_fingerprint(x.as_buffer().to_pybytes())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


OUTPUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(text: str, own: np.ndarray | None, after: str, following: np.ndarray | None) -> tuple:
    """The output columns but the id of a text and its successor, given both fingerprints."""
    new = edited(text, after)
    raw = new.encode("utf-8")
    new_print = own if new == text else text_fingerprint(raw)
    return (len(text), hashlib.sha256(raw).hexdigest(), pack_bits(own), pack_bits(new_print),
            likeness(own, new_print), likeness(own, following))


def _repeated(rows: DataFrame, repeats: DataFrame, kind: str) -> DataFrame:
    """The output rows of all but the last of equal rows: each is followed by a row equal to it.

    Only rows that a filter of the repeated keys lets pass are looked at; a task
    emits one row a key, which is then copied as often as ``repeats`` says.
    """
    hashed = F.xxhash64(*KEY)
    shared = rows.sparkSession.sparkContext.broadcast(bloom(repeats.select(hashed.alias("key")), "key", repeats.count()))

    def run(batches):
        filter_, sent = shared.value, set()
        for batch in slices(batches):
            keys, take, out = _keys(batch), [], []
            for i in np.flatnonzero(filter_.has(batch.column(5).to_numpy().view(np.uint64))).tolist():
                if keys[i] not in sent:
                    sent.add(keys[i])
                    take.append(i)
                    text = batch.column(4)[i].as_py()
                    own = text_fingerprint(text.encode("utf-8"))
                    out.append(_compared(text, own, text, own))
            if out:
                own = [c.take(pa.array(take, pa.int64())) for c in batch.columns[:4]]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(c, t) for c, t in zip(zip(*out), _TYPES)]], names=[*KEY, *OUTPUT[1:]])

    found = rows.select(*KEY, "text", hashed.alias("key")).mapInArrow(
        run, f"nameless boolean, doc_id {kind}, t1 long, t2 long, {_SCHEMA}").dropDuplicates(KEY)
    same = [found[c].eqNullSafe(repeats[c]) for c in KEY]
    copied = found.join(repeats, same).select(*[found[c] for c in OUTPUT], F.explode(F.sequence(F.lit(2), "copies")).alias("copy"))
    return copied.drop("copy")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness; one row per document."""
    rows = _keyed(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]
    keys, _ = staged(rows.groupBy(*KEY).agg(F.count("*").alias("copies")), "fingerprint-keys")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        held = None  # the document that waits for its successor: key, id, text, fingerprint
        for batch in slices(batches, 2 << 20):
            out, ids = [], []
            doc_ids, keys = batch.column("doc_id"), _keys(batch.select(KEY))
            for i, (bucket, guest) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("guest").to_pylist())):
                key = (bucket, guest, keys[i])
                if (held is None and guest) or (held is not None and held[0] == key):
                    continue  # a copy that another task sent
                data = unpack.decompress(batch.column("text")[i].as_buffer())
                text, own = data.decode("utf-8", "replace"), text_fingerprint(data)
                if held is not None:
                    _, held_id, held_text, held_print = held
                    ids.append(held_id)
                    out.append(_compared(held_text, held_print, text, own))
                held = None if guest else (key, doc_ids[i].as_py(), text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(ids, doc_ids.type), *[pa.array(c, t) for c, t in zip(zip(*out), _TYPES)]],
                                                 names=OUTPUT)

    found = with_successor(rows, keys).mapInArrow(run, f"doc_id {kind}, {_SCHEMA}")
    repeats = keys.filter("copies > 1")
    return found if repeats.isEmpty() else found.unionByName(_repeated(rows, repeats, kind))
