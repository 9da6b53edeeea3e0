"""Exact substring deduplication by difference-cover anchors (operator 3).

A window is ``WINDOW`` consecutive words.  A word goes if a window over it also
starts in a document with a smaller id.  Hashing and shuffling every window
would move many times the input, so windows are only looked at where a repeat
is possible:

1. *Whole texts.*  Texts of equal words are found by digest; all but the first
   go whole and take no further part (their windows all start in the first).
2. *Anchors.*  Positions whose residue modulo ``PERIOD`` is in the perfect
   difference set ``COVER`` carry an anchor, the hash of ``ANCHOR`` words.  For any
   two positions some shift below ``PERIOD`` brings both onto the cover, so two
   equal windows share an anchor within them.  Anchors that occur in two
   documents are kept in a fixed-size Bloom filter.
3. *Extension.*  Around every shared anchor the windows that contain it are
   hashed whole (128 bits) and aggregated to their first document.
4. Windows whose first document is smaller are joined back, and documents that
   have any are joined with their marks.

Aggregations combine on the map side and joins that may meet a hot key keep the
aggregated side unique, so AQE can split the other.  Filters only skip work:
a wrong hit adds a window that the exact steps discard.

Defined cases: a null text has no words; a text of any length is read whole.  For
``deduplicate``, whose rows are known by their id alone, a null id neither loses
words nor counts as a smaller document, and rows that repeat an id are taken as
repeats of one text (each is cut alike, and windows that only they share don't
count); ``remove_repeats`` tells rows apart and cuts each for itself.  An empty
table gives no rows; columns beyond id and text are not read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import OWN_ID, Bloom, bloom, numbered, rename_free, slices, split, staged, string_views, with_own_ids
from revisor.llm.hashing import SAME, mix, windows, word_hashes
from revisor.session import release

WINDOW = 50
#: A perfect difference set modulo 31.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
_COVER = np.array(COVER)


def hashes_of(data: np.ndarray) -> np.ndarray:
    """Word hashes of the text as it stands (no folding)."""
    return word_hashes(data, SAME)


def digest_of(words: np.ndarray) -> bytes:
    """128-bit digest of the word sequence."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a text."""
    n = max(0, len(words) - ANCHOR + 1)
    at = (np.arange(0, n, PERIOD)[:, None] + _COVER).reshape(-1)
    at = at[:np.searchsorted(at, n)]
    return at, windows(words, ANCHOR, seed=3, at=at)


def candidates(words: np.ndarray, shared: Bloom) -> np.ndarray:
    """Start positions of the windows that contain a shared anchor."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    at, hashes = anchors(words)
    at = at[shared.has(hashes)]
    if not len(at):
        return at
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, np.minimum(np.maximum(at - (WINDOW - ANCHOR), 0), n), 1)
    np.add.at(step, np.minimum(at + 1, n), -1)
    return np.flatnonzero(np.cumsum(step[:n]) > 0)


def first_hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the windows that start at ``at``."""
    return windows(words, WINDOW, seed=5, at=at)


def second_hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Another one, independent of the first."""
    return windows(mix(words ^ np.uint64(0xA5A5A5A55A5A5A5A)), WINDOW, seed=11, at=at)


def _digests(rows: DataFrame) -> DataFrame:
    """(doc_id, d1, d2) of every document with a whole window and an id."""

    def run(batches):
        for batch in slices(batches):
            ids, found = [], []
            for doc, data in zip(batch.column(0).to_pylist(), string_views(batch.column(1))):
                if data is None or doc is None or len(data) < 2 * WINDOW - 1:
                    continue
                words = hashes_of(data)
                if len(words) >= WINDOW:
                    ids.append(doc)
                    found.append(digest_of(words))
            if ids:
                halves = np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                    names=["doc_id", "d1", "d2"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, d1 long, d2 long")


def _taking_part(batch: pa.RecordBatch, whole: Bloom | None):
    """(id, word hashes) of a batch's texts: raw ones that surely have no copy, or staged leaders (packed)."""
    if whole is None:
        unpack = zstandard.ZstdDecompressor()
        for doc, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield doc, hashes_of(np.frombuffer(unpack.decompress(packed), dtype=np.uint8))
        return
    for doc, data in zip(batch.column(0).to_pylist(), string_views(batch.column(1))):
        if data is None or doc is None or len(data) < 2 * WINDOW - 1:
            continue
        words = hashes_of(data)
        if len(words) >= WINDOW and not whole.has(np.frombuffer(digest_of(words), dtype=np.uint64)[:1])[0]:
            yield doc, words


def _perhaps_copied(rows: DataFrame, whole: Bloom) -> DataFrame:
    """Texts whose digest passes the filter: (doc_id, d1, d2, text), compressed for the network."""
    shared = rows.sparkSession.sparkContext.broadcast(whole)

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, 2 << 20):
            ids, texts, halves = [], [], []
            for doc, data in zip(batch.column(0).to_pylist(), string_views(batch.column(1))):
                if data is None or doc is None or len(data) < 2 * WINDOW - 1:
                    continue
                words = hashes_of(data)
                if len(words) < WINDOW:
                    continue
                digest = np.frombuffer(digest_of(words), dtype=np.int64)
                if shared.value.has(digest[:1].view(np.uint64))[0]:
                    ids.append(doc)
                    texts.append(press.compress(data.tobytes()))
                    halves.append(digest)
            if ids:
                both = np.stack(halves)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                     pa.array(texts, pa.binary())], names=["doc_id", "d1", "d2", "text"])

    return rows.mapInArrow(run, "doc_id long, d1 long, d2 long, text binary")


def _over_texts(raw: DataFrame, leaders: DataFrame, whole: Bloom, of_text, names: list[str], schema: str,
                filters=None) -> DataFrame:
    """Rows that ``of_text(doc, word hashes, filters)`` makes (a list of numpy columns) of every text that takes part."""
    sc = raw.sparkSession.sparkContext
    shared = sc.broadcast((whole, filters))

    def over(packed: bool):
        def run(batches):
            whole, filters = shared.value
            for batch in slices(batches, 1 << 20 if packed else 2 << 20):
                made = [of_text(doc, words, filters) for doc, words in _taking_part(batch, None if packed else whole)]
                made = [m for m in made if m is not None]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*made)], names=names)

        return run

    return raw.mapInArrow(over(False), schema).unionByName(leaders.mapInArrow(over(True), schema))


def _anchors_of(doc, words, _):
    hashes = np.unique(anchors(words)[1]).view(np.int64)
    return hashes, np.full(len(hashes), doc, dtype=np.int64)


def _windows_of(doc, words, shared):
    """Hashes of the candidate windows, each once."""
    at = candidates(words, shared)
    if not len(at):
        return None
    h1, once = np.unique(first_hashes(words, at), return_index=True)
    return h1.view(np.int64), second_hashes(words, at[once]).view(np.int64), np.full(len(once), doc, dtype=np.int64)


def _placed_windows_of(doc, words, filters):
    """Hashes and positions of the candidate windows that pass the filter of repeated ones."""
    shared, repeated = filters
    at = candidates(words, shared)
    if not len(at):
        return None
    h1 = first_hashes(words, at)
    keep = repeated.has(h1)
    if not keep.any():
        return None
    h1, at = h1[keep], at[keep]
    return h1.view(np.int64), second_hashes(words, at).view(np.int64), np.full(len(at), doc, dtype=np.int64), at.astype(np.int32)


def removal_marks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, whole, starts, key): windows that go by their start, or ``whole`` for a whole text; staged."""
    spark = docs.sparkSession
    rows = rename_free(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    digests, p_digests = staged(_digests(rows), "sub-digests")
    first, p_first = staged(digests.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")),
                            "sub-first")
    copied = first.filter("first < last")
    whole = bloom(copied, "d1", copied.count())
    # all but the first of equal texts go whole
    copies, p_copies = staged(digests.join(copied, ["d1", "d2"]).filter(F.col("doc_id") > F.col("first"))
                              .select("doc_id").distinct(), "sub-copies")
    # a text takes part if it is the first of its digest; digest and id together meet one row: no hot key
    leaders, p_leaders = staged(
        _perhaps_copied(rows, whole).join(first.select("d1", "d2", F.col("first").alias("doc_id")), ["d1", "d2", "doc_id"],
                                          "left_semi").select("doc_id", "text"), "sub-leaders")

    shared_anchors, p_anchors = staged(
        _over_texts(rows, leaders, whole, _anchors_of, ["h", "doc_id"], "h long, doc_id long")
        .groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("h"), "sub-anchors")
    shared = bloom(shared_anchors, "h", shared_anchors.count())
    firsts, p_windows = staged(
        _over_texts(rows, leaders, whole, _windows_of, ["h1", "h2", "doc_id"], "h1 long, h2 long, doc_id long", shared)
        .groupBy("h1", "h2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .filter("a < b").select("h1", "h2", F.col("a").alias("first")), "sub-windows")
    repeated = bloom(firsts, "h1", firsts.count())
    placed = _over_texts(rows, leaders, whole, _placed_windows_of, ["h1", "h2", "doc_id", "at"],
                         "h1 long, h2 long, doc_id long, at int", (shared, repeated))
    marks = (placed.join(firsts, ["h1", "h2"]).filter(F.col("doc_id") > F.col("first"))
             .groupBy("doc_id").agg(F.sort_array(F.collect_set("at")).alias("starts")))
    none = F.lit(None).cast("array<int>").alias("starts")
    out, _ = staged(
        marks.select("doc_id", F.lit(False).alias("whole"), "starts")
        .unionByName(copies.select("doc_id", F.lit(True).alias("whole"), none))
        .groupBy("doc_id").agg(F.max("whole").alias("whole"), F.first("starts", ignorenulls=True).alias("starts"))
        .withColumn("key", F.xxhash64("doc_id")), "sub-marks")
    release(spark, p_digests, p_first, p_copies, p_leaders, p_anchors, p_windows)
    return out


def cover_words(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    step = np.zeros(n + 1, dtype=np.int64)
    starts = starts[starts < n]
    step[starts] += 1
    step[np.minimum(starts + WINDOW, n)] -= 1
    return np.cumsum(step[:n]) > 0


def _cut(text: bytes, whole: bool | None, starts) -> tuple[int, int, bytes]:
    """Words, removed words, and the kept words joined by one space."""
    words = text.split()
    if whole is None:
        return len(words), 0, b" ".join(words)
    if whole:
        return len(words), len(words), b""
    gone = cover_words(len(words), np.asarray(starts))
    return len(words), int(gone.sum()), b" ".join(compress(words, ~gone))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_only: bool = False) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256`` and, unless ``digest_only``, ``kept_text``."""
    rows = rename_free(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    marks = removal_marks(docs, id_col, text_col)
    marked = bloom(marks, "key", marks.count())
    out_types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    out_names = ["n_words", "n_removed", "kept_sha256", "kept_text"]
    if digest_only:
        out_types, out_names = out_types[:3], out_names[:3]

    def result(ids, id_type, found):
        values = [(n, gone, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))[:len(out_names)]
                  for n, gone, kept in found]
        columns = list(zip(*values)) if values else [()] * len(out_names)
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type)] + [pa.array(c, t) for c, t in zip(columns, out_types)],
                                          names=["doc_id"] + out_names)

    shared = docs.sparkSession.sparkContext.broadcast(marked)
    keyed = rows.select("doc_id", F.xxhash64("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))

    def marked_rows(batch):
        return shared.value.has(batch.column(1).to_numpy().view(np.uint64)) & batch.column(0).is_valid().to_numpy(
            zero_copy_only=False)

    def untouched(batches):
        for batch in slices(batches, 2 << 20):
            own = batch.filter(pa.array(~marked_rows(batch)))
            if own.num_rows:
                yield result(own.column(0).to_pylist(), own.column(0).type,
                             [_cut(d.tobytes(), None, None) for d in string_views(own.column(2))])

    def touched(batches):
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, 2 << 20):
            own = batch.filter(pa.array(marked_rows(batch)))
            if own.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array([compressor.compress(d.tobytes()) for d in string_views(own.column(2))], pa.binary())],
                    names=["doc_id", "text"])

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in slices(batches, 2 << 20):
            found = [_cut(unpack.decompress(text), whole, starts)
                     for text, whole, starts in zip(batch.column("text").to_pylist(), batch.column("whole").to_pylist(),
                                                    batch.column("starts"))
                     for starts in [starts.values.to_numpy() if starts.is_valid else None]]
            yield result(batch.column("doc_id").to_pylist(), batch.column("doc_id").type, found)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * (not digest_only)
    hit = keyed.mapInArrow(touched, "doc_id long, text binary").join(marks.drop("key"), "doc_id", "left")
    return keyed.mapInArrow(untouched, schema).unionByName(
        hit.select("doc_id", "text", "whole", "starts").mapInArrow(cut, schema))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length_col: str | None = "n_chars") -> DataFrame:
    """The documents with all their columns and repeated passages cut from the text.

    A text that loses nothing stays as it is; another one becomes its kept words
    joined by one space, and ``length_col`` (if there is one) its new length in
    code points.  A document that loses every word goes.  Rows that repeat an id,
    or have none, come after all others and are cut each for itself.
    """
    docs, _ = with_own_ids(docs, id_col)
    marks = removal_marks(docs, OWN_ID, text_col)
    marked = bloom(marks, "key", marks.count())
    names = docs.columns
    own, text_at = f"c{names.index(OWN_ID)}", names.index(text_col)
    length_at = names.index(length_col) if length_col in names else -1
    touched = numbered(split(docs, OWN_ID, marked, True))
    found = touched.join(marks.select(F.col("doc_id").alias("__id"), F.col("whole").alias("__whole"), "starts"),
                         F.col(own) == F.col("__id"), "left").filter("NOT coalesce(__whole, false)")
    fields = touched.columns

    def run(batches):
        for batch in slices(batches):
            columns = list(batch.columns[:len(fields)])
            starts = batch.column(len(fields))
            changed = starts.is_valid().to_numpy(zero_copy_only=False)
            new = [t.as_py() if not c else _cut(t.as_buffer().to_pybytes(), False, s.values.to_numpy())[2].decode("utf-8", "replace")
                   for t, s, c in zip(columns[text_at], starts, changed)]
            columns[text_at] = pa.array(new, columns[text_at].type)
            if length_at >= 0:
                columns[length_at] = pa.array([len(t) if c else n for t, c, n in
                                               zip(new, changed, columns[length_at].to_pylist())], columns[length_at].type)
            keep = np.array([not c or bool(t) for t, c in zip(new, changed)])
            yield pa.RecordBatch.from_arrays(columns, names=fields).filter(pa.array(keep))

    cut = found.select(*fields, "starts").mapInArrow(run, touched.schema).toDF(*names)
    return split(docs, OWN_ID, marked, False).union(cut).drop(OWN_ID)
