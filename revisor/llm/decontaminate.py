"""Benchmark decontamination by CGK embeddings (operator 4).

A document is contaminated by an item if some run of its words is within edit
distance ``ALLOWED`` times the item's word count of the item (words folded A-Z).

1. *Pieces.*  The share of steps on which two walks (3) agree falls with their
   length, so an item is embedded in pieces of ``PIECE_WORDS`` words or up to
   twice as many.  If the item is within its allowed edits of a run, some piece
   is within its own share of them, so one piece that is found finds the item.
2. *Windows.*  A piece with ``k`` allowed edits has ``k + 1`` stretches of which
   one stays whole, so a contaminated text holds a run of ``m`` of the piece's
   words in a row (``SEED_WORDS`` for the allowed share used here).  Where such a
   run stands, the piece-sized window that would align with it is taken; all
   other windows are beyond the allowed distance.
3. *Embedding.*  The CGK random walk copies the current word at each step and
   moves on or not by a random bit of (step, word), so that windows at a small
   edit distance become strings at a small Hamming distance.
4. *LSH.*  Each of ``REPETITIONS`` walks is sampled at ``SAMPLES`` steps; windows
   and pieces whose samples agree in one repetition are candidates.
5. *Verification.*  Candidates are aligned exactly (edit distance of the whole
   item to any run of words around the place the window gives it).

The item index is built on the driver from the benchmark table, whose size is
checked (``MAX_ITEM_WORDS`` words a part); a larger table is searched part by
part in further passes over the documents.  Everything else runs in one map-only
pass: no text is shuffled.

Defined cases: null or empty texts and items match nothing; an item is matched
once per document, at its best place (the first of equals); repeated documents
and items are matched alike, a null id like any other; a text of any length is
read whole; empty tables give no rows; items shorter than
``MIN_ITEM_WORDS`` words are compared as they are, allowing no edit; columns
beyond the ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import OWN_ID, rename_free, slices, string_views, with_own_ids, without
from revisor.llm.hashing import mix, windows, word_hashes

ALLOWED = 0.2
SEED_WORDS = 3
MIN_ITEM_WORDS = 8
PIECE_WORDS = 30
REPETITIONS = 32
SAMPLES = 2
MAX_ITEM_WORDS = 4_000_000
WINDOWS_AT_ONCE = 4096
_PAD = np.uint64(0x5BD1E9955BD1E995)


def allowed_edits(words: int) -> int:
    return int(ALLOWED * words) if words >= MIN_ITEM_WORDS else 0


def seed_size(words: int) -> int:
    """Words in a row that survive any allowed number of edits."""
    k = allowed_edits(words)
    return max(1, min(SEED_WORDS, (words - k) // (k + 1)))


def piece_bounds(words: int) -> list[int]:
    """Where an item is cut, both ends included: even pieces, one for an item of under twice ``PIECE_WORDS``."""
    n = max(1, words // PIECE_WORDS)
    return [k * words // n for k in range(n + 1)]


_rng = np.random.default_rng(4)
#: Sampled steps as shares of a walk; a walk over n words is nearly always through after 2 * n steps.
_SHARES = np.sort(_rng.random((REPETITIONS, SAMPLES)), axis=1)
_WALK_SALT = _rng.integers(0, 1 << 63, REPETITIONS, dtype=np.uint64)


def walk_keys(runs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """LSH keys (runs by repetition) of word runs, one row each, padded beyond their size.

    All runs walk at once, in every repetition: step by step each copies its
    word where the step is sampled, and moves on by a random bit of (repetition,
    step, word).  Runs of different sizes never share a key.
    """
    n = len(runs)
    row = np.arange(n)[:, None]
    wanted = (_SHARES[None] * (2 * sizes[:, None, None])).astype(np.int64)  # run, repetition, sample
    key = mix(sizes.astype(np.uint64)[:, None] * np.uint64(REPETITIONS) + np.arange(REPETITIONS, dtype=np.uint64)[None])
    at = np.zeros((n, REPETITIONS), dtype=np.int64)
    end = sizes[:, None]
    for step in range(int(wanted.max(initial=-1)) + 1):
        word = runs[row, at]
        for sample in range(SAMPLES):
            here = wanted[:, :, sample] == step
            if here.any():
                key[here] = mix(key[here] ^ word[here]) + np.uint64(sample + 1)
        salt = mix(_WALK_SALT + np.full(1, step, dtype=np.uint64))
        move = mix(word ^ salt[None]) & np.uint64(1)
        at = np.minimum(at + move.astype(np.int64), end)
    return key


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the run of ``text`` nearest to ``item``; the first and shortest of equals."""
    n = len(text)
    previous = np.zeros(n + 1, dtype=np.int64)
    starts = np.arange(n + 1)
    index = np.arange(n + 1)
    for i, word in enumerate(item, 1):
        cost = np.empty(n + 1, dtype=np.int64)
        origin = np.empty(n + 1, dtype=np.int64)
        cost[0], origin[0] = i, 0
        swap = previous[:-1] + (text != word)
        drop = previous[1:] + 1
        cost[1:] = np.minimum(swap, drop)
        origin[1:] = np.where(swap <= drop, starts[:-1], starts[1:])
        # insertions run along the row: the nearest smaller (cost - column) to the left
        level = cost - index
        best = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == best, index, 0))
        previous, starts = best + index, origin[source]
    end = int(previous.argmin())
    return int(previous[end]), int(starts[end]), end


class ItemIndex:
    """Seeds and LSH keys of the items' pieces, as sorted arrays."""

    def __init__(self, items: list[tuple[object, np.ndarray]]):
        self.items = items
        cuts = [piece_bounds(len(words)) for _, words in items]
        pieces = [words[low:high] for (_, words), own in zip(items, cuts) for low, high in zip(own, own[1:])]
        self.piece_item = np.repeat(np.arange(len(items)), [len(own) - 1 for own in cuts])
        self.piece_at = np.array([low for own in cuts for low in own[:-1]], dtype=np.int64)
        lengths = np.array([len(words) for words in pieces], dtype=np.int64)
        self.longest = int(lengths.max(initial=0))
        runs = np.full((len(pieces), self.longest + 1), _PAD)
        seeds: list[np.ndarray] = []
        aligned: list[np.ndarray] = []
        for k, words in enumerate(pieces):
            runs[k, :len(words)] = words
            size = seed_size(len(words))
            hashes = windows(words, size, seed=7 + size)
            seeds.append(hashes)
            aligned.append(np.stack([np.full(len(hashes), len(words)), np.arange(len(hashes))], axis=1))
        self.seed_sizes = sorted({seed_size(n) for n in lengths.tolist()})
        # (seed, piece length, offset) once each, sorted by seed
        rows = np.concatenate(aligned) if items else np.zeros((0, 2), np.int64)
        hashes = np.concatenate(seeds) if items else np.zeros(0, np.uint64)
        distinct = np.unique(np.rec.fromarrays([hashes, rows[:, 0], rows[:, 1]], names="h,n,o"))
        self.seeds, self.lengths, self.offsets = distinct["h"].copy(), distinct["n"].copy(), distinct["o"].copy()
        self.coarse = np.zeros(1 << 18, dtype=bool)
        self.coarse[(self.seeds >> np.uint64(46)).astype(np.int64)] = True
        keys = walk_keys(runs, lengths) if items else np.zeros((0, REPETITIONS), np.uint64)
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.owner = keys.reshape(-1)[order], np.repeat(np.arange(len(pieces)), REPETITIONS)[order]

    def _aligned(self, text: np.ndarray) -> np.ndarray:
        """(length, start) of the piece-sized windows that align with a seed in the text."""
        found = []
        for size in self.seed_sizes:
            runs = windows(text, size, seed=7 + size)
            at = np.flatnonzero(self.coarse[(runs >> np.uint64(46)).astype(np.int64)])
            low = np.searchsorted(self.seeds, runs[at], side="left")
            n = np.searchsorted(self.seeds, runs[at], side="right") - low
            place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append(np.stack([self.lengths[place], np.repeat(at, n) - self.offsets[place]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def _windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, length and start of the aligned windows, and the first window of equal words for each of them.

        Words that many items share align with windows at many offsets; a text that
        repeats them has many such windows but few that differ.
        """
        aligned = [self._aligned(t) for t in texts]
        which = np.repeat(np.arange(len(texts)), [len(a) for a in aligned])
        flat = np.concatenate(aligned) if aligned else np.zeros((0, 2), np.int64)
        sizes, starts = flat[:, 0], flat[:, 1]
        # a window that reaches over an end of its text stands for itself
        content = mix(np.arange(len(flat), dtype=np.uint64) + np.uint64(1 << 40))
        at = 0
        for text, own in zip(texts, aligned):
            inside = (own[:, 1] >= 0) & (own[:, 1] + own[:, 0] <= len(text))
            for n in np.unique(own[inside, 0]):
                same = np.flatnonzero(inside & (own[:, 0] == n))
                content[at + same] = windows(text, int(n), seed=11)[own[same, 1]]
            at += len(own)
        _, first, like = np.unique(np.rec.fromarrays([content, sizes], names="h,n"), return_index=True, return_inverse=True)
        return which, sizes, starts, first[like.reshape(-1)] if len(flat) else np.zeros(0, np.int64)

    def _candidates(self, texts: list[np.ndarray]):
        """(text, item, start of the item) of windows and pieces that share an LSH key, by text and item."""
        which, all_sizes, all_starts, first = self._windows(texts)
        order = np.argsort(first, kind="stable")  # the windows of equal words, next to each other
        groups = np.searchsorted(first[order], np.arange(len(first) + 1))
        distinct = np.unique(first)
        pairs, vocabulary, possible = set(), {}, {}

        def may_hold(t, k):
            """Every word of an item that the whole text lacks costs an edit."""
            if (t, k) not in possible:
                if t not in vocabulary:
                    vocabulary[t] = np.unique(texts[t])
                words = self.items[k][1]
                at = np.searchsorted(vocabulary[t], words)
                there = vocabulary[t][np.minimum(at, len(vocabulary[t]) - 1)] == words
                possible[t, k] = int(there.sum()) >= len(words) - allowed_edits(len(words))
            return possible[t, k]

        for at in range(0, len(distinct), WINDOWS_AT_ONCE):
            block = distinct[at:at + WINDOWS_AT_ONCE]
            sizes, starts, own = all_sizes[block], all_starts[block], which[block]
            runs = np.full((len(sizes), self.longest + 1), _PAD)
            for i, (t, start, n) in enumerate(zip(own.tolist(), starts.tolist(), sizes.tolist())):
                part = texts[t][max(0, start):max(0, start + n)]
                runs[i, max(0, -start):max(0, -start) + len(part)] = part
            keys = walk_keys(runs, sizes)
            low = np.searchsorted(self.keys, keys, side="left")
            n = np.searchsorted(self.keys, keys, side="right") - low
            hit = np.flatnonzero(n.any(axis=1))
            found = {(int(i), int(k)) for i in hit for r in np.flatnonzero(n[i])
                     for k in self.owner[low[i, r]:low[i, r] + n[i, r]]}
            for i, k in found:
                item = int(self.piece_item[k])
                for j in order[groups[block[i]]:groups[block[i] + 1]].tolist():
                    t = int(which[j])
                    if may_hold(t, item):
                        pairs.add((t, item, int(all_starts[j] - self.piece_at[k])))
        yield from sorted(pairs)

    def _places(self, texts: list[np.ndarray]):
        """(text, item, first start, last start) of candidates.  The pieces of a long item give many starts that differ
        by the edits between them, so those within the allowed edits of the first are aligned at once."""
        for (t, k), own in groupby(self._candidates(texts), key=lambda c: c[:2]):
            size = len(self.items[k][1])
            span = allowed_edits(size) if len(piece_bounds(size)) > 2 else 0
            first = last = None
            for _, _, start in own:
                if first is not None and start - first > span:
                    yield t, k, first, last
                    first = None
                first, last = start if first is None else first, start
            yield t, k, first, last

    def search(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, end) of every item a text contains, at its best place; both by position."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for t, k, start, last in self._places(texts):
            words = self.items[k][1]
            slack = allowed_edits(len(words))
            low = max(0, start - slack)
            region = texts[t][low:max(0, last + len(words) + slack)]
            if np.count_nonzero(np.isin(words, region)) < len(words) - slack:
                continue  # every word that is missing costs an edit
            distance, first, end = align(words, region)
            found = (distance, low + first, low + end)
            if distance <= slack and found < best.get((t, k), (slack + 1, 0, 0)):
                best[t, k] = found
        return [(t, k, *found) for (t, k), found in sorted(best.items())]


def item_words(text: str | None) -> np.ndarray:
    return word_hashes(np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8))


def _item_parts(benchmark: DataFrame, max_words: int) -> Iterator[list[tuple[object, np.ndarray]]]:
    """Items in parts of at most ``max_words`` words, read from a stream of rows."""
    part: list[tuple[object, np.ndarray]] = []
    held = 0
    for row in benchmark.orderBy("item_id", "text").toLocalIterator():
        words = item_words(row["text"])
        if not len(words):
            continue
        if held and held + len(words) > max_words:
            yield part
            part, held = [], 0
        part.append((row["item_id"], words))
        held += len(words)
    if part:
        yield part


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", max_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """One row per document and item it contains: ids, ``distance``, ``first_word``, ``n_words``, ``item_words``."""
    spark = docs.sparkSession
    rows = rename_free(docs, doc_id=id_col, text=text_col)
    items = rename_free(benchmark, item_id=item_col, text=item_text_col).filter("text IS NOT NULL")
    kind, item_kind = dict(rows.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = f"doc_id {kind}, item_id {item_kind}, distance int, first_word long, n_words int, item_words int"
    item_type = {"bigint": pa.int64(), "int": pa.int32()}.get(item_kind, pa.string())

    def searcher(shared):
        def run(batches):
            index = shared.value
            for batch in slices(batches):
                ids = batch.column(0).to_pylist()
                texts = [np.zeros(0, np.uint64) if data is None else word_hashes(data) for data in string_views(batch.column(1))]
                out = [(ids[t], index.items[k][0], distance, start, end - start, len(index.items[k][1]))
                       for t, k, distance, start, end in index.search(texts)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (batch.column(0).type, item_type, pa.int32(), pa.int64(),
                                                                    pa.int32(), pa.int32()))],
                        names=["doc_id", "item_id", "distance", "first_word", "n_words", "item_words"])

        return run

    found = spark.createDataFrame([], schema)
    for k, part in enumerate(_item_parts(items, max_words)):
        one = rows.mapInArrow(searcher(spark.sparkContext.broadcast(ItemIndex(part))), schema)
        found = one if k == 0 else found.unionByName(one)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The documents that contain no item, with all their columns; each row is judged by its own text."""
    rows, _ = with_own_ids(docs, id_col)
    found = leaks(rows, benchmark, id_col=OWN_ID, **columns).select(F.col("doc_id").alias(OWN_ID)).distinct()
    return without(rows, found, OWN_ID).drop(OWN_ID)
