"""Runs (maximal repetitions) of a text's words by string synchronising sets (operator 13).

A run is a stretch of words with smallest period ``q`` and at least
``max(LEAST, 2 * q)`` words that no neighbouring word extends.  All runs are found.

*Small periods.*  Below ``SMALL`` words the sequence is compared with itself, ``q``
words on.  The stretches found are also the highly periodic regions below.

*Scales.*  For ``t = 4, 8, 16, ...`` a position is in the synchronising set of
scale ``t`` if, among the windows of ``t`` words that begin at it or up to ``t`` words
on, the first or the last one has the smallest hash; windows of period ``t / 3``
or less have none.  Whether a position is in the set depends on the next ``2 * t`` words
alone (its context), and only regions of period ``t / 3`` or less hold ``t`` positions in a
row without one.  So a run of a period ``q`` from ``3 * t`` to ``6 * t`` holds two positions
of the set, ``q`` apart and of equal contexts, unless its first ``q`` words are such a
region.  Equal contexts lie more than ``t / 3`` apart, so a position is paired with
few others within ``6 * t``.  Each pair proposes its distance; comparing windows of
``1, 2, 4, ...`` words to both sides gives the stretch of that period around it.

*Omitted periods.*  A run whose first ``q`` words have a period ``p`` of ``q / 9`` or
less lies on two runs of period ``p`` that touch, and ``q`` is their offset modulo
``p``: each touching pair of long runs proposes those periods.

Of stretches with the same ends the smallest period counts; periods that are
multiples of it propose the same stretch.  Windows have 64-bit hashes, made from
their halves by a bit mixer, and words those of ``hashing.word_hashes``.

Texts of a batch are searched together, parted by words that occur once.  A
search holds a few numbers a word and window tables of ``TABLE_BYTES`` at most;
larger windows are made again when a scale asks for them, and longer matches are
walked in steps of the largest window kept.

Defined cases: a null or blank text has no words and no runs; a text of any
length is read whole and belongs to one task; repeated rows and null ids each
stand for themselves; equal longest runs give the one that starts first, then
the smaller period; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revisor.llm.common import rename_free, slices, string_views
from revisor.llm.hashing import SAME, mix, word_bounds, word_hashes

LEAST = 12
SCALE = 4  # the smallest scale
SMALL = 3 * SCALE  # the smallest period that a scale finds
BATCH_WORDS = 1 << 17
TABLE_BYTES = 1 << 27
_TOP = np.uint64(2**64 - 1)
_NONE = np.zeros((0, 3), dtype=np.int64)

#: doc id and number of words -> for each word, the place of the word that stands there (None: unchanged)
Rewrite = Callable[[object, int], "np.ndarray | None"]


class Windows:
    """Hashes of the windows of ``2 ** k`` words, one table for each ``k`` asked for."""

    def __init__(self, words: np.ndarray):
        self.tables = [words]
        self.most = max(3, TABLE_BYTES // max(1, 8 * len(words)))

    @staticmethod
    def _doubled(table: np.ndarray, k: int) -> np.ndarray:
        """Hashes of twice as many words, from those of ``2 ** (k - 1)``."""
        half = 1 << (k - 1)
        n = max(0, len(table) - half)
        return mix(mix(table[:n] + np.uint64(2 * k + 1)) + table[half:half + n])

    def __getitem__(self, k: int) -> np.ndarray:
        while len(self.tables) <= min(k, self.most - 1):
            self.tables.append(self._doubled(self.tables[-1], len(self.tables)))
        table = self.tables[min(k, self.most - 1)]
        for larger in range(self.most, k + 1):  # not kept
            table = self._doubled(table, larger)
        return table

    def common(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """Number of equal words from ``a`` and ``b`` (after ``a``) on, or of those before them."""
        n = len(self.tables[0])
        done = np.zeros(len(a), dtype=np.int64)

        def equal(k, at):
            size = 1 << k
            table = self[k]
            if back:
                i, j = a[at] - done[at] - size, b[at] - done[at] - size
                fits = i >= 0
            else:
                i, j = a[at] + done[at], b[at] + done[at]
                fits = j + size <= n
            out = np.zeros(len(at), dtype=bool)
            out[fits] = table[i[fits]] == table[j[fits]]
            return out

        live, k = np.arange(len(a)), 0
        reached = np.zeros(len(a), dtype=np.int64)
        while len(live):
            hit = equal(k, live)
            done[live[hit]] += 1 << k
            reached[live[~hit]] = k
            live = live[hit]
            if len(live) and k + 1 < self.most:
                k += 1
        for k in range(int(reached.max(initial=0)) - 1, -1, -1):
            at = np.flatnonzero(reached > k)
            done[at[equal(k, at)]] += 1 << k
        return done


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
    return edge[0::2], edge[1::2]


def _small(words: np.ndarray) -> np.ndarray:
    """(start, end, period) of all stretches of a period below ``SMALL`` that hold it twice."""
    found = []
    for q in range(1, min(SMALL, len(words))):
        starts, ends = _stretches(words[:-q] == words[q:])
        twice = ends - starts >= q
        found.append(np.stack([starts[twice], ends[twice] + q, np.full(twice.sum(), q)], axis=1))
    return np.concatenate(found) if found else _NONE


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period, in order."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]


def _marked(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in some ``[start, end)``."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def _window_least(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each ``size`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // size) * size, _TOP)
    padded[:n] = values
    rows = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - size + 1], ahead[size - 1:n])


def synchronising(windows: Windows, scale: int, runs: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set; ``runs`` holds all runs of a period of ``scale / 3`` or less."""
    k = scale.bit_length() - 1
    n = len(windows[0])
    if n < 2 * scale:
        return np.zeros(0, dtype=np.int64)
    hashes = windows[k] >> np.uint64(1)  # below _TOP
    periodic = runs[(3 * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    hashes[_marked(len(hashes), periodic[:, 0], periodic[:, 1] - scale + 1)] = _TOP
    least = _window_least(hashes, scale + 1)
    at = (least < _TOP) & ((hashes[:len(least)] == least) | (hashes[scale:] == least))
    return np.flatnonzero(at)


def _pairs(windows: Windows, scale: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions and periods from ``3 * scale`` to ``6 * scale`` that equal contexts propose; whether any context repeats."""
    at = synchronising(windows, scale, runs)
    context = windows[scale.bit_length()][at]
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    starts, periods, repeats = [], [], False
    for step in range(1, len(at)):
        same = context[step:] == context[:-step]
        repeats |= step == 1 and bool(same.any())
        apart = at[step:] - at[:-step]
        near = same & (apart < 6 * scale)
        if not near.any():
            break  # a pair further on in the order is further apart
        own = near & (apart >= 3 * scale)
        starts.append(at[:-step][own])
        periods.append(apart[own])
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *starts]), np.concatenate([empty, *periods]), repeats


def _grown(windows: Windows, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The stretch of each period around each place that holds it twice."""
    if not len(at):
        return _NONE
    start = at - windows.common(at, at + period, back=True)
    end = at + period + windows.common(at, at + period)
    return _smallest(np.stack([start, end, period], axis=1)[end - start >= 2 * period])


def _counted(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` its index, that many times, and the numbers from 0 below it."""
    index = np.repeat(np.arange(len(counts)), counts)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)


def _omitted(windows: Windows, runs: np.ndarray) -> np.ndarray:
    """Runs proposed by touching runs of one period, both at least nine times as long."""
    runs = runs[runs[:, 1] - runs[:, 0] >= 9 * runs[:, 2]]
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    left, right = runs[:-1], runs[1:]
    touch = (left[:, 2] == right[:, 2]) & (right[:, 0] <= left[:, 1])
    left, right = left[touch], right[touch]
    if not len(left):
        return _NONE
    # where in the first period of the left run the right run's first period occurs, by two windows that cover it
    pair, turn = _counted(left[:, 2])
    a, b, p = left[pair, 0] + turn, right[pair, 0], left[pair, 2]
    fits = np.zeros(len(pair), dtype=bool)
    size = np.floor(np.log2(p)).astype(np.int64)
    for k in np.unique(size):
        own = np.flatnonzero(size == k)
        rest = p[own] - (1 << int(k))
        table = windows[int(k)]
        fits[own] = (table[a[own]] == table[b[own]]) & (table[a[own] + rest] == table[b[own] + rest])
    pair, turn, p = pair[fits], turn[fits], p[fits]
    offset = (right[pair, 0] - left[pair, 0] - turn) % p
    most = np.minimum(left[pair, 1] - left[pair, 0], right[pair, 1] - right[pair, 0])
    index, step = _counted(np.maximum(0, (most - offset) // p + 1))
    period = offset[index] + step * p[index]
    large = period >= 2 * p[index]
    index, period = index[large], period[large]
    # a word of the left run whose image lies in the right one
    first, second = left[pair[index]], right[pair[index]]
    at = np.maximum(first[:, 0], second[:, 0] - period)
    return _grown(windows, at, period)


def runs_of(words: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs of a sequence of 64-bit word hashes, by start, then end."""
    if len(words) < LEAST:
        return _NONE
    windows = Windows(words)
    found = _smallest(_small(words))
    scale = SCALE
    while 2 * scale <= len(words):
        at, period, repeats = _pairs(windows, scale, found)
        if not repeats:
            break  # no larger context repeats either
        found = _smallest(np.concatenate([found, _grown(windows, at, period)]))
        scale *= 2
    found = _smallest(np.concatenate([found, _omitted(windows, found)]))
    return found[found[:, 1] - found[:, 0] >= np.maximum(LEAST, 2 * found[:, 2])]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words some run repeats: all of it but its first period."""
    return _marked(n, runs[:, 0] + runs[:, 2], runs[:, 1])


class Text:
    """A text's words: its bytes, where words begin and end, and their hashes."""

    def __init__(self, doc_id, data: np.ndarray | None, rewrite: Rewrite | None):
        data = np.zeros(0, np.uint8) if data is None else data
        self.doc_id, self.data = doc_id, data
        self.starts, self.ends = word_bounds(data)
        self.words = word_hashes(data, SAME)
        order = rewrite(doc_id, len(self.words)) if rewrite else None
        if order is not None:
            self.starts, self.ends, self.words = self.starts[order], self.ends[order], self.words[order]

    def joined(self, keep: np.ndarray) -> Iterator[bytes]:
        """The kept words joined by one blank, in pieces."""
        raw, at = self.data.tobytes(), np.flatnonzero(keep)
        for k in range(0, len(at), 1 << 16):
            own = at[k:k + (1 << 16)]
            yield (b" " if k else b"") + b" ".join([raw[s:e] for s, e in zip(self.starts[own].tolist(), self.ends[own].tolist())])


def _searched(texts: list[Text]) -> Iterator[tuple[Text, np.ndarray]]:
    """Each text with its runs; all are searched at once, with a word of its own after each."""
    parts, bounds = [], [0]
    for k, text in enumerate(texts):
        parts += [text.words, mix(np.array([k], dtype=np.uint64) + np.uint64(0xA5A5_0000_0000_0001))]
        bounds.append(bounds[-1] + len(text.words) + 1)
    runs = runs_of(np.concatenate(parts)) if parts else _NONE
    own = np.searchsorted(runs[:, 0], bounds)
    for k, text in enumerate(texts):
        yield text, runs[own[k]:own[k + 1]] - [bounds[k], bounds[k], 0]


def _texts(batches, rewrite: Rewrite | None) -> Iterator[list[tuple[Text, np.ndarray]]]:
    for batch in slices(batches, 1 << 20):
        ids, held, size = batch.column(0).to_pylist(), [], 0
        for doc_id, data in zip(ids, string_views(batch.column(1))):
            held.append(Text(doc_id, data, rewrite))
            size += len(held[-1].words)
            if size >= BATCH_WORDS:
                yield list(_searched(held))
                held, size = [], 0
        if held:
            yield list(_searched(held))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = rename_free(docs, doc_id=id_col, text=text_col)
    return rows, dict(rows.dtypes)["doc_id"]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """One row a run: ``doc_id, start, length, period`` (in words)."""
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches):
        for held in _texts(batches, rewrite):
            ids = [text.doc_id for text, runs in held for _ in runs]
            runs = np.concatenate([_NONE, *[runs for _, runs in held]])
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "start": runs[:, 0], "length": runs[:, 1] - runs[:, 0], "period": runs[:, 2]},
                                             schema=pa.schema([("doc_id", id_type), *[(c, pa.int64()) for c in ("start", "length", "period")]]))

    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, period long")


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """One row a document: ``doc_id``, all its ``runs`` as one text, the longest one, and ``collapsed``, the words no run repeats.

    ``runs`` holds a line ``start,length,period`` for each run by start, then period.
    """
    rows, kind = _rows(docs, id_col, text_col)
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    fields = ["n_words", "n_runs", "start", "length", "period"]
    schema = pa.schema([("doc_id", id_type), *[(c, pa.int64()) for c in fields], ("runs", pa.string()), ("collapsed", pa.string())])

    def run(batches):
        for held in _texts(batches, rewrite):
            out = {c: [] for c in schema.names}
            for text, runs in held:
                runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
                length = runs[:, 1] - runs[:, 0]
                best = int(length.argmax()) if len(runs) else None  # the first of equals
                row = [text.doc_id, len(text.words), len(runs),
                       *([None] * 3 if best is None else [int(runs[best, 0]), int(length[best]), int(runs[best, 2])]),
                       "".join(f"{s},{n},{q}\n" for s, n, q in zip(runs[:, 0].tolist(), length.tolist(), runs[:, 2].tolist())),
                       b"".join(text.joined(~dropped(len(text.words), runs))).decode("utf-8", "replace")]
                for c, value in zip(schema.names, row):
                    out[c].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in fields) + ", runs string, collapsed string")
