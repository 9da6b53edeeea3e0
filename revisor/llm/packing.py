"""Best-fit packing of tokenised documents by best-two-fit (operator 8).

Packing only looks at lengths, and no piece is longer than the sequence
length, so the whole corpus packs through its length histogram (at most
``length`` numbers): ``packing_plan`` fills a sequence greedily with the largest
piece that fits, then replaces its smallest piece by two unpacked pieces that
fill the widened gap more tightly, and repeats each pattern of lengths as
often as the same choices would be made again.  A pattern run leaves one of its
lengths with fewer pieces than a sequence takes, so the number of plan rows depends on
the lengths, not on the corpus.

On the executors a piece gets its rank among the pieces of its length: its
place within its input partition plus the partition's offset, a prefix sum over
(partition, length) counts.  The plan owns ranges of ranks for each length,
so length and rank give the sequence and the offset by a binary search.  The
partitions' offsets grow with the input, so they are merged with the pieces by
(partition, length) behind an exchange of narrow rows, never broadcast; a key holds
only pieces of one input partition, so no length of the corpus meets in one task.
No text is shuffled, and nothing is collected but the histogram.

Defined cases: a null text is empty and packs as the single end id; equal and
repeated rows are packed one by one; a null id is carried along; an empty
table gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisor.llm.common import rename_free, slices, staged

SEQUENCE_TOKENS = 2048
END_ID = 0
#: Fixed value: the one special token of the vocabulary file.
SPECIAL = "<|endoftext|>"


def load_encoder(json_path: str) -> Callable[[str], np.ndarray]:
    """Text to ids of the byte-level BPE in a ``tokenizers`` file.

    The merges are run by tiktoken over the same vocabulary (its rank file lies
    beside the JSON file), four times as fast with equal ids; a text that holds
    the special token's string, which ``tokenizers`` reads as that token, goes
    through ``tokenizers`` itself, as does everything if there is no rank file.
    """
    import os

    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)

    def slow(text: str) -> np.ndarray:
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")

    ranks_path = os.path.splitext(json_path)[0] + ".tiktoken"
    if not os.path.exists(ranks_path):
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return slow(text)
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be short."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first)] + [(at, length) for at in range(first, n, length)]


def _pieces(docs: DataFrame, tokenizer: str, length: int, with_ids: bool) -> DataFrame:
    """Pieces with their partition and their place among the partition's pieces of that length."""

    def cut_batches(batches):
        from pyspark import TaskContext

        encode = load_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(length + 1, dtype=np.int64)
        for batch in slices(batches):
            rows: list[tuple] = []
            ids_out: list[np.ndarray] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for piece, (start, n) in enumerate(cut(len(ids), length)):
                    own = ids[start:start + n]
                    rows.append((doc, piece, start, n, zlib.crc32(own.tobytes()), part, int(seen[n])))
                    seen[n] += 1
                    if with_ids:
                        ids_out.append(own)
            columns = list(zip(*rows))
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            if with_ids:
                ends = np.cumsum([0] + [len(x) for x in ids_out])
                arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                       pa.array(np.concatenate(ids_out).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = dict(docs.dtypes)["doc_id"]
    doc_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())
    types = [doc_type, pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"] + ["ids"] * with_ids
    schema = (f"doc_id {kind}, piece int, start long, length int, ids_crc32 long, part int, place long"
              + ", ids array<int>" * with_ids)
    return docs.mapInArrow(cut_batches, schema)


def packing_plan(counts: np.ndarray, length: int) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, number of such sequences) for a histogram of lengths.

    Best-two-fit: every sequence starts with the longest piece left and takes
    the longest that still fits until none does; then its smallest piece gives
    way to the two unpacked pieces that fill its place and the gap best, if they
    fill more than it did (of equal sums, the pair with the larger piece).  A pattern
    repeats as long as packing one sequence after the other would choose it again.
    """
    left = np.array(counts, dtype=np.int64)
    left[0] = 0
    plan: list[tuple[list[int], int]] = []
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return plan
        used: dict[int, int] = {}
        chosen: list[int] = []
        gap = length
        while gap:
            at = np.searchsorted(have, gap, side="right") - 1
            while at >= 0 and left[have[at]] <= used.get(int(have[at]), 0):
                at -= 1
            if at < 0:
                break
            size = int(have[at])
            n = min(gap // size, int(left[size]) - used.get(size, 0))
            chosen += [size] * n
            used[size] = used.get(size, 0) + n
            gap -= n * size
        wanted = dict(used)  # pieces that must be there for the same choices
        if gap and len(chosen) > 1:
            smallest = chosen[-1]
            free = left.copy()
            for size, n in used.items():
                free[size] -= n
            pair = best_pair(free, gap + smallest)
            if pair and sum(pair) > smallest:
                chosen = chosen[:-1] + list(pair)
                for size in pair:
                    wanted[size] = wanted.get(size, 0) + 1
        need = {size: chosen.count(size) for size in set(chosen)}
        times = min((int(left[size]) - wanted[size]) // n + 1 for size, n in need.items())
        for size, n in need.items():
            left[size] -= n * times
        plan.append((chosen, times))


def best_pair(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two free lengths with the largest sum within ``room``."""
    have = np.flatnonzero(free[:room + 1])
    have = have[have > 0]
    if not len(have):
        return None
    at = np.searchsorted(have, room - have, side="right") - 1
    other = np.where(at >= 0, have[np.maximum(at, 0)], 0)
    # a length with one piece left can't pair with itself: take the next smaller one
    alone = (other == have) & (free[have] < 2)
    lower = np.where(at > 0, have[np.maximum(at - 1, 0)], 0)
    other = np.where(alone, lower, other)
    sums = np.where(other > 0, have + other, 0)
    if not sums.max(initial=0):
        return None
    best = np.flatnonzero(sums == sums.max())
    first = best[np.argmax(np.maximum(have[best], other[best]))]
    return tuple(sorted((int(have[first]), int(other[first])), reverse=True))


def plan_ranges(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """One row per (pattern, length): length, first rank, pieces per sequence, first sequence, offset."""
    rows, rank, sequence = [], {}, 0
    for chosen, times in plan:
        offset, at = 0, 0
        while at < len(chosen):
            size, n = chosen[at], 1
            while at + n < len(chosen) and chosen[at + n] == size:
                n += 1
            first = rank.get(size, 0)
            rows.append((size, first, n, sequence, offset))
            rank[size] = first + n * times
            offset, at = offset + n * size, at + n
        sequence += times
    out = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         length: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pack every document; one row per piece.

    Columns: the id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and, if asked for, the token ``ids``.
    """
    spark = docs.sparkSession
    pieces, _ = staged(_pieces(rename_free(docs, doc_id=id_col, text=text_col), tokenizer or default_tokenizer(),
                               length, with_ids), "pack-pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    per_part, _ = staged(per_part, "pack-counts")
    histogram = np.zeros(length + 1, dtype=np.int64)  # at most `length` rows reach the driver
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    ranges = spark.sparkContext.broadcast(plan_ranges(packing_plan(histogram, length)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    columns = [c for c in pieces.columns if c not in ("part", "place")]

    def assign(batches):
        table = ranges.value
        # ranges are sorted by (length, first rank): one key orders both
        scale = np.int64(1) << np.int64(48)
        keys = table[:, 0] * scale + table[:, 1]
        for batch in batches:
            size = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("place").to_numpy() + batch.column("skip").to_numpy()
            row = table[np.searchsorted(keys, size * scale + rank, side="right") - 1]
            inner = rank - row[:, 1]
            sequence = row[:, 3] + inner // row[:, 2]
            offset = row[:, 4] + inner % row[:, 2] * size
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(sequence), pa.array(offset)],
                names=columns + ["sequence_id", "offset"])

    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", sequence_id long, offset long"
    joined = pieces.join(offsets.hint("merge"), ["part", "length"], "left")
    return joined.mapInArrow(assign, schema).withColumn("length", F.col("length").cast("long"))
