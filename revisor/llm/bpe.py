"""BPE encoding and decoding with a tokenizer file's word vocabulary (operator 12).

A text is parted at the special tokens' own strings, normalized, cut into words
by the file's pattern, and each word is merged.

*Contiguous rank array.*  A word's parts lie in two short lists: where each part
begins, and the rank of the merge of each part with the next.  The smallest rank
is looked for by scanning, its second boundary is deleted, and the two ranks
beside it are looked up again.  Words are short, so the scan costs less than any
structure that would avoid it.  It is quadratic in the word's length, so a word
of more than ``LONG_WORD`` characters takes its merges from a heap of
(rank, place) over linked parts instead, which makes the same merges in the
same order in ``n log n``.

What is a letter, a number or white space follows the tokenizers library's own
Unicode tables, which the driver asks for once and sends along; so do the normal form and
lower case of characters that the tables of two Unicode versions may tell apart.

Words repeat, so a worker remembers the ids of what stood between white space
(twice ``REMEMBERED`` at most); the pattern is only matched inside what is new.  Texts are read in pieces of about ``PIECE`` characters, cut before white
space, which no word, normal form or special token spans.

Defined cases: a null text is empty and has no ids; so has a text of white space
only; a text of any length is read whole; the strings of special tokens become
their ids; ids unknown to the vocabulary are an error when decoding; a null id
column, repeated rows, an empty table and extra columns of any name change
nothing, as every row stands for itself.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from revisor.llm.common import bound_batches, slices

LONG_WORD = 64
REMEMBERED = 1 << 18
PIECE = 1 << 18
NO_RANK = 1 << 60

#: Characters that Python's ``split`` takes for white space, the tokenizers library not.
_NOT_WHITE = ("\x1c", "\x1d", "\x1e", "\x1f")

#: Characters on whose normal form and lower case all recent Unicode versions agree: to Cyrillic, kana, CJK, Hangul.
_UNSETTLED = re.compile("[^\x00-\u052f\u3041-\u3096\u3099-\u30ff\u4e00-\u9fff\uac00-\ud7a3]")


@functools.cache
def character_classes() -> dict[str, str]:
    """The library's letters, numbers and white space, as ranges for a character set."""
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    parts = [every[at:at + 4096] for at in range(0, len(every), 4096)]
    found = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str
        found[name] = "".join(run[0] if len(run) == 1 else f"{run[0]}-{run[-1]}" for part in parts for run, _ in runs(part))
    return found


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Remembered(dict):
    """Ids (as bytes) of settled texts without white space, made when asked for the first time.

    A full memory becomes the ``older`` one, from which what is asked for again comes back.
    """

    def __init__(self, coder: WordBpe):
        self.coder = coder
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            words = self.coder.words(part)
            ids = (np.array(self.coder.merge(part), dtype=np.int32).tobytes() if words == [part]
                   else b"".join(map(self.__getitem__, words)))
        if len(part) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


class WordBpe:
    """Encoder and decoder of a tokenizer file: NFC, white space to one blank, lower case, pattern, byte-level BPE."""

    def __init__(self, path: str, classes: dict[str, str] | None = None):
        classes = classes or character_classes()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or any(
                model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path}: only plain byte-level BPE with word ends is read")
        steps = spec["pre_tokenizer"]["pretokenizers"]
        shape = ([s["type"] for s in spec["normalizer"]["normalizers"]], [s["type"] for s in steps],
                 steps[0]["behavior"], steps[0]["invert"], steps[1]["add_prefix_space"], steps[1]["use_regex"])
        if shape != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "Removed", True, False, False):
            raise ValueError(f"{path}: another normalizer or pre-tokenizer: {shape}")
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (*self.vocab.items(), *self.special.items())}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.wide = max(self.vocab.values()) + 1
        #: left id * wide + right id -> rank; the id of both together by rank
        self.ranks = {self.vocab[a] * self.wide + self.vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.joined = [self.vocab[a + b] for a, b in pairs]
        shown = byte_characters()
        self.first_ids = [self.vocab[c] for c in shown]
        self.last_ids = [self.vocab[c + self.end] for c in shown]
        self._special = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        pattern = steps[0]["pattern"]["Regex"]
        self._ascii_word = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").replace(r"\s", r"\t-\r "))
        for name, characters in classes.items():
            pattern = pattern.replace(name, characters)
        self._word = re.compile(pattern)
        self._white = re.compile(f"[{classes[chr(92) + 's']}]")
        self._settle = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self._known = _Remembered(self)
        self._table: pa.Array | None = None

    def settled(self, piece: str) -> str:
        """NFC and lower case; white space only parts words, so it is not folded to one blank first."""
        if piece.isascii():
            return piece.lower()
        if _UNSETTLED.search(piece):
            return self._settle(piece)
        # lower case character by character: the final form of sigma does not depend on its neighbours
        return unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()

    def words(self, settled: str) -> list[str]:
        """The pattern's words in a settled text."""
        return (self._ascii_word if settled.isascii() else self._word).findall(settled)

    def merge(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        data = word.encode("utf-8", "surrogatepass")
        ids = [self.first_ids[b] for b in data[:-1]]
        ids.append(self.last_ids[data[-1]])
        return self._by_heap(ids) if len(ids) > LONG_WORD else self._by_scan(ids)

    def _by_scan(self, ids: list[int]) -> list[int]:
        """Part ``k`` has ``ids[k]``; ``near[k]`` is the rank of joining it with the next one."""
        rank_of, wide = self.ranks.get, self.wide
        near = [rank_of(a * wide + b, NO_RANK) for a, b in itertools.pairwise(ids)]
        while near:
            least = min(near)
            if least == NO_RANK:
                break
            k = near.index(least)
            ids[k] = own = self.joined[least]
            del ids[k + 1], near[k]
            if k < len(near):
                near[k] = rank_of(own * wide + ids[k + 1], NO_RANK)
            if k:
                near[k - 1] = rank_of(ids[k - 1] * wide + own, NO_RANK)
        return ids

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same merges for a long word: the smallest rank, leftmost first."""
        ranks, wide, n = self.ranks, self.wide, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[a * wide + b], k, a, b) for k, (a, b) in enumerate(itertools.pairwise(ids)) if a * wide + b in ranks]
        heapq.heapify(heap)

        def offer(k):
            if k >= 0 and after[k] < n and (rank := ranks.get(ids[k] * wide + ids[after[k]])) is not None:
                heapq.heappush(heap, (rank, k, ids[k], ids[after[k]]))

        while heap:
            rank, k, left, right = heapq.heappop(heap)
            if ids[k] != left or after[k] >= n or ids[after[k]] != right:
                continue  # one of the two has been merged since
            gone = after[k]
            ids[k], ids[gone] = self.joined[rank], -1
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [i for i in ids if i >= 0]

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > 2 * PIECE:
            cut = self._white.search(text, at + PIECE)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _plain(self, text: str, out: list[bytes]) -> None:
        for piece in self._pieces(text):
            settled = self.settled(piece)
            odd = any(c in settled for c in _NOT_WHITE)
            parts = self._white.split(settled) if odd else settled.split()
            out.extend(map(self._known.__getitem__, parts))

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        at = 0
        for found in self._special.finditer(text):
            self._plain(text[at:found.start()], out)
            out.append(np.int32(self.special[found.group()]).tobytes())
            at = found.end()
        self._plain(text[at:] if at else text, out)
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids) -> str:
        """Without a decoder in the file, tokens are joined by blanks."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids; empty for a null."""
        if self._table is None:
            self._table = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())
        tokens = self._table.take(lists.flatten())
        if tokens.null_count:
            raise KeyError("an id without a token")
        lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        ends = pa.array(np.cumsum(np.r_[0, lengths]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, tokens), " ")


_encoders: dict[str, WordBpe] = {}


def encoder(path: str, classes: dict[str, str]) -> WordBpe:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordBpe(path, classes)
    return _encoders[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text; ``path`` names the tokenizer file on every machine."""
    bound_batches(docs)
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    classes = character_classes()

    def run(batches):
        own = encoder(path, classes)
        for batch in slices(batches, 2 << 20):
            ids = [own.encode(text) for text in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = pa.array(np.concatenate(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(frame: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``frame`` with ``decoded``, the text of its ids; null ids decode to an empty text."""
    bound_batches(frame)
    at = frame.columns.index(ids_col)
    plain = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    classes = character_classes()

    def run(batches):
        own = encoder(path, classes)
        for batch in slices(batches, 2 << 20):
            yield pa.RecordBatch.from_arrays([*batch.columns, own.decode_lists(batch.column(at))], names=[*batch.schema.names, "decoded"])

    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes) + ", decoded string"
    return plain.mapInArrow(run, schema).toDF(*frame.columns, "decoded")


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one blank."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
