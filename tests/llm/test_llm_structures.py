"""Operators 11, 12 and 13 against plain versions, and their defined cases."""

import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from edge_rows import EDGE, edge, none, prose  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revisor.llm import bpe, merkle, periodic
from revisor.llm.hashing import mix
from revisor.llm.queries import _planted

FILE = public_tokenizers.path("word_bpe_49k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- 11: Merkle manifest -------------------------------------------------------------

def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row):
    return sha("".join(map(field, row)))


def plain_tree(nodes):
    """(root, for each node its levels of (siblings left, siblings right))."""
    steps, own, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, at in enumerate(own):
            run = at // 16 * 16
            steps[k].append(("".join(level[run:at]), "".join(level[at + 1:run + 16])))
        level = [sha("".join(level[k:k + 16])) for k in range(0, len(level), 16)]
        own = [at // 16 for at in own]
    return level[0], steps


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    trees = {}
    for source, own in by_source.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[source] = (own, *plain_tree([plain_leaf(r) for r in own]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, tops = plain_tree([trees[s][1] for s in order])
    out = []
    for source, above in zip(order, tops):
        own, subroot, paths = trees[source]
        for row, path in zip(own, paths):
            node = plain_leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = plain_leaf((*row[:4], row[4].translate(brute.FOLD)))
            for before, after in path + above:
                node = sha(before + node + after)
            proof = sha("".join(b + a for b, a in path + above))
            out.append((row[0], plain_leaf(row), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def manifest_rows(df):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return sorted((tuple(r) for r in merkle.checked(df, tampered).collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (1, 256, 257), (2, 300, 1, 33)])
def test_manifest_matches_plain_version(spark, sizes):
    rng, rows = random.Random(len(sizes) + sizes[-1]), []
    for k, n in enumerate(sizes):
        rows += [(i * 10 + k, [None, "b", "", "é", "B"][k], rng.choice(["en", None]), rng.choice([3, None]),
                  rng.choice([None, "", "Some Text", "漢字 " + str(i)])) for i in range(n)]
    rng.shuffle(rows)
    assert manifest_rows(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain_manifest(rows)


def test_manifest_of_many_sources_and_a_hot_one(spark):
    rows = [(i, f"s{i}" if i % 3 else "hot", "en", 1, f"Text {i}") for i in range(700)]
    found = manifest_rows(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert found == plain_manifest(rows)
    assert {r[6] for r in found} == {True, False}


def test_manifest_of_a_deep_tree(spark):
    """Five levels: more than one stored level between leaf and root."""
    n = 66_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"),
                               F.lit(1).cast("long").alias("n_chars"), F.lit("x").alias("text"))
    own = merkle.checked(df, F.lit(False)).filter("doc_id IN (0, 255, 256, 65535, 65536, 65999)").collect()
    root, steps = plain_tree([plain_leaf((i, "s", None, 1, "x")) for i in range(n)])
    assert len(own) == 6
    for r in own:
        assert r["root"] == r["subroot"] == r["folded_root"] == root and r["verified"]
        assert r["proof_sha256"] == sha("".join(b + a for b, a in steps[r["doc_id"]]))


def test_manifest_stores_every_second_level_only(spark, tmp_path):
    leaves = spark.range(5000).select(F.lit("s").alias("source"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    made = merkle.Manifest.write(leaves, folder=str(tmp_path))
    assert [level.select(F.sum(F.size("nodes"))).first()[0] for level in made.sources.levels] == [5000, 20, 1]
    assert made.root() == plain_tree([sha(str(i)) for i in range(5000)])[0]


def test_manifest_edges(spark, edge, none):
    base = edge.withColumn("n_chars", F.length("text").cast("long"))
    rows = [(i, "s", "en", None if t is None else len(t), t) for i, t in EDGE]
    assert manifest_rows(base) == plain_manifest(rows)
    assert merkle.checked(none, F.lit(False)).count() == 0
    twice = spark.createDataFrame([(1, "s", "en", 1, "A")] * 40, SCHEMA)
    assert manifest_rows(twice) == plain_manifest([(1, "s", "en", 1, "A")] * 40)


# -- 12: BPE ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(FILE)
    own.no_truncation()
    own.no_padding()
    return own


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(FILE)


def equal(library, coder, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return coder.encode(text).tolist() == ids and coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_character_as_the_library(library, coder):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 64):
        part = every[at:at + 64]
        for text in (" ".join(part), "".join(f"A{c}b" for c in part), "".join(f"{c}̧́ " for c in part)):
            assert equal(library, coder, text), hex(ord(part[0]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "The", "'s", "'LL", "Σ", "ς", "É", "́", "漢", "ǅ", "İ", "ß", " ", "\n", "\x1c", "\x85", " ", "!?", "12", "½",
                                 "🏳️‍🌈", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|end"]), max_size=30))
def test_texts_as_the_library(library, coder, parts):
    assert equal(library, coder, "".join(parts))


@pytest.mark.parametrize("text", ["x" * 50_000 + " abc", "ab" * 20_000, "the" * 999, "é" * 3000 + "z", "lolol" * 13, "a" * 65, "a" * 64])
def test_long_words_as_the_library(library, coder, text):
    assert equal(library, coder, text)


def test_heap_and_scan_make_the_same_merges(coder):
    rng = random.Random(4)
    for _ in range(300):
        ids = [coder.first_ids[ord(rng.choice("theinasor"))] for _ in range(rng.randint(1, 60))]
        assert coder._by_scan(list(ids)) == coder._by_heap(list(ids))


def test_long_texts_are_cut_before_white_space_only(coder, monkeypatch):
    text = " ".join(["Straße", "x" * 40, "déjà\n\nvu", "12 34!"] * 50)
    whole = coder.encode(text).tolist()
    monkeypatch.setattr(bpe, "PIECE", 37)
    assert coder.encode(text).tolist() == whole


def test_bpe_edges(spark, edge, none, library):
    rows = bpe.decode(bpe.encode(edge, FILE), FILE).withColumn("digest", bpe.ids_digest(F.col("ids"))).collect()
    assert len(rows) == len(EDGE)
    expected = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in EDGE), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in rows), key=str) == expected
    for r in rows:
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)
        assert r["digest"] == sha(" ".join(map(str, r["ids"])))
    assert bpe.decode(bpe.encode(none, FILE), FILE).count() == 0


def test_another_kind_of_file_is_refused():
    with pytest.raises(ValueError):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))


# -- 13: periodic runs -------------------------------------------------------------------

def hashed(words):
    return mix(np.array(words, dtype=np.uint64) + np.uint64(5))


def equal_runs(words):
    return [tuple(r) for r in periodic.runs_of(hashed(words)).tolist()] == brute.runs(words)


@settings(max_examples=400, deadline=None)
@given(st.recursive(st.lists(st.integers(0, 2), min_size=1, max_size=7), lambda inner: st.one_of(
    st.tuples(inner, st.integers(1, 12)).map(lambda x: x[0] * x[1]),
    st.tuples(inner, inner).map(lambda x: x[0] + x[1]),
    st.tuples(inner, inner).map(lambda x: x[0] + x[1] + x[0])), max_leaves=5).filter(lambda w: len(w) < 700))
def test_runs_of_repetitive_sequences(words):
    assert equal_runs(words)


def fibonacci(n):
    a, b = [0], [0, 1]
    for _ in range(n):
        a, b = b, b + a
    return b


def thue_morse(n):
    x = [0]
    for _ in range(n):
        x = x + [1 - y for y in x]
    return x


@pytest.mark.parametrize("words", [
    fibonacci(12), thue_morse(9), [0] * 500, ([0, 1] * 40 + [0]) * 2, [0, 1] * 100 + [0] + [0, 1] * 60 + [0],
    ([0] * 50 + [1]) * 4, (([0] * 30 + [1]) * 5 + [2]) * 3, list(range(300)) * 2, list(range(6)) * 2, [7] * 11, [7] * 12, []])
def test_runs_of_known_sequences(words):
    assert equal_runs(words)


def test_touching_regions_give_all_omitted_periods():
    words = [0, 1] * 300 + [0] + [0, 1] * 200 + [0]
    assert len(brute.runs(words)) > 190 and equal_runs(words)


def test_synchronising_sets_follow_contexts_and_leave_no_gap():
    rng = np.random.default_rng(3)
    words = hashed(np.r_[rng.integers(0, 3, 500), rng.integers(0, 3, 200).repeat(1), [1, 2] * 150, rng.integers(0, 3, 500)])
    words = np.r_[words, words[100:900]]
    windows, runs = periodic.Windows(words), periodic._smallest(periodic._small(words))
    for scale in (4, 8, 16, 32):
        at = periodic.synchronising(windows, scale, runs)
        chosen = np.zeros(len(words), dtype=bool)
        chosen[at] = True
        context = windows[scale.bit_length()]
        held = {}
        for i, c in enumerate(context.tolist()):
            assert held.setdefault(c, chosen[i]) == chosen[i]
        for i in range(len(words) - 3 * scale + 1):
            if not chosen[i:i + scale].any():
                part = words[i:i + 3 * scale - 1]
                assert any((part[q:] == part[:-q]).all() for q in range(1, scale // 3 + 1))


@pytest.mark.parametrize("kept", [3, 5])
def test_few_window_tables_give_the_same_runs(kept, monkeypatch):
    words = (list(range(100)) * 7 + [5]) * 3
    monkeypatch.setattr(periodic, "TABLE_BYTES", kept * 8 * len(words))
    assert equal_runs(words)


def plain_collapse(doc_id, text, plant):
    w = brute.words(text, fold=False)
    order = _planted(doc_id, len(w)) if plant else None
    w = w if order is None else [w[i] for i in order]
    runs = sorted(brute.runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    return (doc_id, len(w), len(runs), *((best[0], best[1] - best[0], best[2]) if best else (None,) * 3),
            "".join(f"{s},{e - s},{q}\n" for s, e, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))


def test_planted_places():
    for doc_id in range(300):
        h, n = zlib.crc32(str(doc_id).encode()), 50
        order = _planted(doc_id, n)
        assert (order is None) == (h % 10 != 0) and _planted(doc_id, 0) is None
        if order is not None:
            a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
            assert order.tolist() == [i if i < a else a + (i - a) % p for i in range(n)]


def test_collapse_matches_plain_version(spark, edge, none):
    texts = [(i, t) for i, t in EDGE if i not in (11,)] + [(100 + k, prose(60 + k, k, 5 + k)) for k in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    for plant in (False, True):
        found = periodic.collapse(df, rewrite=_planted if plant else None).collect()
        assert sorted(map(tuple, found), key=str) == sorted((plain_collapse(i, t, plant) for i, t in texts), key=str)
    runs = periodic.find_runs(df).collect()
    assert sorted((r["doc_id"], r["start"], r["length"], r["period"]) for r in runs if r["doc_id"] and r["doc_id"] >= 100) == sorted(
        (i, s, e - s, q) for i, t in texts if i and i >= 100 for s, e, q in brute.runs(brute.words(t, fold=False)))
    assert periodic.collapse(edge).count() == len(EDGE)
    assert periodic.collapse(none).count() == 0 and periodic.find_runs(none).count() == 0
