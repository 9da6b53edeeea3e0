"""Operators 1, 3, 6 and 8 against plain versions, and their defined cases."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from edge_rows import EDGE, LONG, edge, none, prose  # noqa: F401
from pyspark.sql import functions as F

from revisor.llm import components, fingerprints, hashing, neardup, packing, substrings
from revisor.llm.common import MAX_BLOOM_BITS, bloom, bloom_bits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")


@pytest.fixture(scope="module")
def near_set(spark):
    """Groups of near copies with a chain, in which only neighbours are linked."""
    rng, rows = random.Random(5), []
    for g in range(6):
        base = prose(120, 50 + g).split()
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(w))
    chain = prose(400, 99).split()
    rows += [" ".join(chain[k * 12:k * 12 + 120]) for k in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_word_hashes_follow_words():
    text = "Ab  cd\tAB\x0bé " + "y" * 70 + "\n"
    h = hashing.word_hashes(np.frombuffer(text.encode(), dtype=np.uint8))
    assert len(h) == 5 and h[0] == h[2] and len(set(h.tolist())) == 4
    long = ("w1 w2 w3 " * 130_000 + "z" * 1_100_000 + " w1 w2").encode()
    h = hashing.word_hashes(np.frombuffer(long, dtype=np.uint8))
    assert len(h) == 390_003 and h[-2] == h[0] and h[-1] == h[1] and h[389_999] == h[2]
    assert len(set(h.tolist())) == 4


def test_bloom_has_no_false_negatives_and_a_fixed_bound(spark):
    rows = spark.range(20000).select(F.xxhash64("id").alias("h"))
    f = bloom(rows, "h", 20000)
    keys = np.array([r["h"] for r in rows.collect()], dtype=np.int64).view(np.uint64)
    assert f.has(keys).all()
    other = np.array([r["h"] for r in spark.range(50000, 60000).select(F.xxhash64("id").alias("h")).collect()],
                     dtype=np.int64).view(np.uint64)
    assert f.has(other).mean() < 0.02
    assert bloom_bits(10**15) == MAX_BLOOM_BITS


# -- 1: fingerprints -------------------------------------------------------------

def test_fingerprint_estimates_jaccard():
    rng = np.random.default_rng(2)
    errors = []
    for n in (1, 3, 10, 100, 2000):
        for share in (0.0, 0.3, 0.8, 1.0):
            common = rng.integers(0, 2**63, max(1, int(n * share)), dtype=np.uint64) if share else np.zeros(0, np.uint64)
            a = np.unique(np.r_[common, rng.integers(0, 2**63, n, dtype=np.uint64)])
            b = np.unique(np.r_[common, rng.integers(0, 2**63, n, dtype=np.uint64)])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - true)
    assert np.abs(errors).max() < 0.12 and abs(np.mean(errors)) < 0.02


def test_edited_fingerprints_match_plain_version(spark, docs):
    out = fingerprints.edited_fingerprints(spark.createDataFrame(docs).repartition(5)).toPandas().set_index("doc_id")
    texts, ids = list(docs.text), list(docs.doc_id)
    sets = [brute.shingle_set(t) for t in texts]
    assert len(out) == len(ids)
    for k, i in enumerate(ids):
        after = texts[(k + 1) % len(texts)]
        new = fingerprints.edited(texts[k], after)
        row = out.loc[i]
        assert row.n_chars == len(texts[k]) and row.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert abs(row.near_edited - brute.jaccard(sets[k], brute.shingle_set(new))) < 0.15
        assert abs(row.near_next - brute.jaccard(sets[k], sets[(k + 1) % len(sets)])) < 0.15
    by_text = {}
    for t, f in zip(texts, out.loc[ids].fingerprint):
        assert by_text.setdefault(t, f) == f


def test_fingerprint_edges(spark, edge, none):
    rows = fingerprints.edited_fingerprints(edge).collect()
    assert len(rows) == len(EDGE)
    own = {}
    for r in rows:
        own.setdefault(r["doc_id"], r)
    assert own[2]["fingerprint"] == "" and own[2]["near_next"] == 1.0 and own[1]["n_chars"] == 0
    assert own[4]["near_next"] < 0.1 and own[5]["near_next"] == 1.0
    assert own[5]["fingerprint"] == own[7]["fingerprint"] == own[6]["fingerprint"]
    assert own[15]["edited_sha256"]  # its successor has no id
    assert fingerprints.edited_fingerprints(none).count() == 0
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")).collect()
    assert one[0]["near_next"] == 1.0


def plain_edited(rows):
    """Sorted (doc_id, n_chars, edited_sha256, equal to the next text) of (doc_id, text) rows, by id and then text hash."""
    out, n = [], len(rows)
    for k, (i, text) in enumerate(rows):
        new = fingerprints.edited(text, rows[(k + 1) % n][1])
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [7, None])
def test_fingerprints_of_a_hot_id(spark, hot):
    """Half the rows share an id or have none, a quarter are one row; no bucket holds the shared id whole."""
    rows = [(k, prose(30 + k % 50, k)) for k in range(150)] + [(hot, prose(20 + k % 9, 1000 + k)) for k in range(150)] + [(hot, prose(40, 3))] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    tie = {r["text"]: (r["a"], r["b"]) for r in df.select("text", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tie[r[1]]))
    found = fingerprints.edited_fingerprints(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == plain_edited(ordered)
    assert sum(r["near_next"] == 1.0 for r in found) >= 99
    keyed = fingerprints._keyed(df, "doc_id", "text")
    dealt = fingerprints.with_successor(keyed, keyed.select(*fingerprints.KEY).distinct()).filter("NOT guest")
    per_bucket = dealt.filter(F.col("doc_id").eqNullSafe(F.lit(hot))).groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert per_bucket <= 20


# -- 3: substrings -----------------------------------------------------------------

def test_cover_is_a_difference_cover():
    differences = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert differences == set(range(substrings.PERIOD))


def check_substrings(rows, found):
    expected = brute.substring_dedup([(i, t) for i, t in rows if i is not None])
    for r in found:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == expected[r["doc_id"]]


def test_substrings_match_plain_version(spark, docs):
    rows = list(zip(docs.doc_id.tolist(), docs.text))
    passage = prose(70, 8)
    rows += [(10_000 + k, prose(40 + k, 100 + k) + " " + passage + " " + prose(30, 200 + k)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = substrings.deduplicate(df, digest_only=True).collect()
    assert len(found) == len(rows)
    check_substrings(rows, found)


def test_substring_edges(edge, none):
    found = substrings.deduplicate(edge).collect()
    assert len(found) == len(EDGE)
    check_substrings(EDGE, found)
    gone = {r["doc_id"]: r["n_removed"] for r in found}
    assert gone[7] == 220 and gone[9] == 80 and gone[14] == 120 and gone[13] == 0
    assert substrings.deduplicate(none).count() == 0
    kept = substrings.remove_repeats(edge)
    assert kept.columns == edge.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in EDGE} - {7, 14}
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    assert next(r for r in rows if r["doc_id"] == 6)["text"] == LONG.upper().replace(" ", "\n")
    assert substrings.remove_repeats(none).count() == 0


# -- 6: near duplicates --------------------------------------------------------------

def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 2**63, 900, dtype=np.uint64) for _ in range(2))
    b[:700] = a[:700]
    s, t = neardup.sketch(a), neardup.sketch(b)
    assert (neardup.merge(s, t) == neardup.sketch(np.union1d(a, b))).all()
    near = neardup.estimate(np.array([900]), np.array([900]), np.array([(s == t).sum()]), np.array([(s > t).sum()]))
    assert abs(near[0] - 700 / 1100) < 0.12
    assert (1 - 0.75 ** neardup.ROWS) ** neardup.BANDS < 3e-7


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(3, 3), (250, 900)]
    found, _ = components.components(spark.createDataFrame(edges, "u long, v long"))
    by = {r["node"]: r["component"] for r in found.collect()}
    assert all(by[k] == 100 for k in range(101, 161)) and all(by[k] == 7 for k in range(200, 260)) and by[900] == 7
    assert 3 not in by
    assert components.components(spark.createDataFrame([], "u long, v long"))[0].count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_match_plain_version(spark, docs, near_set, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", block * 1024)
    rows = near_set if block == 4 else near_set + [(1000 + i, t) for i, t in zip(docs.doc_id.tolist(), docs.text)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    expected = brute.near_components(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found) and len(found) == len(rows)


def test_near_duplicate_edges(edge, none):
    found = neardup.near_duplicates(edge).collect()
    assert len(found) == len(EDGE)
    by = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by[1]["component_id"] == 1 and by[2]["component_id"] == 2 and by[2]["n_shingles"] == 0
    assert by[4]["n_shingles"] == 1 and by[6]["component_id"] == by[7]["component_id"] == by[8]["component_id"] == 5
    assert by[14]["component_id"] == 13  # one distinct shingle each, the same
    # a row without an id is judged by its text: a copy of document 5, and a text without words
    assert sorted((r["n_shingles"], r["component_id"], r["kept"]) for r in found if r["doc_id"] is None) == [
        (0, None, True), (by[5]["n_shingles"], 5, False)]
    assert neardup.near_duplicates(none).count() == 0
    kept = neardup.one_of_each(edge)
    assert kept.columns == edge.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in EDGE} - {6, 7, 8, 14}
    assert [r["text"] for r in rows if r["doc_id"] is None] == [None]


A, B = prose(150, 61), prose(150, 62)


@pytest.mark.parametrize("kind", ["long", "int"])
def test_rows_that_share_an_id_are_told_apart(spark, kind):
    """A unique text stays whatever id it has, copies go whatever id they have, int ids are ids."""
    def left(rows):
        df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
        return [sorted(map(tuple, f(df).collect()), key=str) for f in (neardup.one_of_each, substrings.remove_repeats)]

    if kind == "int":
        assert left([(1, A), (2, A), (4, B)]) == [[(1, A), (4, B)]] * 2
    else:
        C = prose(150, 63)
        found = left([(3, B), (7, A), (7, B), (None, C)] + [(8, C)] * 30)
        assert [[r for r in x if r[1] != C] for x in found] == [[(3, B), (7, A)]] * 2
        assert [sum(r[1] == C for r in x) for x in found] == [1, 1]


def test_repeated_rows_stay_linear(spark, monkeypatch):
    """One near copy of a row that stands 10,000 times: the buckets hold two classes, and one row stays."""
    near = A.replace(A.split()[70], "changed", 1)
    df = spark.createDataFrame([(1, near)], "doc_id long, text string").union(
        spark.range(10_000).selectExpr("5L AS doc_id", f"'{A}' AS text")).repartition(4)
    sizes = {}
    plain = neardup.staged

    def counting(frame, name):
        out = plain(frame, name)
        sizes[name] = out[0].count()
        return out

    monkeypatch.setattr(neardup, "staged", counting)
    assert [r["doc_id"] for r in neardup.one_of_each(df).collect()] == [1]
    assert sizes["near-leaders"] == 2 and sizes["near-members"] <= 2 * neardup.BANDS and sizes["near-pairs"] <= 1


def thue_morse(n):
    text = "a"
    for _ in range(n):
        text += text.translate(str.maketrans("ab", "ba"))
    return text


def test_long_words_built_by_doubling_are_told_apart(spark):
    for n in (8, 9, 10, 11, 12, 21):
        x = thue_morse(n)
        y = x.translate(str.maketrans("ab", "ba"))
        h = hashing.word_hashes(np.frombuffer(f"{x} {y} {x}".encode(), dtype=np.uint8))
        assert len(h) == 3 and h[0] == h[2] != h[1]
    x, rest = thue_morse(10), prose(60, 5)
    y = x.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, x), (4, y)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substrings.deduplicate(docs, digest_only=True).collect()} == {1: 0, 2: 60, 3: 0, 4: 0}
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


# -- 8: packing ----------------------------------------------------------------------

def check_packing(rows, length, texts):
    encode = packing.load_encoder(packing.default_tokenizer())
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], {})[r["piece"]] = r
    for doc, text in texts:
        if doc is None:
            continue
        ids = np.append(encode(text or ""), np.uint32(0)).astype("<u4")
        pieces = [by_doc[doc][k] for k in sorted(by_doc[doc])]
        assert [(p["start"], p["length"]) for p in pieces] == packing.cut(len(ids), length)
        for p in pieces:
            own = ids[p["start"]:p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(own.tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences), sum(r["length"] for r in rows)


def test_packing_round_trip(spark, docs, edge, none):
    rows = packing.pack(spark.createDataFrame(docs).repartition(4)).collect()
    n, total = check_packing(rows, 2048, zip(docs.doc_id.tolist(), docs.text))
    assert n <= 1 + 1.005 * total / 2048
    found = packing.pack(edge, length=64, with_ids=True).collect()
    check_packing(found, 64, EDGE)
    assert all(len(r["ids"]) == r["length"] for r in found)
    assert len([r for r in found if r["doc_id"] == 1]) == 1 and packing.pack(none).count() == 0


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = np.zeros(65, dtype=np.int64)
        np.add.at(counts, rng.integers(1, 65, 300), rng.integers(1, 50, 300))
        used = np.zeros(65, dtype=np.int64)
        plan = packing.packing_plan(counts, 64)
        for chosen, times in plan:
            assert sum(chosen) <= 64 and times > 0 and chosen == sorted(chosen, reverse=True)
            np.add.at(used, chosen, times)
        assert (used == counts).all()
        assert sum(t for _, t in plan) <= 1 + 1.02 * (counts * np.arange(65)).sum() / 64 + counts[33:].sum()
    # the smallest piece gives way to two that fill the gap better
    counts = np.zeros(11, dtype=np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]
    assert packing.packing_plan(counts, 10)[0] == ([6, 2, 2], 1)


def plain_two_fit(lengths, room):
    """Best-two-fit one sequence after the other, by trying every piece and every pair."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        own = []
        for x in list(left):
            if sum(own) + x <= room:
                own.append(x)
                left.remove(x)
        gap = room - sum(own)
        if gap and len(own) > 1:
            pairs = [(left[i] + left[j], left[i], left[j]) for i in range(len(left)) for j in range(i + 1, len(left))
                     if left[i] + left[j] <= gap + own[-1]]
            best = max(pairs, default=(0, 0, 0))
            if best[0] > own[-1]:
                left.append(own.pop())
                for x in best[1:]:
                    left.remove(x)
                    own.append(x)
                left.sort(reverse=True)
        out.append(sorted(own, reverse=True))
    return sorted(out)


@pytest.mark.parametrize("seed", range(40))
def test_plan_packs_as_sequence_after_sequence(seed):
    rng = random.Random(seed)
    room = rng.choice([7, 12, 20, 33, 64])
    lengths = [min(room, 1 + int(rng.expovariate(rng.choice([0.1, 0.3])))) for _ in range(rng.choice([1, 5, 40, 150]))]
    lengths += [rng.randint(1, room)] * rng.choice([0, 30])
    plan = packing.packing_plan(np.bincount(lengths, minlength=room + 1), room)
    assert sorted(sorted(chosen, reverse=True) for chosen, times in plan for _ in range(times)) == plain_two_fit(lengths, room)


def test_offsets_of_partitions_are_not_broadcast(spark):
    found = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    found.count()  # the plan after Spark saw how small the offsets are
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_encoder_equals_the_tokenizer_file(docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    encode = packing.load_encoder(packing.default_tokenizer())
    odd = ["<|endoftext|> a <|endoftext|>", "a b c\r\n\r\n  d", "١٢٣ x² ½", "漢字かな😀👩‍👩‍👧", "don't I'LL we've 's", "\x00\x1f\x85"]
    for text in [*docs.text, *odd]:
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_a_seeds_powers_are_made_once(monkeypatch):
    """Window hashes at some places are those of all windows, and texts of one size share the seed's powers."""
    from revisor.llm import hashing

    made = []
    real = hashing.powers
    hashing._kept_powers.cache_clear()
    monkeypatch.setattr(hashing, "powers", lambda base, n: made.append(n) or real(base, n))
    rng = np.random.default_rng(5)
    for n in (49, 50, 300, 800, 301):
        words = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        every = hashing.windows(words, 20, seed=3)
        at = np.array([0, 7, n - 20])
        assert (hashing.windows(words, 20, seed=3, at=at) == every[at]).all()
        assert list(substrings.anchors(words)[0]) == [i for i in range(n - 19) if i % substrings.PERIOD in substrings.COVER]
    assert len(made) == 2
    monkeypatch.setattr(hashing, "KEPT_POWERS", 100)
    assert (hashing.windows(words, 20, seed=3) == every).all() and len(made) == 4
