"""Operators 2, 4, 5, 7, 9, 10 and the pipeline against plain versions, and their defined cases."""

import gzip
import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from edge_rows import EDGE, LONG, edge, none, prose  # noqa: F401
from pyspark.sql import functions as F
from test_llm_texts import check_packing

import corpus_pipeline
from revisor.llm import decontaminate, langid, licenses, packing, queries, rollups, urlfilter, warc
from revisor.session import stage_dir

SF = "/root/testdata/sf0.001"

# -- 2: urls ---------------------------------------------------------------------------

URLS = [
    "http://www.example.com/en/1", "https://EXAMPLE.com/en/x?y#z", "https://m.example.com/EN/", "http://a.net/es/1", "http://net/fr/",
    "http://net", "ftp://x.org/a", "no scheme", "", None, "https://com", "https://com/", "http://b.example.com/en",
    "http://notexample.com/en/", "a://b.net?x/es/", "http://.net/es/", "http://x..net/fr/1", "://h.com/p", "http://É.net/es/é",
]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = rest
    for c in "/?#":
        raw = raw.split(c, 1)[0]
    path = rest[len(raw):]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = raw.translate(brute.FOLD)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules, **more):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    df = df.withColumn("verdict", F.lit("clash")).repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(df, table, **more).collect()}


def test_urls_match_plain_version(spark):
    found = judged(spark, URLS, queries.URL_RULES)
    assert found == {i: plain_verdict(u, queries.URL_RULES) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("shard", [16_000_000, 40])
def test_cascade_is_exact_when_its_levels_are_crowded(spark, shard, monkeypatch):
    monkeypatch.setattr("revisor.llm.common.bloom_bits", lambda count, max_bits=0: 64 if count < 200 else 128)
    rng = random.Random(4)
    hosts = [f"h{k}.z{k % 7}.org" for k in range(300)]
    urls = [f"http://{rng.choice(['', 'www.'])}{h}/{rng.choice('abc')}/{k}" for k, h in enumerate(hosts)]
    rules = [(h if k % 3 else h.split(".", 1)[1], f"/{rng.choice('abc')}/", rng.choice(["allow", "block"])) for k, h in
             enumerate(rng.sample(hosts, 100))]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    assert judged(spark, urls, rules, max_shard_keys=shard) == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_url_edges(spark):
    assert judged(spark, [], queries.URL_RULES) == {}
    assert judged(spark, URLS, []) == {i: plain_verdict(u, []) for i, u in enumerate(URLS)}
    both = [("com", "/", "allow"), ("com", "/", "block"), ("com", "/", "block")]
    assert judged(spark, ["http://a.com/"], both)[0] == ("a.com", "/", "com/", "block")


# -- 4: decontamination -------------------------------------------------------------------

def damaged(words, edits, rng):
    w = list(words)
    for _ in range(edits):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = f"x{rng.randrange(10**6)}"
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, f"y{rng.randrange(10**6)}")
    return w


def test_recall_over_all_allowed_distances(spark):
    rng = random.Random(9)
    items = [(k, prose(rng.randint(15, 60), 300 + k)) for k in range(40)]
    rows, truth = [], set()
    for n in range(400):
        k, text = rng.choice(items)
        edits = rng.randint(0, decontaminate.allowed_edits(len(text.split())))
        rows.append((n, " ".join(prose(rng.randint(0, 60), n).split() + damaged(text.split(), edits, rng) + prose(30, n + 7).split())))
    for n, text in rows:
        words = brute.words(text)
        for k, item in items:
            w = brute.words(item)
            if brute.best_window_distance(w, words) <= decontaminate.allowed_edits(len(w)):
                truth.add((n, k))
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert pairs <= truth and len(pairs) >= 0.97 * len(truth) and len(pairs) == len(found)
    for r in found[:60]:
        words, item = brute.words(rows[r["doc_id"]][1]), brute.words(items[r["item_id"]][1])
        own = words[r["first_word"]:r["first_word"] + r["n_words"]]
        assert brute.edit_distance(item, own) == r["distance"] == brute.best_window_distance(item, words)


@pytest.mark.parametrize("size", [100, 250, 500, 1000, 2000])
def test_recall_of_long_items(size):
    """Texts at the largest allowed distance, which shorter walks than the whole item's have to find."""
    rng = random.Random(size)
    items = [[f"w{rng.randrange(3000)}" for _ in range(size)] for _ in range(12)]
    index = decontaminate.ItemIndex([(k, decontaminate.item_words(" ".join(w))) for k, w in enumerate(items)])
    allowed = decontaminate.allowed_edits(size)
    texts = [decontaminate.item_words(" ".join(prose(40, k).split() + damaged(w, allowed, rng) + prose(40, k + 50).split()))
             for k, w in enumerate(items)]
    found = {(t, k): (distance, start, end) for t, k, distance, start, end in index.search(texts)}
    assert set(found) == {(k, k) for k in range(len(items))}
    for (t, k), (distance, start, end) in found.items():
        assert distance <= allowed and end <= len(texts[t]) and abs(end - start - size) <= allowed


def test_decontamination_on_the_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    words = {r["item_id"]: brute.words(r["text"]) for r in items.collect()}
    truth = {(r["doc_id"], k) for r in docs.collect() for own in [brute.words(r["text"])] for k, w in words.items()
             if set(w) & set(own) and brute.best_window_distance(w, own) <= decontaminate.allowed_edits(len(w))}
    assert found <= truth and len(found) >= 0.9 * len(truth) and truth
    parts = decontaminate.leaks(docs, items, max_words=300)
    assert {(r["doc_id"], r["item_id"]) for r in parts.collect()} == found


def test_decontamination_edges(spark, edge, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (4, " ".join(LONG.split()[50:70])), (4, "one two")],
                                  "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(edge, items).collect()}
    assert found == {(4, 3), (4, 4), *[(k, 4) for k in (5, 6, 7, 8, 9, None)]}
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(edge, items.limit(0)).count() == 0
    kept = decontaminate.clean(edge, items)
    assert kept.columns == edge.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in EDGE} - {4, 5, 6, 7, 8, 9}
    assert [r["text"] for r in rows if r["doc_id"] is None] == [None]  # the other one holds item 4


def test_words_that_many_items_share_cost_little():
    """1,000 items hold three words at many offsets and a text repeats them: few of its windows differ."""
    import time

    rng = random.Random(8)
    items = []
    for k in range(1000):
        w = prose(40, 900 + k).split()
        at = rng.randrange(37)
        w[at:at + 3] = ["which", "of", "the"]
        items.append((k, decontaminate.item_words(" ".join(w))))
    index = decontaminate.ItemIndex(items)
    text = decontaminate.item_words("which of the " * 1000)
    held = decontaminate.item_words("which of the " * 500 + prose(40, 900) + " which of the" * 300 + " " + prose(40, 903))
    index.search([text[:300]])
    started = time.time()
    assert index.search([text]) == []
    assert time.time() - started < 3
    assert len(index._windows([text])[0]) > 20 * len(np.unique(index._windows([text])[3]))
    assert {k for _, k, *_ in index.search([held])} == {0, 3}


def test_each_row_is_decontaminated_by_its_own_text(spark):
    """Rows that share an id, or have none, and int ids."""
    item = prose(30, 71)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, prose(40, 72)), (2, item), (2, prose(40, 73)), (None, item), (None, prose(40, 74)), (3, "x " + item)]
    clean = [(i, t) for i, t in rows if item not in t]
    for kind in ("long", "int"):
        df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
        assert sorted(map(tuple, decontaminate.clean(df, items).collect()), key=str) == sorted(clean, key=str)


# -- 5: licences -------------------------------------------------------------------------------

LICENSED = [
    (100, "x Licensed under the Apache License, Version 2.0. y"), (101, "GNU General Public License MIT license cc by"),
    (102, "This work is licensed under the GNU General Public License, version 3."), (103, "Licensed under CC BY-NC 4.0."),
    (104, "Released under the MIT License. mit license"), (105, "licensed under the apache licence version 2 0"),
    (106, "permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (107, "mit mit license license gnu general public licensed"), (108, "ccby cc-by CC\nBY ccc by"), (109, "apachexlicense apache license"),
    (110, "Apache License Version 2.0 alone"),
    # the rarest words of the notice are altered, its key phrases whole
    (111, "permission to use kopy modify und or distribute this software for eny purpose with or without fee is hereby granted"),
    (112, "to the extent possible under law the auther has waived oll copyright"),
    (113, "to the extent possible under law the author has waived"), (114, "the author has waived all copyright"),
]


def plain_license(text, weights):
    words = brute.LICENSE_WORD.findall((text or "").translate(brute.FOLD))
    found = {}
    for label, body, phrases in licenses.TEMPLATES:
        body = body.split()
        places = [(f" {' '.join(body)} ".index(f" {ph} "), ph.split()) for ph in phrases]
        places = [(len(" ".join(body)[:at].split()), p) for at, p in places]
        for s in range(-len(body), len(words)):  # every start
            must = all(s + at >= 0 and words[s + at:s + at + len(p)] == p for at, p in places)
            if not must:
                continue
            share = sum(weights[b] for k, b in enumerate(body) if 0 <= s + k < len(words) and words[s + k] == b)
            share /= sum(weights[b] for b in body)
            if share >= licenses.MIN_SHARE:
                found[label] = max(found.get(label, 0), share)
    return found


def test_licenses_match_plain_version(spark, edge, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame(LICENSED, "doc_id long, text string").selectExpr("doc_id + 100000 AS doc_id", "text")
    rows = docs.unionByName(extra).unionByName(edge.select("doc_id", "text"))
    out = licenses.scan(rows.repartition(4)).collect()
    texts = [(r["doc_id"], r["text"]) for r in rows.collect()]
    vocab, total = licenses.vocabulary(), len(texts)
    holds = [set(brute.LICENSE_WORD.findall((t or "").translate(brute.FOLD))) for _, t in texts]
    weights = {w: licenses.idf(sum(w in h for h in holds), total) for w in vocab}
    expected = []
    for i, t in texts:
        n, places = brute.base_places(t, licenses.BASE_PHRASES)
        own = plain_license(t, weights)
        base = {label for _, label in places}
        expected.append((i, n, len(places), places[0][0] if places else None, places[-1][0] if places else None,
                         ",".join(sorted(base)), ",".join(sorted(base | set(own))), round(max(own.values(), default=0.0), 9)))
    found = [tuple(r)[:7] + (round(min(r["score"], 1.0), 9),) for r in out]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(found, key=order) == sorted(expected, key=order)
    by = {r["doc_id"]: r for r in out}
    assert by[100_100]["labels"] == "apache,apache-2.0" and by[100_102]["labels"] == "gpl,gpl-3.0"
    assert by[100_103]["labels"] == "cc-by,cc-by-nc-4.0" and by[100_105]["labels"] == "" and by[100_101]["n_base"] == 3
    assert by[100_111]["labels"] == "isc-text" and by[100_112]["labels"] == by[100_113]["labels"] == "cc0-1.0" and not by[100_114]["labels"]
    assert by[100_104]["n_base"] == 2 and by[100_110]["base_labels"] == "apache"
    assert licenses.scan(none).count() == 0
    assert "Python" not in licenses.scan(rows, frequencies=(dict.fromkeys(vocab, 1), 10))._jdf.queryExecution().toString()


# -- 7: WARC ---------------------------------------------------------------------------------------

BIG = "<p>" + "ä" * 200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>"
PAGES = [
    (5, "http://a/1", BIG), (3, "http://a/2", BIG), (9, None, BIG), (None, "http://a/3", BIG), (4, "http://x\r\ny/", "short"),
    (1, "u", "short"), (2, "", ""), (6, "http://b", None), (7, "v", "z" * 100), (8, "w", "z" * 100), (8, "w", "z" * 100),
    (10, "v", "y" * 99), (11, "v", "y" * 99), (12, "l", "long " * 500_000),
]


def plain_pages(pages):
    first = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out, answered = [], set()
    for i, _, html in pages:
        data = (html or "").encode()
        own = data not in first or (first[data] == i and data not in answered)
        if own and data in first:
            answered.add(data)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if own else "revisit", None if own else first[data]))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).coalesce(2)
    for compression in ("gzip", "none"):
        path = warc.write_archive(df, compression=compression)
        found = [tuple(r) for r in warc.page_captures(warc.assemble(warc.read_records(spark, path))).collect()]
        assert sorted(found, key=str) == plain_pages(PAGES)
    captures = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(captures) == len(PAGES)
    payloads = sorted(bytes(c["response"]["payload"]).decode() for c in captures if c["response"]["type"] == "response")
    assert BIG in payloads and "" in payloads and "long " * 500_000 in payloads
    assert all(c["request"]["http"].startswith("GET ") and c["metadata"]["payload_digest"] for c in captures)
    empty = warc.write_archive(df.limit(0))
    assert warc.page_captures(warc.assemble(warc.read_records(spark, empty))).count() == 0


def test_metadata_that_disagree_with_a_payload_are_an_error(spark):
    """A response whose payload was changed in the archive, and a revisit of it."""
    pages = [(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200)]
    path = warc.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1))
    records = warc.read_records(spark, path)
    assert {r["refers_to"] for r in warc.page_captures(warc.assemble(records)).collect()} == {None, 1}
    changed = records.withColumn("payload", F.when(F.col("type") == "response", F.encode(F.lit("y" * 200), "utf-8")))
    with pytest.raises(Exception, match="disagree with its payload"):
        warc.page_captures(warc.assemble(changed)).collect()
    lost = records.filter("type != 'response' OR concurrent_to IS NOT NULL")
    assert {r["payload_bytes"] for r in warc.page_captures(warc.assemble(lost)).collect()} == {200}


def test_parser_reads_members_by_record_and_rejects_cut_files():
    one = lambda n: (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{n}>\r\nContent-Length: {n}\r\n\r\n"
                     + "b" * n + "\r\n\r\n").encode()
    data = b"".join(gzip.compress(one(n)) for n in (0, 7, 70_000))
    assert [len(r[8]) for r in warc.parse(memoryview(data))] == [0, 7, 70_000]
    with pytest.raises(ValueError):
        list(warc.parse(memoryview(one(9)[:-6])))


def test_incomplete_transactions_still_give_a_row(spark):
    path = warc.write_archive(spark.createDataFrame(PAGES[:1], "page_id long, url string, html string"))
    records = warc.read_records(spark, path).filter("type != 'request'")
    row = warc.assemble(records).collect()
    assert len(row) == 1 and row[0]["request"]["record_id"] is None and row[0]["response"]["payload_bytes"] == len(BIG.encode())


# -- 9: rollups -------------------------------------------------------------------------------------

def side_of(source, lang, version, tokens):
    return (source, lang, version, tokens)


def test_rollup_deltas_replays_and_compaction(spark):
    schema = f"before {rollups.SIDE}, after {rollups.SIDE}"
    rng = random.Random(3)
    path = stage_dir(spark, "rollup-test")
    rollup, state, step = rollups.Rollup(spark, path), {}, 0
    assert rollup.totals().count() == 0
    for batch in range(5):
        changes = []
        for _ in range(40):
            step += 1
            old_id = rng.choice([*state, None])
            new = side_of(rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]), rng.randint(0, 50))
            if old_id is None or rng.random() < 0.4:
                changes.append((None, new))
                state[step] = new
            elif rng.random() < 0.5:
                changes.append((state.pop(old_id), None))
            else:
                changes.append((state[old_id], new))
                state[old_id] = new
        df = spark.createDataFrame(changes, schema)
        assert rollup.apply(f"b{batch}", df) and not rollup.apply(f"b{batch}", df)
        if batch in (1, 3):
            rollup.compact()
            assert not rollup.apply("b0", df)
        expected = {}
        for s, lang, v, n in state.values():
            d, t = expected.get((s, lang, v), (0, 0))
            expected[s, lang, v] = (d + 1, t + n)
        found = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}
        assert found == expected
    assert rollup.apply("empty", spark.createDataFrame([], schema)) and rollup.committed("empty")


def test_compaction_cut_off_before_its_deletes(spark, monkeypatch):
    """Folders of folded batches that stayed behind count once, and the next compaction removes them."""
    path = stage_dir(spark, "rollup-cut")
    rollup = rollups.Rollup(spark, path)
    change = spark.createDataFrame([(None, side_of("a", "en", "v", 5))], f"before {rollups.SIDE}, after {rollups.SIDE}")
    assert rollup.apply("one", change) and rollup.apply("two", change)

    class NoDelete:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "delete":
                raise OSError("cut off")
            return getattr(self.fs, name)

    real = rollups.Rollup._fs
    monkeypatch.setattr(rollups.Rollup, "_fs", lambda self, p: (NoDelete(real(self, p)[0]), real(self, p)[1]))
    with pytest.raises(OSError, match="cut off"):
        rollup.compact()
    monkeypatch.undo()
    assert rollup._folders("batch=") == ["one", "two"] and rollup.apply("three", change) and not rollup.apply("one", change)
    total = lambda: [(r["documents"], r["tokens"]) for r in rollup.totals().collect()]
    assert total() == [(3, 15)]
    rollup.compact()
    assert total() == [(3, 15)] and rollup._folders("batch=") == []
    assert not any(rollup.apply(b, change) for b in ("one", "two", "three"))


def test_token_counts_of_odd_rows(spark, edge, none):
    import public_tokenizers
    import tokenizers

    counted = rollups.count_tokens(edge, {"v1": public_tokenizers.path("byte_bpe_50k.tiktoken")}).collect()
    exact = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted((str(i), len(exact.encode(t or "", add_special_tokens=False).ids)) for i, t in EDGE)
    assert sorted((str(r["doc_id"]), r["n_v1"]) for r in counted) == expected
    assert {r["lang"] for r in counted} == {"en"}
    assert rollups.count_tokens(none, {"v1": public_tokenizers.path("byte_bpe_50k.tiktoken")}).count() == 0


def test_rollup_ignores_a_batch_without_its_mark(spark):
    path = stage_dir(spark, "rollup-test")
    rollup = rollups.Rollup(spark, path)
    df = spark.createDataFrame([(None, side_of("a", "en", "v", 5))], f"before {rollups.SIDE}, after {rollups.SIDE}")
    rollup.apply("one", df)
    fs, mark = rollup._fs(f"{rollup._folder('one')}/_SUCCESS")
    fs.delete(mark, False)
    assert rollup.totals().count() == 0 and rollup.apply("one", df) and rollup.totals().first()["tokens"] == 5
    rollup.apply("none", spark.createDataFrame([(None, None), (None, (None, None, None, None))], df.schema))
    assert {r["documents"] for r in rollup.totals().collect()} == {1}
    with pytest.raises(ValueError):
        rollup.apply("../x", df)


def test_rollup_query_matches_plain_version(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"])
             for r in queries.op9_token_rollup(spark, SF).collect()}
    import base64

    import tiktoken
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
    encode = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    seen, expected = set(), {}
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        if r["text"] not in seen:
            seen.add(r["text"])
            key = (r["source"], r["lang"], "byte_bpe_multi")
            d, t = expected.get(key, (0, 0))
            expected[key] = (d + 1, t + len(encode(r["text"])))
    assert found == expected
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counted = rollups.count_tokens(spark.createDataFrame(docs), {"a": public_tokenizers.path("byte_bpe_50k.tiktoken")}).collect()
    text = {r["doc_id"]: r["text"] for r in docs}
    assert all(r["n_a"] == len(exact.encode(text[r["doc_id"]], add_special_tokens=False).ids) for r in counted)


# -- 10: language ------------------------------------------------------------------------------------

def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    found = langid.identify(docs, model).withColumn("held_out", langid.held_out(F.col("doc_id"))).join(
        docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in found) / len(found) < 0.01 and all(0 <= r["score"] <= 1 for r in found)
    again = langid.identify(docs, langid.train(docs.repartition(5))).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in again} == {(r["doc_id"], r["lang_pred"]) for r in found}


def test_every_language_is_learned(spark):
    """More labels than any bound on classes; the rarest are learned like the others."""
    rng = random.Random(3)
    vocabulary = {f"l{k}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for k in range(230)}
    rows = [(lang, " ".join(rng.choice(own) for _ in range(20)))
            for k, (lang, own) in enumerate(vocabulary.items()) for _ in range(60 if k < 200 else 30)]
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, lang string, text string")
    model = langid.train(docs)
    assert model.languages == sorted(vocabulary)
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    right = [(lang, found[i]["lang_pred"] == lang and not found[i]["rejected"]) for i, (lang, _) in enumerate(rows)]
    rare = [ok for lang, ok in right if int(lang[1:]) >= 200]
    assert sum(ok for _, ok in right) >= 0.97 * len(right) and sum(rare) >= 0.97 * len(rare)


def invented_languages(n, each, seed=5, words=12):
    rng = random.Random(seed)
    vocabulary = {f"l{k:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(words)] for k in range(n)}
    return [(lang, " ".join(rng.choice(own) for _ in range(20))) for lang, own in vocabulary.items() for _ in range(each)]


@pytest.mark.parametrize("n", [15, 16, 17, 33])
def test_the_model_has_one_form_for_any_number_of_labels(spark, n):
    rows = invented_languages(n, 60)
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, lang string, text string")
    model = langid.train(docs)
    assert model.table.shape == (2 * langid.BUCKETS, langid.DIMENSIONS) and model.weight.shape == (langid.DIMENSIONS, n)
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100 and sum(found[i] == rows[i][0] for i in held) >= 0.97 * len(held)


def test_a_text_is_learned_whole():
    """The words that tell the languages apart stand at the end of long texts."""
    rng = random.Random(8)
    noise = [prose(1500, 100 + k) for k in range(40)]
    texts = [(k % 2, f"{rng.choice(noise)} {('qqxz jjvk ' if k % 2 else 'wwpf bbhd ') * 300}") for k in range(200)]
    pairs = [langid.gram_shares(np.frombuffer(t.encode(), dtype=np.uint8)) for _, t in texts]
    for (_, text), (rows, shares) in zip(texts[:5], pairs):
        flat = langid.grams(np.frombuffer(text.encode(), dtype=np.uint8))
        assert np.array_equal(rows, np.unique(flat)) and abs(float(shares.sum()) - 1) < 1e-4
    model = langid.fit(["a", "b"], np.array([label for label, _ in texts]), pairs)
    right = [model.predict(np.frombuffer(t.encode(), dtype=np.uint8))[0] == "ab"[label] for label, t in texts]
    assert sum(right) >= 0.97 * len(right)


def test_gram_shares_of_a_very_long_text():
    data = np.frombuffer(("abcd efg " * 300_000).encode(), dtype=np.uint8)
    rows, shares = langid.gram_shares(data)
    whole = np.bincount(langid.grams(data), minlength=2 * langid.BUCKETS) / len(langid.grams(data))
    assert np.allclose(shares, whole[rows], atol=1e-5) and shares.dtype == np.float32
    empty, none_of_it = langid.gram_shares(np.zeros(0, dtype=np.uint8))
    assert len(empty) == len(none_of_it)


def test_the_sample_follows_rows_and_not_their_order(spark):
    """One id and text that holds most rows is drawn once; the order of the rows changes nothing."""
    rows = invented_languages(3, 400)
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, lang string, text string")
    hot = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("l000").alias("lang"), F.lit("zzz yyy").alias("text"))
    several = docs.unionByName(hot)
    counts = several.groupBy("lang").agg(F.approx_count_distinct(langid._own()).alias("n"), F.lit(100.0).alias("bytes")).collect()
    picked = [{(r["own"], r["lang"]) for r in langid.drawn(d, counts, 300, 1 << 20).collect()} for d in (several, several.repartition(7))]
    assert picked[0] == picked[1]
    by = {lang: sum(1 for _, x in picked[0] if x == lang) for lang in ("l000", "l001", "l002")}
    assert all(60 <= n <= 150 for n in by.values())
    fewer = langid.drawn(several, counts, 300, 3 * 50 * 100).count()
    assert fewer < 0.75 * len(picked[0])


def test_a_column_that_holds_no_languages_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LABELS", 20)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="more than 20 labels"):
        langid.train(docs)


def test_language_edges(spark, edge, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    rows = langid.identify(edge, model).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == len(EDGE) and all(by[k]["lang_pred"] == "und" and by[k]["rejected"] and by[k]["score"] == 0 for k in (1, 2, 3, 15))
    assert by[10]["lang_pred"] in model.languages
    kept = langid.accepted(edge, model)
    assert kept.columns == edge.columns and not {1, 2, 3, 15} & {r["doc_id"] for r in kept.collect()}
    assert langid.identify(none, model).count() == 0
    empty = langid.train(none)
    assert {r["lang_pred"] for r in langid.identify(edge, empty).collect()} == {"und"}
    unlabelled = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.languages == []
    single = langid.train(docs.withColumn("lang", F.lit("en")))
    assert langid.identify(docs, single).filter("lang_pred != 'en'").count() == 0


def test_long_text_is_read_whole():
    letter = lambda t: langid.has_letter(np.frombuffer(t.encode(), dtype=np.uint8))
    assert letter("1 2 ъ") and letter("1a") and not letter("1 2 ²½😀_")
    model = langid.LanguageModel(["a", "b"], np.zeros((2 * langid.BUCKETS, 2), np.float32), np.zeros(2), 1.0, 0.0)
    model.table[langid.grams(np.frombuffer(b"zzzz", dtype=np.uint8)), 1] = 1.0
    data = np.frombuffer(b"q" * 1_100_000 + b"zzzz" * 400_000, dtype=np.uint8)
    lang, score, _ = model.predict(data)
    whole = model.table[langid.grams(data)].mean(axis=0, dtype=np.float64)
    assert lang == "b" and abs(score - 1 / (1 + np.exp(whole[0] - whole[1]))) < 1e-3


# -- pipeline ---------------------------------------------------------------------------------------

def plain_pipeline(spark, rows):
    """(doc_id, text) that reach the last stage; the language model is the operator's own."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.train(docs)
    kept = {r[0]: r[1] for r in rows if not model.predict(
        None if r[1] is None else np.frombuffer(r[1].encode(), dtype=np.uint8))[2]}
    near = brute.near_components(sorted(kept.items()))
    kept = {i: t for i, t in kept.items() if near[i][1] == i}
    own = {i: brute.words(t, fold=False) for i, t in kept.items()}
    first = {}
    for i in sorted(own):
        for p in range(len(own[i]) - 49):
            first.setdefault(tuple(own[i][p:p + 50]), i)
    cut = {}
    for i, w in own.items():
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p:p + 50])] < i:
                gone[p:p + 50] = [True] * 50
        text = kept[i] if not any(gone) else " ".join(x for x, g in zip(w, gone) if not g)
        if not any(gone) or text:
            cut[i] = text
    items = [brute.words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return {i: t for i, t in cut.items() if not any(
        set(m) & set(w) and brute.best_window_distance(m, w) <= decontaminate.allowed_edits(len(m))
        for w in [brute.words(t)] for m in items)}


def test_pipeline_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = corpus_pipeline.run(spark, SF).collect()
    expected = plain_pipeline(spark, rows)
    assert {r["doc_id"] for r in found} == set(expected)
    check_packing(found, packing.SEQUENCE_TOKENS, expected.items())


def test_stages_keep_columns_and_take_edge_rows(spark, edge, none):
    assert len(corpus_pipeline.STAGES) == 5
    for rows in (edge, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and [k for _, k in out.dtypes] == [k for _, k in docs.dtypes]
            docs = out
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
