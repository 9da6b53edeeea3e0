"""Page-prefix rule: named cases and a brute-force loop over the benchmark
conversations."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from revisor.schemas import PAGE_SCHEMA
from revisor.sources import pages as P
from revisor.sources import tables

from conftest import SF01


def _review(i):
    return (None, None, f"r{i}", None, 1, "5", None, f"text {i}", None)


def _page(product, p, ok=True, reviews=True, token=True, fetch=None, app="app"):
    token = f"t{p}" if token is True else token or None
    return (app, "pf", product, p, ok, [_review(p)] if reviews else None, token, fetch)


def _kept(spark, rows, cap=None):
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    return sorted((r["product_id"], r["page_no"]) for r in P.kept_pages(df, cap).collect())


def test_cases(spark):
    rows = []
    rows += [_page("chain", p) for p in range(3)] + [_page("chain", 3, token=False)]
    rows += [_page("first_only", 0, token=False), _page("first_only", 1)]
    rows += [_page("long", p) for p in range(15)]
    rows += [_page("fail2", 0), _page("fail2", 1), _page("fail2", 2, ok=False), _page("fail2", 3)]
    rows += [_page("missing", 0), _page("missing", 1, reviews=False), _page("missing", 2)]
    rows += [_page("late_missing", 0, token=False), _page("late_missing", 1, reviews=False)]
    rows += [_page("gap", 0), _page("gap", 2)]
    got = _kept(spark, rows)
    expect = ([("chain", p) for p in range(4)] + [("first_only", 0)] + [("long", p) for p in range(15)]
              + [("fail2", 0), ("fail2", 1)] + [("late_missing", 0)] + [("gap", 0)])
    assert got == sorted(expect)
    assert _kept(spark, [_page("long", p) for p in range(15)], cap=3) == [("long", p) for p in range(3)]
    fails = {(r["product_id"], r["kind"]) for r in P.fetch_failures(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert fails == {("fail2", P.FAILED_REQUEST), ("missing", P.MISSING_REVIEWS)}


def _loop(pages, cap):
    """The paging loop, written plainly."""
    by_product = {}
    for r in pages:
        by_product.setdefault(r["product_id"], {})[r["page_no"]] = r
    kept = []
    for prod, pg in by_product.items():
        got, p = [], 0
        failed = False
        while cap is None or p < cap:
            r = pg.get(p)
            if r is None:
                break
            if not r["request_ok"]:
                break
            if r["review_text"] is None:
                failed = True
                break
            got.append(p)
            if r["next_page_token"] is None:
                break
            p += 1
        if not failed:
            kept += [(prod, x) for x in got]
    return sorted(kept)


def test_against_loop(spark):
    conv = tables.table(spark, SF01, "conversations")
    flat = tables.raw_pages_from_conversations(conv)
    rows = flat.collect()
    for cap in (None, 3):
        ours = P.kept_pages(flat.withColumn("product_id", F.col("product_id")), cap, reviews_col="review_text")
        got = sorted((r["product_id"], r["page_no"]) for r in ours.collect())
        assert got == _loop(rows, cap)
        assert len({p for p, _ in got}) == 89
    assert len(_loop(rows, None)) == 266 and len(_loop(rows, 3)) == 212


def test_page_reviews_and_empty(spark):
    rows = [_page("a", 0, token=False), _page("b", 0, ok=False)]
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    reviews = P.page_reviews(P.kept_pages(df))
    assert [r["id"] for r in reviews.collect()] == ["r0"]
    requested = df.select("app", "type_client", "product_id")
    empty = P.empty_groups(requested, reviews, ["app", "type_client", "product_id"])
    assert [r["product_id"] for r in empty.collect()] == ["b"]


def _statuses(spark, rows, cap=None):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, PAGE_SCHEMA)
    found = P.page_status(df, cap).collect()
    assert len(found) == df.count()  # every landed page has one status
    return sorted((r["product_id"] or "", r["fetch_id"] or "", -1 if r["page_no"] is None else r["page_no"], r["status"])
                  for r in found)


def test_every_page_has_a_status(spark):
    rows = [_page("a", p, fetch=f) for f in ("f0", "f1") for p in range(2)] + [_page("a", 0, fetch="f0", ok=False)]
    rows += [_page(None, 0), _page("n", None), _page("n", -1), _page("n", 0), _page("n", 1), _page("n", 2)]
    assert _statuses(spark, rows, cap=2) == [
        ("", "", 0, "kept"), ("a", "f0", 0, "kept"), ("a", "f0", 0, "repeated_page"), ("a", "f0", 1, "kept"),
        ("a", "f1", 0, "kept"), ("a", "f1", 1, "kept"), ("n", "", -1, "unnumbered"), ("n", "", -1, "unnumbered"),
        ("n", "", 0, "kept"), ("n", "", 1, "kept"), ("n", "", 2, "over_cap")]


def test_two_fetches_and_null_keys_lose_nothing(spark):
    rows = [_page("p", p, fetch=f, token=p == 0) for f in ("f0", "f1") for p in range(2)]
    rows += [_page("q", 0, app=None, token=None), _page(None, 0, token=None)]
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    assert P.page_reviews(P.kept_pages(df)).count() == 6
    assert P.stage_pages(df).reviews().count() == 6
    reviews = P.page_reviews(P.kept_pages(df))
    assert P.empty_groups(df.select("app", "type_client").distinct(), reviews, ["app", "type_client"]).count() == 0


def _with_reviews(page, *ids):
    return (*page[:5], [(None, None, i, None, 1, "5", None, i, None) for i in ids], *page[6:])


def test_copies_that_differ_lose_no_reviews(spark):
    """Two fetches without an id, the shorter read first; a failed landing and its retry; equal copies count once."""
    rows = [_with_reviews(_page("two", p, token=p < 1), f"a{p}") for p in range(2)]
    rows += [_with_reviews(_page("two", p, token=p < 2), f"b{p}") for p in range(3)]
    rows += [_page("retry", 0, ok=False, reviews=False), _page("retry", 0), _page("retry", 1, token=False), _page("retry", 1, token=False)]
    rows += [_page("blank", 0, reviews=False), _page("blank", 0, token=False), _page("none", None), _page(None, None, reviews=False)]
    staged = P.stage_pages(spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1))
    found = sorted((r["product_id"], r["id"]) for r in staged.reviews().collect())
    assert found == [("blank", "r0"), ("retry", "r0"), ("retry", "r1"), *[("two", i) for i in ("a0", "a1", "b0", "b1", "b2")]]
    assert staged.status.count() == len(rows)
    fails = sorted((r["product_id"], r["page_no"], r["kind"], r["error"]) for r in staged.failures().collect())
    assert fails == [("none", None, P.UNNUMBERED, "page without a usable number of product none not kept"),
                     ("retry", 1, P.REPEATED_PAGE, "repeated page 1 of product retry not kept")]


def test_run_pages_records_repeated_and_unnumbered_pages(spark, tmp_dir):
    from revisor.plans.job import run_pages

    rows = [_page("p", 0, token=False), _page("p", 0, token=False), _page("p", None)]
    result = run_pages(spark, spark.createDataFrame(rows, PAGE_SCHEMA), tmp_dir + "/out", odate="20240101")
    errors = sorted(r["error"] for r in spark.read.json(tmp_dir + "/out/metrics/fail").collect())
    assert result.failures == 2 and errors == ["page without a usable number of product p not kept",
                                               "repeated page 0 of product p not kept"]


def test_empty_token_ends_the_chain(spark):
    rows = [_page("p", 0, token=""), _page("p", 1)]
    rows[0] = (*rows[0][:6], "", None)
    assert _kept(spark, rows) == [("p", 0)]


def test_landed_lines(spark, tmp_dir):
    """The response's own token is read; a broken line is a failed request, not a lost one."""
    import json

    def line(page_no, **more):
        return json.dumps({"app": "x", "type_client": "pf", "product_id": "p", "page_no": page_no, "request_ok": True,
                           "reviews": [{"id": f"r{page_no}", "rating": "5", "snippet": "s"}], **more})

    lines = [line(0, serpapi_pagination={"next_page_token": "t"}), line(1, next_page_token="t"), line(2)[:-9], line(2)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmp_dir + "/in")
    staged = P.stage_pages(P.read_landed_pages(spark, tmp_dir + "/in"))
    assert sorted((r["page_no"] is None, r["status"]) for r in staged.status.collect()) == [
        (False, "kept"), (False, "kept"), (False, "kept"), (True, "failed_request")]
    assert [r["error"] for r in staged.failures().collect()] == ["landed line is not a page"]
    assert sorted(r["id"] for r in staged.reviews().collect()) == ["r0", "r1", "r2"]


def test_no_pages(spark):
    staged = P.stage_pages(spark.createDataFrame([], PAGE_SCHEMA))
    assert staged.reviews().count() == staged.failures().count() == staged.empty_groups(["app"]).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.mark.parametrize("most", [None, 300])
def test_the_rule_moves_no_reviews(spark, monkeypatch, most):
    """Windows and exchanges see narrow columns only; the kept pages are a filter on the scan by their row."""
    if most:  # fewer kept than other pages may be broadcast, or none of both
        monkeypatch.setattr(P, "KEPT_BROADCAST_MAX_ROWS", most)
    pages = tables.pages_from_conversations(tables.table(spark, SF01, "conversations"))
    staged = P.stage_pages(pages, 10)
    for plan in (_plan(P._status(staged.pages, 10, "reviews")), _plan(staged.kept())):
        assert all("reviews#" not in x or "has_reviews" in x for x in plan if "Exchange" in x or "Window" in x)
    assert "reviews" not in staged.status.columns
    assert staged.status.where(F.col("status") == P.KEPT).count() == staged.kept().count() == 266


def _bytes(path):
    folder = Path(path.removeprefix("file:"))
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_a_parquet_landing_is_not_copied(spark, tmp_dir):
    """Rows of a Parquet landing are known by file and place: only the narrow statuses are staged."""
    pages = tables.pages_from_conversations(tables.table(spark, SF01, "conversations"))
    long = F.transform("reviews", lambda r: r.withField("snippet", F.concat_ws(" ", *[
        F.sha2(F.concat("product_id", F.col("page_no").cast("string"), r["id"], F.lit(str(k))), 512) for k in range(5)])))
    pages.withColumn("reviews", long).repartition(5).write.parquet(tmp_dir + "/in")
    landed = spark.read.schema(pages.schema).parquet(tmp_dir + "/in")
    staged = P.stage_pages(landed.where("product_id IS NOT NULL"))
    assert len(staged.paths) == 1 and _bytes(staged.paths[0]) < _bytes(tmp_dir + "/in") / 10
    found, expected = (sorted(map(tuple, x.select("product_id", "page_no", "status").collect()))
                       for x in (staged.status, P.stage_pages(pages).status))
    assert found == expected
    assert staged.reviews().count() == P.stage_pages(pages).reviews().count()
    assert staged.pages.select(P.ROW).distinct().count() == pages.count()


def test_rows_made_of_one_row_of_a_file_are_told_apart(spark, tmp_dir):
    """A plan that repeats the rows of a scan has no row identity of its own and is staged."""
    spark.createDataFrame([_page("p", 0, token=False)], PAGE_SCHEMA).write.parquet(tmp_dir + "/in")
    one = spark.read.schema(PAGE_SCHEMA).parquet(tmp_dir + "/in")
    twice = one.withColumn("fetch_id", F.explode(F.array(F.lit("f0"), F.lit("f1"))))
    assert _statuses(spark, twice) == [("p", "f0", 0, "kept"), ("p", "f1", 0, "kept")]
    assert _statuses(spark, one.unionByName(one)) == [("p", "", 0, "kept"), ("p", "", 0, "repeated_page")]
    assert [len(P.identified(x)[1]) for x in (one, twice, one.unionByName(one))] == [0, 1, 1]


def test_many_copies_of_one_number(spark):
    """Half of the landing is one page of one fetch, with three contents and failures among its copies."""
    rows = [_with_reviews(_page(None, 0, token=False), f"a{k % 3}") for k in range(300)] + [_page(None, 0, ok=False)] * 50
    rows += [_page(f"p{k}", 0, token=False) for k in range(350)]
    staged = P.stage_pages(spark.createDataFrame(rows, PAGE_SCHEMA).repartition(6))
    assert staged.status.groupBy("status").count().collect() and staged.status.count() == 700
    assert sorted(r["id"] for r in staged.reviews().where("product_id IS NULL").collect()) == ["a0", "a1", "a2"]
    assert staged.kept().count() == 353


def test_requested_groups_without_reviews(spark):
    """A request that landed nothing, one that landed only failures, NULL keys and repeated requests."""
    rows = [_page("a", 0, token=False), _page("b", 0, ok=False), _page(None, 0, ok=False)]
    staged = P.stage_pages(spark.createDataFrame(rows, PAGE_SCHEMA))
    asked = spark.createDataFrame([("app", "pf", p) for p in ("a", "b", "c", "c", None)] + [(None, "pf", "a")],
                                  "app string, type_client string, product_id string")
    empty = staged.empty_groups(["app", "product_id"], asked)
    assert sorted(map(tuple, empty.collect()), key=str) == sorted(
        [("app", "b", 1), ("app", "c", 0), ("app", None, 1), (None, "a", 0)], key=str)
    assert staged.empty_groups(["app"], asked).collect() == [(None, 0)]
    assert staged.empty_groups(["app"]).collect() == []


def test_partition_count_invariance_pages_and_reports(spark):
    from revisor.operators import metrics as MX

    pages = tables.pages_from_conversations(tables.table(spark, SF01, "conversations"))
    docs = tables.table(spark, SF01, "documents").select(F.col("doc_id").alias("run"), "text")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            kept = sorted(map(tuple, P.page_status(pages, 10).select("product_id", "page_no", "status").collect()))
            keys = sorted(map(tuple, MX.report_pairs(MX.report_lines(docs)).collect()))
            got.append((kept, keys))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]
