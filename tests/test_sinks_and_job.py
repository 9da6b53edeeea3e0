"""Parquet sink semantics and the end-to-end batch."""

import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from revisor.operators import metrics as MX
from revisor.plans import job
from revisor.plans.job import run_pages, run_reviews, run_single_app
from revisor.schemas import BRONZE_SCHEMA, PAGE_SCHEMA
from revisor.sinks import publish
from revisor.sinks.parquet import save_dataframe
from revisor.sources import tables

from conftest import SF001


def _rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=repr)


def test_sink_idempotent_and_empty_keeps_old(spark, tmp_dir):
    r = tables.reviews(spark, SF001).where(F.col("id").isNotNull())
    path = os.path.join(tmp_dir, "t")
    o1 = save_dataframe(r, path, "v", odate="20240101", schema=BRONZE_SCHEMA, strict=True,
                        partition_cols=["app", "type_client", "odate"], overwrite="dynamic")
    first = _rows(spark, path)
    o2 = save_dataframe(r, path, "v", odate="20240101", schema=BRONZE_SCHEMA, strict=True,
                        partition_cols=["app", "type_client", "odate"], overwrite="dynamic")
    assert o1.ok and o2.ok and o1.rows == o2.rows == r.count()
    assert _rows(spark, path) == first
    empty = save_dataframe(r.where(F.lit(False)), path, "v", odate="20240102",
                           partition_cols=["app", "type_client", "odate"])
    assert not empty.ok and empty.reason == "no rows"
    assert _rows(spark, path) == first
    empty_dyn = save_dataframe(r.where(F.lit(False)), path, "v", odate="20240102",
                               partition_cols=["app", "type_client", "odate"], overwrite="dynamic")
    assert not empty_dyn.ok and empty_dyn.reason == "no rows"
    assert _rows(spark, path) == first
    bad = save_dataframe("nope", path, "v", odate="x")
    assert not bad.ok


def test_static_vs_dynamic_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "app string, v int")
    path = os.path.join(tmp_dir, "o")
    save_dataframe(df, path, "x", odate="20240101", partition_cols=["app", "odate"])
    save_dataframe(df.where("app = 'a'"), path, "x", odate="20240102", partition_cols=["app", "odate"],
                   overwrite="dynamic")
    got = spark.read.parquet(path).select("app", F.col("odate").cast("string")).distinct().collect()
    assert sorted(tuple(r) for r in got) == [("a", "20240101"), ("a", "20240102"), ("b", "20240101")]
    save_dataframe(df.where("app = 'a'"), path, "x", odate="20240103", partition_cols=["app", "odate"],
                   overwrite="static")
    got = spark.read.parquet(path).select("app", F.col("odate").cast("string")).distinct().collect()
    assert sorted(tuple(r) for r in got) == [("a", "20240103")]


def test_run_reviews(spark, tmp_dir):
    r = tables.reviews(spark, SF001)
    res = run_reviews(spark, r, tmp_dir, odate="20240101", ctx=MX.RunContext(application_id="t"))
    assert res.valid.ok and res.invalid.ok
    written = spark.read.parquet(os.path.join(tmp_dir, "reviews"))
    counts = {x["side"]: x["count"] for x in written.groupBy("side").count().collect()}
    assert counts == {"valid": res.totals["valid_records"], "invalid": res.totals["invalid_records"]}
    assert dict(written.dtypes)["rating"] == "double" and dict(written.dtypes)["rating_raw"] == "string"
    docs = spark.read.json(res.metrics_path).collect()
    assert len(docs) == res.totals["groups"] and all(d["write_ok"] for d in docs)


def test_staged_tables_are_removed(spark, tmp_dir):
    import glob

    from revisor.session import checkpoint_root

    stage = os.path.join(checkpoint_root(spark).removeprefix("file:"), "revisor-stage", "*")
    before = set(glob.glob(stage))
    run_reviews(spark, tables.reviews(spark, SF001), os.path.join(tmp_dir, "a"), odate="20240101")
    run_pages(spark, spark.createDataFrame(PAGES, PAGE_SCHEMA), os.path.join(tmp_dir, "b"), odate="20240101")
    assert set(glob.glob(stage)) == before


def test_ratings_survive_the_typed_write(spark, tmp_dir):
    """No written valid row has lost its rating: the text is beside the number, in both layouts and sides."""
    r = tables.reviews(spark, SF001)
    run_reviews(spark, r, os.path.join(tmp_dir, "sides"), odate="20240101")
    run_reviews(spark, r, os.path.join(tmp_dir, "split"), odate="20240101", layout="split")
    for path in ("sides/reviews/side=valid", "split/valid"):
        valid = spark.read.parquet(os.path.join(tmp_dir, path))
        assert valid.where("rating_raw IS NULL OR id IS NULL OR snippet IS NULL").count() == 0
        assert valid.where("rating IS NULL AND rating_raw = 'bad'").count() > 0
    types = [spark.read.parquet(os.path.join(tmp_dir, p)).schema["rating"].dataType.simpleString()
             for p in ("split/valid", "split/invalid", "sides/reviews")]
    assert types == ["double"] * 3


def _review(i, rating="5"):
    return (None, "2024-01-01", f"id{i}", None, 1, rating, None, "ok", None)


PAGES = [
    ("app_x", "pf", "p1", 0, True, [_review(1), _review(2)], "t0", None),
    ("app_x", "pf", "p1", 1, True, [_review(2)], None, None),
    ("app_x", "pf", "p2", 0, True, None, "t0", None),
    ("app_y", "pj", "p3", 0, False, None, None, None),
]


def test_run_pages(spark, tmp_dir):
    landed = os.path.join(tmp_dir, "landed")
    spark.createDataFrame(PAGES, PAGE_SCHEMA).write.json(landed)
    from revisor.sources.pages import read_landed_pages

    res = run_pages(spark, read_landed_pages(spark, landed), os.path.join(tmp_dir, "out"), odate="20240101")
    assert res.failures == 2 and res.empty_groups == 1
    (empty,) = spark.read.json(res.empty_path).collect()
    assert (empty["app"], empty["type_client"]) == ("app_y", "pj")
    assert res.totals == {"groups": 1, "total_records": 3, "valid_records": 3, "invalid_records": 2, "duplicate_groups": 1}
    fails = spark.read.json(os.path.join(tmp_dir, "out", "metrics", "fail")).collect()
    assert len(fails) == 2


def test_batches_without_reviews(spark, tmp_dir):
    """No review rows, pages that all failed, no pages at all: nothing is written and nothing breaks."""
    failed = [(*p[:4], False, *p[5:]) for p in PAGES]
    none = tables.reviews(spark, SF001).where("false")
    for name, res in (("reviews", run_reviews(spark, none, tmp_dir + "/a", odate="20240101")),
                      ("split", run_reviews(spark, none, tmp_dir + "/b", odate="20240101", layout="split")),
                      ("failed", run_pages(spark, spark.createDataFrame(failed, PAGE_SCHEMA), tmp_dir + "/c", odate="20240101")),
                      ("nothing", run_pages(spark, spark.createDataFrame([], PAGE_SCHEMA), tmp_dir + "/d", odate="20240101"))):
        assert (res.valid.rows, res.invalid.rows, res.metrics_path) == (0, 0, None), name
        assert res.valid.reason == res.invalid.reason == "no rows"
        assert res.failures == (3 if name == "failed" else 0)


def _only_failure(spark, base):
    (row,) = spark.read.json(os.path.join(base, "fail")).collect()
    assert not os.path.exists(os.path.join(base, "success"))
    return row


def test_every_entry_records_its_failure(spark, tmp_dir):
    import pytest

    from revisor.plans.job import run_single_app

    def blocked(*parts):
        path = os.path.join(tmp_dir, *parts)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        open(path, "w").close()  # a file where a folder should be

    r = tables.reviews(spark, SF001)
    blocked("a", "reviews")
    with pytest.raises(RuntimeError, match="write failed"):
        run_reviews(spark, r, os.path.join(tmp_dir, "a"), odate="20240101")
    row = _only_failure(spark, os.path.join(tmp_dir, "a", "metrics"))
    assert row["client"] == "UNKNOWN_CLIENT" and row["error"].startswith("RuntimeError: write failed")

    blocked("b", "reviews")
    with pytest.raises(RuntimeError, match="write failed"):
        run_pages(spark, spark.createDataFrame(PAGES[:2], PAGE_SCHEMA), os.path.join(tmp_dir, "b"), odate="20240101")
    assert _only_failure(spark, os.path.join(tmp_dir, "b", "metrics"))["error"].startswith("RuntimeError")

    blocked("c", "valid")
    with pytest.raises(RuntimeError, match="write failed"):
        run_single_app(spark, r, os.path.join(tmp_dir, "c", "valid"), os.path.join(tmp_dir, "c", "invalid"), "bank", "pf",
                       odate="20240101")
    assert _only_failure(spark, os.path.join(tmp_dir, "c", "metrics"))["client"] == "PF"

    with pytest.raises(ValueError):  # anything that ends a run is recorded, not only writes
        run_reviews(spark, r, os.path.join(tmp_dir, "d"), odate="20240101", layout="other")
    assert "layout" in _only_failure(spark, os.path.join(tmp_dir, "d", "metrics"))["error"]


def test_run_single_app_parity_layout(spark, tmp_dir):
    from revisor.plans.job import run_single_app

    from test_validation import RULES

    df = spark.createDataFrame(RULES, BRONZE_SCHEMA)
    vb, ib = os.path.join(tmp_dir, "valid"), os.path.join(tmp_dir, "invalid")
    res = run_single_app(spark, df, vb, ib, "bank", "pf", odate="20240101", metrics_base=os.path.join(tmp_dir, "m"))
    assert res.valid.rows == 6 and res.invalid.rows == 9
    assert os.path.isdir(os.path.join(vb, "bank_pf", "odate=20240101"))
    run_single_app(spark, df, vb, ib, "bank", "pf", odate="20240102")
    dates = sorted(os.listdir(os.path.join(vb, "bank_pf")))
    assert [d for d in dates if d.startswith("odate=")] == ["odate=20240102"]  # static: earlier dates go
    doc = spark.read.json(res.metrics_path).first()
    assert doc["type_client"] == "PF" and doc["source"]["app"] == "bank"
    assert doc["success_count"] == 0 and doc["error_count"] == 3


def test_clustered_writes_group_files(spark, tmp_dir):
    """With rows_per_file, each (side, app, client, odate) folder gets few files of at most so many rows."""
    r = tables.reviews(spark, SF001).repartition(8)  # mix the groups over tasks
    plain, clustered = os.path.join(tmp_dir, "plain"), os.path.join(tmp_dir, "clustered")
    a = run_reviews(spark, r, plain, odate="20240101")
    b = run_reviews(spark, r, clustered, odate="20240101", rows_per_file=400)
    cols = ["side", "app", "type_client", "id", "snippet", "rating"]

    def rows(path):
        return sorted(map(tuple, spark.read.parquet(os.path.join(path, "reviews")).select(*cols).collect()), key=repr)

    assert a.valid.rows == b.valid.rows and a.invalid.rows == b.invalid.rows and rows(clustered) == rows(plain)
    written = spark.read.parquet(os.path.join(clustered, "reviews")).withColumn("file", F.input_file_name())
    per_file = written.groupBy("side", "app", "type_client", "file").count()
    assert per_file.agg(F.max("count")).first()[0] <= 400
    for s in per_file.groupBy("side", "app", "type_client").agg(F.sum("count").alias("n"), F.count("*").alias("files")).collect():
        assert s["files"] <= -(-s["n"] // 400) + 1


def test_clustering_counts_nothing_and_splits_a_hot_group(spark, tmp_dir):
    """The plan is one rebalance by the groups; a group that holds most rows is split by size at run time."""
    from revisor.sinks.parquet import cluster_by_group

    name, size = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 10 < 8, "hot").otherwise((F.col("id") % 7).cast("string")).alias("app"),
                                              F.sha2(F.col("id").cast("string"), 256).alias("text"))
    out = cluster_by_group(df, ["app"])
    assert "RebalancePartitions" in out._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set(name, "1m")
    try:
        out.write.partitionBy("app").parquet(tmp_dir + "/out")
    finally:
        spark.conf.set(name, size)
    files = {p.parent.name: 0 for p in Path(tmp_dir + "/out").rglob("*.parquet")}
    for p in Path(tmp_dir + "/out").rglob("*.parquet"):
        files[p.parent.name] += 1
    assert files["app=hot"] > 3 and all(n <= 2 for k, n in files.items() if k != "app=hot")


def test_cli_reviews_mode(spark, tmp_dir):
    """The command line runs the batch in this process's session."""
    from revisor.__main__ import main

    src = os.path.join(tmp_dir, "src")
    tables.reviews(spark, SF001).write.parquet(src)
    out = os.path.join(tmp_dir, "cli")
    assert main(["reviews", "--input", src, "--out", out, "--odate", "20240101"]) == 0
    assert spark.read.parquet(os.path.join(out, "reviews")).count() > 0
    assert main(["single-app", "--input", src, "--out", os.path.join(tmp_dir, "one"), "--odate", "20240101",
                 "--app", "bank", "--client", "pf"]) == 0
    assert os.path.isdir(os.path.join(tmp_dir, "one", "valid", "bank_pf", "odate=20240101"))


def test_read_written_keeps_partition_types(spark, tmp_dir):
    from revisor.sinks.parquet import read_written

    r = tables.reviews(spark, SF001)
    path = os.path.join(tmp_dir, "w")
    save_dataframe(r, path, "v", odate="20240101", schema=BRONZE_SCHEMA, strict=True,
                   partition_cols=["app", "type_client", "odate"], overwrite="dynamic")
    assert dict(spark.read.parquet(path).dtypes)["odate"] == "int"  # inference
    back = read_written(spark, path, BRONZE_SCHEMA, ["app", "type_client", "odate"])
    assert dict(back.dtypes)["odate"] == "string" and back.count() == r.count()


def test_sides_layout_equals_split_layout(spark, tmp_dir):
    r = tables.reviews(spark, SF001)
    cols = ["app", "type_client", "id", "snippet", "rating", "rating_raw", "date", "likes"]

    def rows(path):
        return sorted(map(tuple, spark.read.parquet(path).select(*cols).collect()), key=repr)

    split = run_reviews(spark, r, os.path.join(tmp_dir, "split"), odate="20240101", layout="split")
    for name, opts in {"bcast": None, "hot": {"broadcast_max_bytes": 0, "hot_rows": 2}}.items():
        base = os.path.join(tmp_dir, name)
        sides = run_reviews(spark, r, base, odate="20240101", join_options=opts)
        assert sides.join_plan.strategy == ("broadcast" if name == "bcast" else "hot_split")
        assert rows(os.path.join(base, "reviews", "side=valid")) == rows(os.path.join(tmp_dir, "split", "valid"))
        assert rows(os.path.join(base, "reviews", "side=invalid")) == rows(os.path.join(tmp_dir, "split", "invalid"))
        assert (sides.valid.rows, sides.invalid.rows) == (split.valid.rows, split.invalid.rows)
        docs = spark.read.json(sides.metrics_path).collect()
        assert len(docs) == sides.totals["groups"] and all(d["write_ok"] for d in docs)


def test_cli_pages_mode_with_load_id(spark, tmp_dir):
    from revisor.__main__ import main

    review = (None, "2024-01-01", "id1", None, 1, "5", None, "ok", None)
    landed = os.path.join(tmp_dir, "landed")
    spark.createDataFrame([("app_c", "pf", "p1", 0, True, [review], None, None)], PAGE_SCHEMA).write.json(landed)
    out = os.path.join(tmp_dir, "out")
    assert main(["pages", "--landing", landed, "--out", out, "--odate", "20240101", "--load-id", "7"]) == 0
    assert os.path.isdir(os.path.join(out, "reviews", "side=valid", "app=app_c", "type_client=pf", "odate=20240101", "load_id=7"))


def _tree(path):
    return sorted((p.relative_to(path).as_posix(), p.read_bytes()) for p in Path(path).rglob("*") if p.is_file())


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
def test_a_failed_second_side_changes_nothing(spark, tmp_dir, monkeypatch, overwrite):
    """The invalid side can't be written: readers see the batch before, whole; the next run sees none of it either."""
    rows = tables.reviews(spark, SF001)
    bases = [tmp_dir + "/valid", tmp_dir + "/invalid"]

    def both(frame, odate):
        return (lambda: run_reviews(spark, frame, tmp_dir + "/split", odate=odate, layout="split", overwrite=overwrite),
                lambda: run_single_app(spark, frame, *bases, "bank", "pf", odate=odate, overwrite=overwrite))

    for run in both(rows, "20240101"):
        run()
    before = [_tree(p) for p in (tmp_dir + "/split/valid", tmp_dir + "/split/invalid", *bases)]
    written = job.save_dataframe

    def broken(df, path, label, **kwargs):
        out = written(df, path, label, **kwargs)
        return out if label == "valid" else job.WriteOutcome(False, 0, path, "disk full")

    monkeypatch.setattr(job, "save_dataframe", broken)
    for run in both(rows.where("app = 'app_R'"), "20240101"):
        with pytest.raises(RuntimeError, match="disk full"):
            run()
    assert [_tree(p) for p in (tmp_dir + "/split/valid", tmp_dir + "/split/invalid", *bases)] == before
    assert not [p for p in Path(tmp_dir).rglob("_publish-*")]
    monkeypatch.undo()
    for run in both(rows.where("app = 'app_R'"), "20240102"):
        run()
    assert [_tree(p) for p in (tmp_dir + "/split/valid", *bases)] != [before[0], *before[2:]]
    left = spark.read.parquet(tmp_dir + "/split/valid").groupBy("odate").count().count()
    assert left == (1 if overwrite == "static" else 2)


def test_a_publication_that_stopped_half_way_is_finished(spark, tmp_dir, monkeypatch):
    """The process dies after the first move: both sides are old or new again once the next run has begun."""
    rows = tables.reviews(spark, SF001)
    run_reviews(spark, rows, tmp_dir, odate="20240101", layout="split")
    expected = [spark.read.parquet(f"{tmp_dir}/{s}").where("app = 'app_N'").count() for s in ("valid", "invalid")]
    carry = publish._carry_out
    monkeypatch.setattr(publish, "_carry_out", lambda *_: (_ for _ in ()).throw(SystemError("killed")))
    with pytest.raises(SystemError):
        run_reviews(spark, rows.where("app = 'app_R'"), tmp_dir, odate="20240102", layout="split", overwrite="static")
    monkeypatch.setattr(publish, "_carry_out", carry)
    (manifest,) = Path(tmp_dir).glob("_publish-*.json")
    first, second = json.loads(manifest.read_text())["moves"]
    shutil.rmtree(first[1].removeprefix("file:"))
    Path(first[0].removeprefix("file:")).rename(first[1].removeprefix("file:"))
    assert spark.read.parquet(tmp_dir + "/invalid").where("app = 'app_N'").count() == expected[1]
    assert publish.recover(spark, tmp_dir) == 1 and publish.recover(spark, tmp_dir) == 0
    for side in ("valid", "invalid"):
        assert {r["app"] for r in spark.read.parquet(f"{tmp_dir}/{side}").select("app").distinct().collect()} == {"app_R"}
    assert not [p for p in Path(tmp_dir).rglob("_publish-*")]


def test_reruns_leave_one_document_a_group(spark, tmp_dir):
    """A whole rerun, a rerun of one app, another load and another date; the failures of a run stay."""
    rows = tables.reviews(spark, SF001)
    groups = rows.select("app", "type_client").distinct().count()
    success = tmp_dir + "/metrics/success"
    for frame in (rows, rows, rows.where("app = 'app_R'")):
        res = run_reviews(spark, frame, tmp_dir, odate="20240101")
        assert spark.read.json(res.metrics_path).groupBy("source.app", "type_client").count().agg(
            F.count("*"), F.max("count")).first() == (groups, 1)
    run_reviews(spark, rows, tmp_dir, odate="20240101", load_id="late")
    run_reviews(spark, rows, tmp_dir, odate="20240102")
    found = spark.read.json(success).groupBy("odate", "load_id").count().collect()
    assert sorted((str(r["odate"]), r["load_id"], r["count"]) for r in found) == [
        ("20240101", "batch", groups), ("20240101", "late", groups), ("20240102", "batch", groups)]


def _few_line_items(spark, folder, last="R"):
    """Line items of four groups: one all valid, the one of the last app all invalid; order 3 comes twice."""
    rows = [(1, 1, "A", "O"), (2, 1, "A", "O"), (4, 53, "A", "O"), (3, 1, "N", "F"), (3, 1, "N", "F"), (5, 1, "N", "F"),
            (6, 1, "N", "O"), (7, 1, "N", "O"), (8, 53, last, "F")]  # part 53 has no rating
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_returnflag string, l_linestatus string").select(
        "*", F.lit(1).alias("l_linenumber"), F.lit(2).alias("l_suppkey"), F.lit(5.0).alias("l_quantity"),
        F.lit("2024-01-01").alias("l_shipdate")).coalesce(1).write.parquet(folder + "/lineitem.parquet")
    return folder


@pytest.mark.parametrize("last", ["R", "Q"])
def test_rerun_job_runs_both_layouts(spark, tmp_dir, monkeypatch, last):
    """Each layout gets the whole batch twice and one app's part, in a folder of its own; no group gets lost."""
    runs = []

    def recorded(spark, rows, base, *, layout, **kwargs):
        runs.append((layout, base, rows.count(), rows.select("app").distinct().count()))
        return run_reviews(spark, rows, base, layout=layout, **kwargs)

    monkeypatch.setattr(job, "run_reviews", recorded)
    found = E.q_rerun_job(spark, _few_line_items(spark, tmp_dir, last))
    assert sorted(tuple(r) for r in found.select("app", "type_client", "total_records", "valid_rows", "invalid_rows").collect()) == [
        ("app_A", "pf", 3, 2, 1), ("app_N", "pf", 2, 2, None), ("app_N", "pj", 5, 3, 2), (f"app_{last}", "pj", 1, None, 1)]
    for layout in ("split", "sides"):
        own = [r for r in runs if r[0] == layout]
        assert [(rows, apps) for _, _, rows, apps in own] == [(9, 3), (9, 3), (1, 1)], layout
        assert len({base for _, base, _, _ in own}) == 1
    assert len({base for _, base, _, _ in runs}) == 2


@pytest.mark.parametrize("layout", ["split", "sides"])
def test_rerun_job_tells_a_layout_that_differs(spark, tmp_dir, monkeypatch, layout):
    """Reviews that one layout holds twice, on one side of one group, are not passed over."""

    def doubled(spark, rows, base, **kwargs):
        res = run_reviews(spark, rows, base, **kwargs)
        if kwargs["layout"] == layout and rows.select("app").distinct().count() == 1:  # after the last run
            part = next(Path(res.invalid.path.removeprefix("file:")).rglob("part-*.parquet"))
            shutil.copy(part, part.with_name("part-again.parquet"))
        return res

    monkeypatch.setattr(job, "run_reviews", doubled)
    with pytest.raises(RuntimeError, match="layouts"):
        E.q_rerun_job(spark, _few_line_items(spark, tmp_dir))


def test_reruns_of_pages_replace_their_failures_and_empties(spark, tmp_dir):
    asked = spark.createDataFrame([("app_x", "pf"), ("app_z", "pf"), (None, "pf")], "app string, type_client string")
    kwargs = {"odate": "20240101", "requested": asked}
    job.record_failure(spark, tmp_dir + "/metrics", MX.RunContext(), ValueError("an earlier attempt"), odate="20240101")
    for pages, failures in ((PAGES, 2), (PAGES, 2), (PAGES[:2], 0)):
        res = run_pages(spark, spark.createDataFrame(pages, PAGE_SCHEMA), tmp_dir, **kwargs)
        assert res.failures == failures
        records = spark.read.json(tmp_dir + "/metrics/fail")
        runs = records.where("error LIKE 'ValueError%'").count()
        # app_y is not in the last landing, so what was recorded about it stays
        assert (runs, records.count() - runs) == (1, max(failures, 1))
    empty = spark.read.json(res.empty_path).collect()
    assert sorted((r.asDict().get("app") or "", r["n_pages"]) for r in empty) == [("", 0), ("app_y", 1), ("app_z", 0)]


def test_cli_requested(spark, tmp_dir, capsys):
    from revisor.__main__ import main

    spark.createDataFrame(PAGES, PAGE_SCHEMA).write.json(tmp_dir + "/landed")
    spark.createDataFrame([("app_z", "pf", "p9")], "app string, type_client string, product_id string").write.parquet(tmp_dir + "/asked")
    assert main(["pages", "--landing", tmp_dir + "/landed", "--requested", tmp_dir + "/asked", "--out", tmp_dir + "/out",
                 "--odate", "20240101"]) == 0
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert said["empty_groups"] == 2
    assert sorted(r["app"] for r in spark.read.json(said["empty_path"]).collect()) == ["app_y", "app_z"]


def test_a_fresh_folder_is_not_probed(spark, tmp_dir, monkeypatch):
    """A write aside is one job, and the session gets its number of open files back after a write."""
    from revisor.sinks import parquet

    seen = []
    kind = type(spark.range(1))
    real = kind.isEmpty
    monkeypatch.setattr(kind, "isEmpty", lambda df: seen.append(1) or real(df))
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with parquet._open_files(spark):
        assert spark.conf.get(key) == str(parquet.OPEN_FILES)
    assert spark.conf.get(key) == before
    rows = spark.createDataFrame([("r1", "s", "5")], "id string, snippet string, rating string")
    assert parquet.save_dataframe(rows, tmp_dir + "/aside", "valid", odate="20240101", fresh=True).rows == 1
    assert not parquet.save_dataframe(rows.where("false"), tmp_dir + "/none", "valid", odate="20240101", fresh=True).ok
    assert not seen
    assert not parquet.save_dataframe(rows.where("false"), tmp_dir + "/aside", "valid", odate="20240101").ok
    assert seen and spark.read.parquet(tmp_dir + "/aside").count() == 1
