"""

Every query reads the benchmark tables in ``sf_dir`` whole:

* review queries run over ``reviews``, a projection of ``lineitem`` (one
  review per line item; see ``revisor.sources.tables``);
* page queries run over landed pages projected from ``conversations`` (one
  page per turn, one review per line of the turn's text);
* report and document queries run over ``documents`` texts.

Queries whose name ends in ``_global`` use the single-app semantics (the
whole input is one app, duplicate key ``id``); the others use the batch
semantics of the engine (duplicate key ``app, type_client, id``).
The map column ``response`` is compared through its two keys
(``response_title``, ``response_snippet``).

Job-level queries (``sink_roundtrip``, ``metrics_roundtrip``, ``ingest_job``,
``ingest_job_sides``, ``landed_page_reviews``, ``ingest_pages_job``,
``stream_pages_job``) write into fresh folders under the session's
checkpoint folder and return what they read back.  ``skewed_invalid_reviews``
re-keys a third of the ``lineitem`` rows to one id (no row dropped) and forces
the hot/cold split.
"""

from __future__ import annotations

import functools
import importlib
import os
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisor.operators import checks
from revisor.operators import metrics as MX
from revisor.operators.columns import coerce, ensure_column, stamp
from revisor.operators.validation import validate
from revisor.schemas import BRONZE_SCHEMA, GROUP_COLUMNS, WRITTEN_SCHEMA
from revisor.session import stage_dir
from revisor.sinks.parquet import preview, read_written, save_dataframe, target_path
from revisor.sources import pages as P
from revisor.sources import tables

G = GROUP_COLUMNS
ODATE = "20240101"
FIXED_CTX = MX.RunContext(
    application_id="app-fixed",
    start=datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc),
    end=datetime(2024, 1, 1, 12, 3, 0, tzinfo=timezone.utc),
    timestamp=datetime(2024, 1, 1, 12, 3, 0, 500000, tzinfo=timezone.utc),
)
OUT_COLUMNS = ["avatar", "date", "id", "iso_date", "likes", "rating", "response_title", "response_snippet",
               "snippet", "title"]


# -- helpers ------------------------------------------------------------------

def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.reviews(spark, sf_dir)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.pages_from_conversations(tables.table(spark, sf_dir, "conversations"))


def _out(df: DataFrame, keep=G) -> DataFrame:
    """Review rows with the map column shown through its two keys."""
    cols = []
    for c in ["avatar", "date", "id", "iso_date", "likes", "rating"]:
        cols.append(F.col(c))
    cols += [F.col("response")["title"].alias("response_title"), F.col("response")["snippet"].alias("response_snippet"),
             F.col("snippet"), F.col("title")]
    return df.select(*keep, *cols)


# -- queries ------------------------------------------------------------------

def q_valid_reviews(spark, sf_dir):
    return _out(checks.valid_rows(_reviews(spark, sf_dir), G))


def q_invalid_null_reviews(spark, sf_dir):
    return _out(checks.null_invalid_rows(_reviews(spark, sf_dir), G))


def q_duplicate_ids(spark, sf_dir):
    return checks.duplicate_ids(_reviews(spark, sf_dir), G)


def q_duplicate_ids_global(spark, sf_dir):
    return checks.duplicate_ids(_reviews(spark, sf_dir))


def _dup_rows(spark, sf_dir, group_cols):
    r = _reviews(spark, sf_dir)
    keys = validate(r, group_cols, materialize=True).duplicate_keys  # staged once, read twice
    return checks.duplicate_rows(r, keys, group_cols)


def q_duplicate_reviews(spark, sf_dir):
    return _out(_dup_rows(spark, sf_dir, G))


def q_duplicate_reviews_global(spark, sf_dir):
    return _out(_dup_rows(spark, sf_dir, []), keep=[])


def q_invalid_reviews(spark, sf_dir):
    return _out(validate(_reviews(spark, sf_dir), G, materialize=True).invalid)


def q_invalid_reviews_global(spark, sf_dir):
    return _out(validate(_reviews(spark, sf_dir), [], materialize=True).invalid, keep=[])


def q_null_counts(spark, sf_dir):
    return checks.null_counts(_reviews(spark, sf_dir), G)


def q_null_counts_global(spark, sf_dir):
    return checks.null_counts(_reviews(spark, sf_dir))


def q_bad_ratings(spark, sf_dir):
    r = _reviews(spark, sf_dir)
    return checks.bad_rating_rows(r, G).groupBy(*G, "rating").agg(F.count(F.lit(1)).alias("n"))


def q_group_summary(spark, sf_dir):
    return validate(_reviews(spark, sf_dir), G).summary


def q_validation_results(spark, sf_dir):
    return validate(_reviews(spark, sf_dir), G).results


def q_validation_results_global(spark, sf_dir):
    return validate(_reviews(spark, sf_dir), []).results


def q_validation_summary(spark, sf_dir):
    return validate(_reviews(spark, sf_dir), G).summary_lines


def q_split_metrics(spark, sf_dir):
    s = MX.split_metrics(validate(_reviews(spark, sf_dir), G).summary, G)
    return s.withColumn("valid_percentage", F.round("valid_percentage", 6)).withColumn(
        "invalid_percentage", F.round("invalid_percentage", 6)
    )


def q_metrics_documents(spark, sf_dir):
    docs = MX.metrics_documents(validate(_reviews(spark, sf_dir), G).summary, FIXED_CTX)
    return MX.flat_documents(docs)


def q_ensure_response(spark, sf_dir):
    r = ensure_column(_reviews(spark, sf_dir).drop("response"), "response")
    return _out(r)


def q_coerced_reviews(spark, sf_dir):
    return _out(coerce(checks.valid_rows(_reviews(spark, sf_dir), G), BRONZE_SCHEMA, strict=True, keep=G))


def q_stamped_reviews(spark, sf_dir):
    return _out(stamp(checks.valid_rows(_reviews(spark, sf_dir), G), ODATE), keep=[*G, "odate"])


def _page_cols(df):
    return df.select(*G, "product_id", "page_no")


def q_kept_pages(spark, sf_dir):
    return _page_cols(P.kept_pages(_pages(spark, sf_dir)))


def q_kept_pages_cap3(spark, sf_dir):
    return _page_cols(P.kept_pages(_pages(spark, sf_dir), 3))


def q_page_status(spark, sf_dir):
    return P.page_status(_pages(spark, sf_dir)).select(*G, "product_id", "page_no", "status")


def q_page_reviews(spark, sf_dir):
    rows = P.page_reviews(P.kept_pages(_pages(spark, sf_dir)))
    return rows.select(*G, "product_id", "page_no", "review_no", "id", "likes", "rating", "snippet")


def q_empty_products(spark, sf_dir):
    return P.stage_pages(_pages(spark, sf_dir)).empty_groups([*G, "product_id"])


def _requests(spark, sf_dir):
    return tables.requests_from_customers(tables.table(spark, sf_dir, "customer"))


def q_empty_apps(spark, sf_dir):
    """A5 at the (app, client) level: landed or requested groups with no review at all."""
    return P.stage_pages(_pages(spark, sf_dir)).empty_groups(G, _requests(spark, sf_dir))


def q_empty_requests(spark, sf_dir):
    """A5 for every landed or requested product, with the number of pages it landed."""
    return P.stage_pages(_pages(spark, sf_dir)).empty_groups([*G, "product_id"], _requests(spark, sf_dir))


def q_requested_pages_job(spark, sf_dir):
    """The empty groups that the job over landed pages reports, run twice under one key."""
    from revisor.plans.job import run_pages

    base = stage_dir(spark, "requested-job")
    landed = _landed(spark, sf_dir)
    for _ in range(2):
        res = run_pages(spark, landed, base, requested=_requests(spark, sf_dir), odate=ODATE, ctx=FIXED_CTX)
    found = spark.read.schema("app string, type_client string, n_pages long").json(res.empty_path)
    return found.withColumn("failures", F.lit(res.failures).cast("long")).withColumn(
        "failure_records", F.lit(spark.read.json(res.failures_path).count()).cast("long"))


def q_empty_apps_failed(spark, sf_dir):
    """A5 where every request of one app failed and another app has no name."""
    pages = _pages(spark, sf_dir)
    pages = pages.withColumn("request_ok", F.col("request_ok") & (F.col("app") != "app_3")).withColumn(
        "app", F.when(F.col("app") != "app_2", F.col("app")))
    return P.stage_pages(pages).empty_groups(G)


def _page_cases(spark, sf_dir):
    """Pages of every kind: two fetches of each product, one of them with a page
    landed twice, empty tokens, NULL apps, products and numbers, chains of 14."""
    flat = tables.raw_pages_from_conversations(tables.table(spark, sf_dir, "conversations"))
    turn, conv = F.col("page_no"), F.col("product_id")
    fetches = flat.withColumn("fetch_id", F.explode(F.array(F.lit("f0"), F.lit("f1")))).withColumn(
        "copies", F.when((F.col("fetch_id") == "f1") & (turn == 1), 2).otherwise(1))
    chains = flat.where(turn == 0).withColumn("page_no", F.explode(F.sequence(F.lit(0), F.lit(13)))).select(
        *[c for c in flat.columns if c != "page_no"], "page_no").withColumn("fetch_id", F.lit("long")).withColumn(
        "copies", F.lit(1)).withColumn("next_page_token", F.when(turn < 13, F.lit("t")))
    pages = fetches.unionByName(chains).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return pages.select(
        F.when(conv % 5 != 0, F.concat(F.lit("app_"), (conv % 4).cast("string"))).alias("app"), F.lit("pf").alias("type_client"),
        F.when(conv % 7 != 0, conv.cast("string")).alias("product_id"), F.when(turn != 6, turn.cast("int")).alias("page_no"),
        "request_ok", "review_text",
        F.when((conv + turn) % 11 == 0, F.lit("")).otherwise(F.col("next_page_token")).alias("next_page_token"),
        F.when(conv % 7 != 0, F.col("fetch_id")).otherwise(F.concat("fetch_id", conv.cast("string"))).alias("fetch_id"))


def q_page_status_cases(spark, sf_dir):
    """Every landed page has one status: the counts add up to the pages landed."""
    status = P.page_status(_page_cases(spark, sf_dir), 12, reviews_col="review_text")
    return status.groupBy("app", "page_no", "status").agg(F.count(F.lit(1)).alias("pages"))


def q_corrupt_pages(spark, sf_dir):
    """Landed lines, some cut short, some with the token in the response's own paging object."""
    pages = _pages(spark, sf_dir).withColumn("turn", F.col("page_no"))
    conv = F.col("product_id").cast("long")
    nested = F.struct(F.col("next_page_token").alias("next_page_token"))
    pages = pages.withColumn("serpapi_pagination", F.when(conv % 3 == 0, nested)).withColumn(
        "next_page_token", F.when(conv % 3 != 0, F.col("next_page_token")))
    line = F.to_json(F.struct(*[c for c in pages.columns if c != "turn"]))
    cut = (conv + F.col("turn")) % 13 == 0
    path = stage_dir(spark, "corrupt-pages")
    pages.select(F.when(cut, F.substring(line, F.lit(1), F.length(line) - 2)).otherwise(line).alias("value")).write.text(path)
    status = P.page_status(P.read_landed_pages(spark, path))
    return status.select(*G, "product_id", "page_no", "status")


def q_report_keys(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("run"), "text")
    return MX.report_pairs(MX.report_lines(docs))


def q_failure_records(spark, sf_dir):
    f = P.fetch_failures(_pages(spark, sf_dir))
    return MX.failure_records(f.withColumn("client", F.col("type_client")), FIXED_CTX,
                              keep=[*G, "product_id", "page_no", "kind"])


def q_document_check(spark, sf_dir):
    return MX.document_check(tables.table(spark, sf_dir, "documents"), "text", keep=["doc_id"])


def q_sink_roundtrip(spark, sf_dir):
    path = stage_dir(spark, "sink-roundtrip")
    out = save_dataframe(checks.valid_rows(_reviews(spark, sf_dir), G), path, "valid", odate=ODATE,
                         schema=BRONZE_SCHEMA, strict=True, partition_cols=[*G, "odate"], overwrite="dynamic")
    if not out.ok:
        raise RuntimeError(out.reason)
    schema = T.StructType(
        BRONZE_SCHEMA.fields + [T.StructField(c, T.StringType(), True) for c in (*G, "odate")]
    )
    return _out(spark.read.schema(schema).parquet(path), keep=[*G, "odate"])


def q_metrics_roundtrip(spark, sf_dir):
    from revisor.sinks.metrics import read_metrics, save_metrics

    docs = MX.metrics_documents(validate(_reviews(spark, sf_dir), G).summary, FIXED_CTX)
    base = stage_dir(spark, "metrics-roundtrip")
    save_metrics(docs, base, "success")
    back = read_metrics(spark, base, "success", docs.schema["document"].dataType)
    back = back.select(F.struct(*back.columns).alias("document"))
    back = back.select(F.col("document.source.app").alias("app"),
                       F.lower(F.col("document.type_client")).alias("type_client"), "document")
    return MX.flat_documents(back)


def q_preview(spark, sf_dir):
    v = _out(checks.valid_rows(_reviews(spark, sf_dir), G))
    return preview(v.orderBy(*[F.col(c).asc_nulls_first() for c in [*G, *OUT_COLUMNS]]), 10)


def q_ingest_job(spark, sf_dir):
    from revisor.plans.job import run_reviews

    base = stage_dir(spark, "ingest-job")
    run_reviews(spark, _reviews(spark, sf_dir), base, odate=ODATE, ctx=FIXED_CTX, layout="split")
    sides = []
    for side in ("valid", "invalid"):
        t = spark.read.parquet(os.path.join(base, side))
        sides.append(t.groupBy(*G).agg(F.count(F.lit(1)).alias("rows")).withColumn("side", F.lit(side)))
    return sides[0].unionByName(sides[1])


def _landed(spark, sf_dir):
    """Land the pages as JSON files (one landing folder per call) and read
    them back through the declared-schema source (A1)."""
    path = stage_dir(spark, "landed-pages")
    _pages(spark, sf_dir).write.json(path)
    return P.read_landed_pages(spark, path)


def q_landed_page_reviews(spark, sf_dir):
    rows = P.page_reviews(P.kept_pages(_landed(spark, sf_dir)))
    return rows.select(*G, "product_id", "page_no", "review_no", "id", "likes", "rating", "snippet")


def q_ingest_pages_job(spark, sf_dir):
    from revisor.plans.job import run_pages

    base = stage_dir(spark, "pages-job")
    res = run_pages(spark, _landed(spark, sf_dir), base, odate=ODATE, ctx=FIXED_CTX)
    return _flat_from_json(spark.read.schema(MX.document_schema(spark, FIXED_CTX)).json(res.metrics_path))


def _flat_from_json(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.struct(*docs.columns).alias("document"))
    docs = docs.select(F.col("document.source.app").alias("app"),
                       F.lower(F.col("document.type_client")).alias("type_client"), "document")
    return MX.flat_documents(docs)


def q_stream_pages_job(spark, sf_dir):
    """The landed pages drained by the availableNow stream (one micro-batch
    per trigger), metrics documents read back from the per-epoch folders."""
    from revisor.streaming.landed import start_landed_stream

    landing = stage_dir(spark, "stream-landing")
    _pages(spark, sf_dir).write.json(os.path.join(landing, "run-0"))
    base = stage_dir(spark, "stream-out")
    q = start_landed_stream(spark, os.path.join(landing, "*"), base, stage_dir(spark, "stream-ckpt"), odate=ODATE)
    if not q.awaitTermination(900):
        q.stop()
        raise TimeoutError("landed-page stream did not drain within 900 s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    docs = spark.read.schema(MX.document_schema(spark, FIXED_CTX)).json(os.path.join(base, "metrics", "*", "success"))
    return _flat_from_json(docs)


def _rerun(spark, rows: DataFrame, app: str | None, layout: str) -> DataFrame:
    """One layout of ``rerun_job``: the documents and the number of reviews a side holds, NULL where it has none."""
    from revisor.plans.job import run_reviews

    base = stage_dir(spark, f"rerun-job-{layout}")
    parts = (rows, rows, rows.where(F.col("app") == F.lit(app)))
    whole = [run_reviews(spark, part, base, odate=ODATE, ctx=FIXED_CTX, layout=layout) for part in parts][0]
    docs = _flat_from_json(spark.read.schema(MX.document_schema(spark, FIXED_CTX)).json(whole.metrics_path))
    sides = [read_written(spark, o.path, WRITTEN_SCHEMA, [*G, "odate"]).select(*G, F.lit(side).alias("side"))
             for side, o in (("valid", whole.valid), ("invalid", whole.invalid)) if o.rows]
    counts = functools.reduce(DataFrame.unionByName, sides).groupBy(*G).agg(
        *[F.sum(F.when(F.col("side") == side, 1)).alias(f"{side}_rows") for side in ("valid", "invalid")])
    return docs.join(counts, G)


def q_rerun_job(spark, sf_dir):
    """A batch run twice with one load date, then one app's part of it again, in both layouts of
    the trees: every group still has one document, and its reviews once.  Both layouts must hold the same."""
    rows = _reviews(spark, sf_dir)
    app = rows.agg(F.max("app")).first()[0]  # any one app that is there
    split, sides = (_rerun(spark, rows, app, layout) for layout in ("split", "sides"))
    if not (split.exceptAll(sides).isEmpty() and sides.exceptAll(split).isEmpty()):
        raise RuntimeError("the layouts of a batch run again hold different documents or reviews")
    return split


def q_skewed_invalid_reviews(spark, sf_dir):
    """Invalid side when one id holds a third of all rows, with the broadcast
    path switched off: the hot key is flagged by broadcast in the first pass
    and never enters the shuffled semi-join of the cold keys."""
    r = tables.reviews(spark, sf_dir, hot_every=3)
    # The hot id has about rows/18 copies per (app, client) — over 300 from
    # sf0.001 up — while ordinary duplicated ids have a handful, so 100
    # copies separates them at every scale.
    v = validate(r, G, materialize=True, broadcast_max_bytes=0, hot_rows=100)
    if v.join_plan.strategy != "hot_split":
        raise RuntimeError(f"expected the hot/cold split, got {v.join_plan}")
    return _out(v.invalid)


def q_ingest_job_sides(spark, sf_dir):
    """The batch with both sides written in one job (``layout="sides"``)."""
    from revisor.plans.job import run_reviews

    base = stage_dir(spark, "ingest-sides")
    run_reviews(spark, _reviews(spark, sf_dir), base, odate=ODATE, ctx=FIXED_CTX, layout="sides")
    t = spark.read.parquet(os.path.join(base, "reviews"))
    return t.groupBy(*G, "side").agg(F.count(F.lit(1)).alias("rows"))


def _written(spark, base: str) -> DataFrame:
    """The rows a batch wrote, both sides, with the map column shown through its keys."""
    rows = read_written(spark, os.path.join(base, "reviews"), WRITTEN_SCHEMA, ["side", *G, "odate"])
    return _out(rows, keep=["side", *G, "odate", "rating_raw"])


def q_ingest_job_rows(spark, sf_dir):
    """The contents of both written sides: typed columns and the rating as it came."""
    from revisor.plans.job import run_reviews

    base = stage_dir(spark, "ingest-rows")
    run_reviews(spark, _reviews(spark, sf_dir), base, odate=ODATE, ctx=FIXED_CTX)
    return _written(spark, base)


def q_ingest_pages_rows(spark, sf_dir):
    """The contents of both sides of a batch over landed pages whose reviews
    repeat ids, lack texts and have ratings that are no numbers."""
    from revisor.plans.job import run_pages

    pages = _pages(spark, sf_dir)
    harmed = F.transform("reviews", lambda r: r.withField("id", F.concat_ws("-", F.col("product_id"), r["likes"].cast("string")))
                         .withField("snippet", F.when(r["likes"] % 10 != 0, r["snippet"]))
                         .withField("rating", F.when(r["likes"] % 7 == 0, F.lit("bad")).otherwise(r["rating"])))
    path = stage_dir(spark, "harmed-pages")
    pages.withColumn("reviews", harmed).write.json(path)
    base = stage_dir(spark, "pages-rows")
    run_pages(spark, P.read_landed_pages(spark, path), base, odate=ODATE, ctx=FIXED_CTX)
    return _written(spark, base)


def q_empty_batch_job(spark, sf_dir):
    """A batch of which every request failed: nothing is written but the failure records."""
    from revisor.plans.job import run_pages

    base = stage_dir(spark, "empty-batch")
    res = run_pages(spark, _pages(spark, sf_dir).withColumn("request_ok", F.lit(False)), base, odate=ODATE, ctx=FIXED_CTX)
    schema = "app string, type_client string, product_id string, page_no int, client string, error string"
    records = spark.read.schema(schema).json(res.failures_path)
    return records.withColumn("written", F.lit(res.valid.rows + res.invalid.rows).cast("long")).withColumn(
        "documents", F.lit(0 if res.metrics_path is None else 1))


def q_job_failure_record(spark, sf_dir):
    """A run whose target can't be written (a file stands where its folder
    should): the failure record it leaves, and no success document."""
    from revisor.plans.job import run_reviews

    base = stage_dir(spark, "job-failure")
    target = spark._jvm.org.apache.hadoop.fs.Path(base, "reviews")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(target, True).close()
    raised = ""
    try:
        run_reviews(spark, _reviews(spark, sf_dir), base, odate=ODATE, ctx=FIXED_CTX)
    except RuntimeError as e:
        raised = str(e)
    metrics = spark._jvm.org.apache.hadoop.fs.Path(base, "metrics/success")
    schema = "timestamp string, layer string, project string, job string, priority string, torre string, client string, error string"
    records = spark.read.schema(schema).json(os.path.join(base, "metrics", "fail"))
    reviews = _reviews(spark, sf_dir).agg(F.count(F.lit(1)).alias("reviews"))
    return reviews.join(records.select(
        "timestamp", "layer", "project", "job", "priority", "torre", "client",
        (F.col("error") == F.lit(f"RuntimeError: {raised}")).alias("error_is_the_one_raised"),
        F.lit(fs.exists(metrics)).alias("has_success")))


def q_many_duplicates_invalid_reviews(spark, sf_dir):
    """Invalid side with more duplicated keys than a broadcast may hold (the limit set to 0)."""
    v = validate(_reviews(spark, sf_dir), G, materialize=True, broadcast_max_bytes=0)
    if v.join_plan.strategy != "shuffle":
        raise RuntimeError(f"expected the shuffled join, got {v.join_plan}")
    return _out(v.invalid)


def q_rejected_documents(spark, sf_dir):
    """What the metrics writer refuses, over a document made of every text's id and length:
    whole, cut short, empty, and with trailing content."""
    from revisor.sinks.metrics import rejected_documents

    kind = F.col("doc_id") % 5
    whole = F.concat(F.lit('{"doc": '), F.col("doc_id").cast("string"), F.lit(', "chars": '), F.length("text").cast("string"), F.lit("}"))
    made = (F.when(kind == 0, whole).when(kind == 1, F.substring(whole, F.lit(1), F.length(whole) - 1)).when(kind == 2, F.lit(""))
            .when(kind == 3, F.concat(whole, F.lit("]"))).otherwise(F.concat(whole, F.lit(" "))))
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", made.alias("document"))
    return rejected_documents(docs, "success").select("doc_id", "reason")


def q_single_app_job(spark, sf_dir):
    """The one-app layout: contents of both trees (ratings as text, which the default coercion keeps)."""
    from revisor.plans.job import run_single_app

    base = stage_dir(spark, "single-app-job")
    bases = {side: os.path.join(base, side) for side in ("valid", "invalid")}
    run_single_app(spark, _reviews(spark, sf_dir), bases["valid"], bases["invalid"], "bank", "pf", odate=ODATE, ctx=FIXED_CTX)
    schema = T.StructType([f if f.name != "rating" else T.StructField("rating", T.StringType()) for f in BRONZE_SCHEMA.fields])
    sides = [read_written(spark, target_path(b, "bank", "pf"), schema).withColumn("side", F.lit(s)) for s, b in bases.items()]
    return _out(sides[0].unionByName(sides[1]), keep=["side", "odate"])


def q_sink_outcomes(spark, sf_dir):
    """H2: the outcome of every kind of call of the sink."""
    base = stage_dir(spark, "sink-outcomes")
    rows = _reviews(spark, sf_dir)
    calls = {"written": (rows, base), "nothing to write": (rows.where(F.lit(False)), base), "no path": (rows, ""),
             "no frame": ([1], base)}
    found = []
    for name, (frame, path) in calls.items():
        o = save_dataframe(frame, path, name, odate=ODATE, overwrite="dynamic")
        found.append((name, o.ok, o.rows, o.reason))
    kept = read_written(spark, base, T.StructType([f for f in BRONZE_SCHEMA.fields if f.name != "rating"])).count()
    return spark.createDataFrame(found, "call string, ok boolean, rows long, reason string").withColumn("on_disk", F.lit(kept).cast("long"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "valid_reviews": q_valid_reviews,
    "invalid_null_reviews": q_invalid_null_reviews,
    "duplicate_ids": q_duplicate_ids,
    "duplicate_ids_global": q_duplicate_ids_global,
    "duplicate_reviews": q_duplicate_reviews,
    "duplicate_reviews_global": q_duplicate_reviews_global,
    "invalid_reviews": q_invalid_reviews,
    "invalid_reviews_global": q_invalid_reviews_global,
    "null_counts": q_null_counts,
    "null_counts_global": q_null_counts_global,
    "bad_ratings": q_bad_ratings,
    "group_summary": q_group_summary,
    "validation_results": q_validation_results,
    "validation_results_global": q_validation_results_global,
    "validation_summary": q_validation_summary,
    "split_metrics": q_split_metrics,
    "metrics_documents": q_metrics_documents,
    "ensure_response": q_ensure_response,
    "coerced_reviews": q_coerced_reviews,
    "stamped_reviews": q_stamped_reviews,
    "kept_pages": q_kept_pages,
    "kept_pages_cap3": q_kept_pages_cap3,
    "page_status": q_page_status,
    "page_reviews": q_page_reviews,
    "empty_products": q_empty_products,
    "empty_apps": q_empty_apps,
    "empty_requests": q_empty_requests,
    "requested_pages_job": q_requested_pages_job,
    "rerun_job": q_rerun_job,
    "report_keys": q_report_keys,
    "failure_records": q_failure_records,
    "document_check": q_document_check,
    "sink_roundtrip": q_sink_roundtrip,
    "metrics_roundtrip": q_metrics_roundtrip,
    "preview": q_preview,
    "ingest_job": q_ingest_job,
    "landed_page_reviews": q_landed_page_reviews,
    "ingest_pages_job": q_ingest_pages_job,
    "stream_pages_job": q_stream_pages_job,
    "skewed_invalid_reviews": q_skewed_invalid_reviews,
    "ingest_job_sides": q_ingest_job_sides,
    "empty_apps_failed": q_empty_apps_failed,
    "page_status_cases": q_page_status_cases,
    "corrupt_pages": q_corrupt_pages,
    "ingest_job_rows": q_ingest_job_rows,
    "ingest_pages_rows": q_ingest_pages_rows,
    "empty_batch_job": q_empty_batch_job,
    "job_failure_record": q_job_failure_record,
    "many_duplicates_invalid_reviews": q_many_duplicates_invalid_reviews,
    "rejected_documents": q_rejected_documents,
    "single_app_job": q_single_app_job,
    "sink_outcomes": q_sink_outcomes,
}


def entry(spark: SparkSession) -> DataFrame:
    return q_valid_reviews(spark, "/root/testdata/sf0.001")


def _optional(name: str):
    """A module of the optional subpackage, or None where it was taken out; other import errors show."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name not in (name, "revisor.llm"):
            raise
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    llm, pipeline = _optional("revisor.llm.queries"), _optional("corpus_pipeline")
    if llm is not None:
        found.update(llm.queries())
        if pipeline is not None:
            found["pipeline"] = pipeline.run
    return found


# -- DuckDB oracles -----------------------------------------------------------

_REVIEWS = """
reviews AS (
  SELECT 'https://img.example/' || CAST(l_suppkey AS VARCHAR) AS avatar,
    CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date,
    CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE 'r' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS id,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'T00:00:00Z' AS iso_date,
    CAST(l_quantity AS BIGINT) AS likes,
    CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN 'bad'
         WHEN l_partkey % 61 = 0 THEN '4.5' WHEN l_partkey % 67 = 0 THEN '1e3'
         WHEN l_partkey % 71 = 0 THEN '3000000000'
         ELSE CAST(l_linenumber % 5 + 1 AS VARCHAR) END AS rating,
    CASE WHEN l_suppkey % 3 = 0 THEN MAP {'title': l_returnflag, 'snippet': l_linestatus} END AS response,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'snippet ' || CAST(l_partkey AS VARCHAR) END AS snippet,
    'user ' || CAST(l_suppkey AS VARCHAR) AS title,
    'app_' || l_returnflag AS app,
    CASE WHEN l_linestatus = 'O' THEN 'pf' ELSE 'pj' END AS type_client
  FROM lineitem
)"""

_INT_RE = r"'^[\x00-\x20\x7f]*([+-]?)([0-9]*)(\.[0-9]*)?[\x00-\x20\x7f]*$'"
_BAD = f"""(rating IS NULL OR NOT (
    regexp_matches(rating, {_INT_RE})
    AND length(regexp_extract(rating, {_INT_RE}, 2)) + length(regexp_extract(rating, {_INT_RE}, 3)) > 0
    AND (length(regexp_extract(rating, {_INT_RE}, 2)) = 0
         OR TRY_CAST(regexp_extract(rating, {_INT_RE}, 1) || regexp_extract(rating, {_INT_RE}, 2) AS INTEGER)
            IS NOT NULL)))"""

_OUT = """avatar, date, id, iso_date, likes, rating, response['title'] AS response_title,
  response['snippet'] AS response_snippet, snippet, title"""
_VALID = "id IS NOT NULL AND snippet IS NOT NULL AND rating IS NOT NULL"
_NULL_INVALID = "(id IS NULL OR snippet IS NULL OR rating IS NULL)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _dup_rows_sql(keys: str) -> str:
    join = " AND ".join(f"r.{k} = d.{k}" for k in keys.split(", "))
    return f"""SELECT r.* FROM reviews r JOIN (
    SELECT {keys} FROM reviews WHERE id IS NOT NULL GROUP BY {keys} HAVING count(*) > 1) d ON {join}"""


# Per-group summary in plain per-operator form (no one-pass tricks).
_SUMMARY_G = """
base AS (
  SELECT app, type_client, count(*) AS total_records,
    count(*) FILTER (WHERE id IS NULL) AS null_id,
    count(*) FILTER (WHERE snippet IS NULL) AS null_snippet,
    count(*) FILTER (WHERE rating IS NULL) AS null_rating,
    count(*) FILTER (WHERE date IS NULL) AS null_date,
    count(*) FILTER (WHERE {bad}) AS bad_ratings,
    count(*) FILTER (WHERE {valid}) AS valid_records
  FROM reviews GROUP BY app, type_client
),
dg AS (
  SELECT app, type_client, count(*) AS duplicate_groups FROM (
    SELECT app, type_client, id FROM reviews GROUP BY app, type_client, id HAVING count(*) > 1) x
  GROUP BY app, type_client
),
dr AS (
  SELECT app, type_client, count(*) AS duplicate_rows FROM ({duprows}) y GROUP BY app, type_client
),
summary AS (
  SELECT b.*, coalesce(dg.duplicate_groups, 0) AS duplicate_groups, coalesce(dr.duplicate_rows, 0) AS duplicate_rows,
    b.total_records - b.valid_records AS null_invalid_records,
    b.total_records - b.valid_records + coalesce(dr.duplicate_rows, 0) AS invalid_records
  FROM base b LEFT JOIN dg USING (app, type_client) LEFT JOIN dr USING (app, type_client)
)""".format(bad=_BAD, valid=_VALID, duprows=_dup_rows_sql("app, type_client, id"))

_SUMMARY_1 = """
base AS (
  SELECT count(*) AS total_records,
    count(*) FILTER (WHERE id IS NULL) AS null_id,
    count(*) FILTER (WHERE snippet IS NULL) AS null_snippet,
    count(*) FILTER (WHERE rating IS NULL) AS null_rating,
    count(*) FILTER (WHERE date IS NULL) AS null_date,
    count(*) FILTER (WHERE {bad}) AS bad_ratings
  FROM reviews
),
summary AS (
  SELECT b.*, (SELECT count(*) FROM (SELECT id FROM reviews GROUP BY id HAVING count(*) > 1) x) AS duplicate_groups
  FROM base b
)""".format(bad=_BAD)


# The message texts in this SQL are those of ``revisor/functions/messages.py``.
def _results_sql(keys: str) -> str:
    sel = f"{keys}, " if keys else ""
    nulls = ("concat_ws(', ', CASE WHEN null_id > 0 THEN '''id'': ' || null_id END, "
             "CASE WHEN null_snippet > 0 THEN '''snippet'': ' || null_snippet END, "
             "CASE WHEN null_rating > 0 THEN '''rating'': ' || null_rating END, "
             "CASE WHEN null_date > 0 THEN '''date'': ' || null_date END)")
    no_nulls = "(null_id = 0 AND null_snippet = 0 AND null_rating = 0 AND null_date = 0)"
    return f"""
results AS (
  SELECT {sel}0 AS check_no, 'duplicate_check' AS "check", duplicate_groups = 0 AS status,
    CAST(CASE WHEN duplicate_groups = 0 THEN 200 ELSE 409 END AS INTEGER) AS code,
    CASE WHEN duplicate_groups = 0 THEN 'Nenhum registro duplicado encontrado.'
         ELSE 'Registros duplicados encontrados: ' || duplicate_groups || ' registros com base no ''id''.' END AS message,
    total_records FROM summary
  UNION ALL
  SELECT {sel}1, 'null_check', {no_nulls}, CAST(CASE WHEN {no_nulls} THEN 200 ELSE 400 END AS INTEGER),
    CASE WHEN {no_nulls} THEN 'Nenhum valor nulo encontrado nas colunas criticas.'
         ELSE 'Valores nulos encontrados nas colunas: {{' || {nulls} || '}}.' END,
    total_records FROM summary
  UNION ALL
  SELECT {sel}2, 'type_consistency_check', bad_ratings = 0, CAST(CASE WHEN bad_ratings = 0 THEN 200 ELSE 400 END AS INTEGER),
    CASE WHEN bad_ratings = 0 THEN 'Consistência dos tipos de dados verificada com sucesso.'
         ELSE 'Valores não numéricos encontrados na coluna ''rating''.' END,
    total_records FROM summary
)"""


_SPLIT = """
split AS (
  SELECT app, type_client, total_records AS input_records, valid_records AS valid_count,
    invalid_records AS invalid_count, valid_records + invalid_records AS total_records,
    round(CASE WHEN valid_records + invalid_records > 0
          THEN valid_records / (valid_records + invalid_records) * 100 ELSE 0.0 END, 6) AS valid_percentage,
    round(CASE WHEN valid_records + invalid_records > 0
          THEN invalid_records / (valid_records + invalid_records) * 100 ELSE 0.0 END, 6) AS invalid_percentage,
    CAST((duplicate_groups = 0)::INT + (null_id = 0 AND null_snippet = 0 AND null_rating = 0 AND null_date = 0)::INT
         + (bad_ratings = 0)::INT AS INTEGER) AS success_count
  FROM summary
)"""

_PAGES = """
pages AS (
  SELECT 'app_' || CAST(conv_id % 4 AS VARCHAR) AS app, 'pf' AS type_client,
    CAST(conv_id AS VARCHAR) AS product_id, CAST(turn AS INTEGER) AS page_no,
    (conv_id * 7 + turn) % 23 <> 0 AS request_ok,
    CASE WHEN (conv_id * 5 + turn) % 29 <> 0 THEN text END AS review_text,
    CASE WHEN (conv_id + turn) % 6 <> 5 THEN 'tok' || CAST(turn AS VARCHAR) END AS next_page_token
  FROM conversations
)"""


def _page_status_sql(cap: int | None = None, pages: str = "pages", fetch: str = "NULL") -> str:
    """Every row of ``pages`` with its status; ``fetch`` is the column that parts the fetches of a product."""
    part = f"PARTITION BY app, type_client, product_id, {fetch}"
    ends = "(NOT request_ok OR coalesce(next_page_token, '') = '' OR review_text IS NULL)"
    over = "FALSE" if cap is None else f"page_no >= {cap}"
    return f"""
ps0 AS (
  SELECT *, row_number() OVER ({part}, page_no) AS copy, page_no IS NULL AS unnumbered, coalesce({over}, FALSE) AS over_cap
  FROM {pages}
),
ps1 AS (
  SELECT *, max(CASE WHEN {ends} THEN 1 ELSE 0 END) OVER ({part} ORDER BY page_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier_end,
         row_number() OVER ({part} ORDER BY page_no) AS rn
  FROM ps0 WHERE copy = 1 AND NOT unnumbered AND NOT over_cap
),
ps2 AS (
  SELECT *, page_no = rn - 1 AND coalesce(earlier_end, 0) = 0 AS reached FROM ps1
),
ps3 AS (
  SELECT *, max(CASE WHEN reached AND request_ok AND review_text IS NULL THEN 1 ELSE 0 END) OVER ({part}) AS pf
  FROM ps2
),
page_status AS (
  SELECT * EXCLUDE (earlier_end, rn, reached, pf), CASE WHEN NOT reached THEN 'not_reached' WHEN NOT request_ok THEN 'failed_request'
    WHEN review_text IS NULL THEN 'missing_reviews' WHEN pf = 1 THEN 'product_failed' ELSE 'kept' END AS status
  FROM ps3
  UNION ALL
  SELECT *, CASE WHEN unnumbered THEN 'unnumbered' WHEN over_cap THEN 'over_cap' ELSE 'repeated_page' END
  FROM ps0 WHERE copy > 1 OR unnumbered OR over_cap
),
kept AS (SELECT * FROM page_status WHERE status = 'kept')"""


_PAGE_REVIEWS = """
page_reviews AS (
  SELECT app, type_client, product_id, page_no,
    unnest(range(len(string_split(review_text, chr(10))))) AS review_no,
    unnest(string_split(review_text, chr(10))) AS line
  FROM kept
)"""

_PY_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{_PY_WS}+|{_PY_WS}+$', '', 'g')"


_FAILURES = """
failures AS (
  SELECT app, type_client, product_id, page_no, status AS kind,
    CASE WHEN status = 'failed_request'
         THEN 'request failed for product ' || product_id || ' on page ' || CAST(page_no AS VARCHAR)
         ELSE '[*] Não foi possível recuperar as avaliações.' END AS error
  FROM page_status WHERE status IN ('failed_request', 'missing_reviews')
)"""


def oracle_sql() -> dict[str, str]:
    r = _with(_REVIEWS)
    g = "app, type_client, "
    q: dict[str, str] = {}
    q["valid_reviews"] = r + f"SELECT {g}{_OUT} FROM reviews WHERE {_VALID}"
    q["invalid_null_reviews"] = r + f"SELECT {g}{_OUT} FROM reviews WHERE {_NULL_INVALID}"
    q["duplicate_ids"] = r + ("SELECT app, type_client, id, count(*) AS count FROM reviews "
                              "GROUP BY app, type_client, id HAVING count(*) > 1")
    q["duplicate_ids_global"] = r + "SELECT id, count(*) AS count FROM reviews GROUP BY id HAVING count(*) > 1"
    q["duplicate_reviews"] = r + f"SELECT {g}{_OUT} FROM ({_dup_rows_sql('app, type_client, id')}) t"
    q["duplicate_reviews_global"] = r + f"SELECT {_OUT} FROM ({_dup_rows_sql('id')}) t"
    q["invalid_reviews"] = r + (f"SELECT {g}{_OUT} FROM reviews WHERE {_NULL_INVALID} UNION ALL "
                                f"SELECT {g}{_OUT} FROM ({_dup_rows_sql('app, type_client, id')}) t")
    q["invalid_reviews_global"] = r + (f"SELECT {_OUT} FROM reviews WHERE {_NULL_INVALID} UNION ALL "
                                       f"SELECT {_OUT} FROM ({_dup_rows_sql('id')}) t")
    nulls = ("count(*) AS total_records, count(*) FILTER (WHERE id IS NULL) AS null_id, "
             "count(*) FILTER (WHERE snippet IS NULL) AS null_snippet, "
             "count(*) FILTER (WHERE rating IS NULL) AS null_rating, "
             "count(*) FILTER (WHERE date IS NULL) AS null_date")
    q["null_counts"] = r + f"SELECT app, type_client, {nulls} FROM reviews GROUP BY app, type_client"
    q["null_counts_global"] = r + f"SELECT {nulls} FROM reviews"
    q["bad_ratings"] = r + (f"SELECT app, type_client, rating, count(*) AS n FROM reviews WHERE {_BAD} "
                            "GROUP BY app, type_client, rating")
    sg = _with(_REVIEWS, _SUMMARY_G)
    q["group_summary"] = sg + "SELECT * FROM summary"
    q["validation_results"] = _with(_REVIEWS, _SUMMARY_G, _results_sql("app, type_client")) + "SELECT * FROM results"
    q["validation_results_global"] = _with(_REVIEWS, _SUMMARY_1, _results_sql("")) + "SELECT * FROM results"
    q["validation_summary"] = _with(_REVIEWS, _SUMMARY_G, _results_sql("app, type_client")) + """
SELECT app, type_client, 0 AS line_no, '[*] Validação da ingestão concluída para ' || total_records || ' registros.' AS line
FROM results WHERE check_no = 0
UNION ALL
SELECT app, type_client, check_no * 2 + 1,
  CASE check_no WHEN 0 THEN 'Duplicate Check' WHEN 1 THEN 'Null Check' ELSE 'Type Consistency Check' END
  || ': ' || CASE WHEN status THEN 'PASSOU' ELSE 'FALHOU' END
FROM results
UNION ALL
SELECT app, type_client, check_no * 2 + 2, '  -> ' || message FROM results WHERE length(message) > 0"""
    q["split_metrics"] = _with(_REVIEWS, _SUMMARY_G, _SPLIT) + (
        "SELECT *, CAST(3 - success_count AS INTEGER) AS error_count FROM split")
    documents = """
SELECT s.app, s.type_client, 'DQ' AS owner_sigla, 'reviews' AS owner_projeto, 'bronze' AS owner_layer_lake,
  s.valid_count, s.valid_percentage, s.invalid_count, s.invalid_percentage, s.total_records, s.input_records,
  s.success_count, CAST(3 - s.success_count AS INTEGER) AS error_count, upper(s.type_client) AS doc_type_client,
  s.app AS source_app, 'google_play' AS source_search,
  d.code AS duplicate_code, d.message AS duplicate_message, n.code AS null_code, n.message AS null_message,
  t.code AS type_code, t.message AS type_message
FROM split s
JOIN results d ON d.app = s.app AND d.type_client = s.type_client AND d.check_no = 0
JOIN results n ON n.app = s.app AND n.type_client = s.type_client AND n.check_no = 1
JOIN results t ON t.app = s.app AND t.type_client = s.type_client AND t.check_no = 2"""
    docs_sql = _with(_REVIEWS, _SUMMARY_G, _SPLIT, _results_sql("app, type_client")) + documents
    q["metrics_documents"] = docs_sql
    q["metrics_roundtrip"] = docs_sql
    q["ensure_response"] = r + ("SELECT app, type_client, avatar, date, id, iso_date, likes, rating, "
                                "CAST(NULL AS VARCHAR) AS response_title, CAST(NULL AS VARCHAR) AS response_snippet, "
                                "snippet, title FROM reviews")
    coerced = ("avatar, date, id, iso_date, likes, TRY_CAST(rating AS DOUBLE) AS rating, "
               "response['title'] AS response_title, response['snippet'] AS response_snippet, snippet, title")
    q["coerced_reviews"] = r + f"SELECT {g}{coerced} FROM reviews WHERE {_VALID}"
    q["stamped_reviews"] = r + f"SELECT {g}'{ODATE}' AS odate, {_OUT} FROM reviews WHERE {_VALID}"
    q["sink_roundtrip"] = r + f"SELECT {g}'{ODATE}' AS odate, {coerced} FROM reviews WHERE {_VALID}"
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["app", "type_client", *OUT_COLUMNS])
    q["preview"] = r + f"SELECT * FROM (SELECT {g}{_OUT} FROM reviews WHERE {_VALID}) v ORDER BY {order} LIMIT 10"
    q["ingest_job"] = r + (
        f"SELECT app, type_client, count(*) AS rows, 'valid' AS side FROM reviews WHERE {_VALID} "
        "GROUP BY app, type_client UNION ALL "
        "SELECT app, type_client, count(*), 'invalid' FROM ("
        f"SELECT app, type_client FROM reviews WHERE {_NULL_INVALID} UNION ALL "
        f"SELECT app, type_client FROM ({_dup_rows_sql('app, type_client, id')}) t) u GROUP BY app, type_client")

    pages = _with(_PAGES, _page_status_sql())
    q["kept_pages"] = pages + "SELECT app, type_client, product_id, page_no FROM kept"
    q["kept_pages_cap3"] = _with(_PAGES, _page_status_sql(3)) + "SELECT app, type_client, product_id, page_no FROM kept"
    q["page_status"] = pages + "SELECT app, type_client, product_id, page_no, status FROM page_status"
    q["page_reviews"] = _with(_PAGES, _page_status_sql(), _PAGE_REVIEWS) + """
SELECT app, type_client, product_id, page_no, CAST(review_no AS INTEGER) AS review_no,
  product_id || '-' || CAST(page_no AS VARCHAR) || '-' || CAST(review_no AS VARCHAR) AS id,
  CAST(length(line) AS BIGINT) AS likes, CAST(length(line) % 5 + 1 AS VARCHAR) AS rating, line AS snippet
FROM page_reviews"""
    q["landed_page_reviews"] = q["page_reviews"]
    landed = """
reviews AS (
  SELECT app, type_client, product_id || '-' || page_no || '-' || review_no AS id, line AS snippet,
    CAST(length(line) % 5 + 1 AS VARCHAR) AS rating, CAST(NULL AS VARCHAR) AS date
  FROM page_reviews
)"""
    q["ingest_pages_job"] = _with(_PAGES, _page_status_sql(), _PAGE_REVIEWS, landed, _SUMMARY_G, _SPLIT,
                                  _results_sql("app, type_client")) + documents
    q["stream_pages_job"] = q["ingest_pages_job"]
    q["ingest_job_sides"] = q["ingest_job"]
    q["rerun_job"] = (f"SELECT d.*, valid_rows, invalid_rows FROM ({q['metrics_documents']}) d "
                      f"JOIN (SELECT app, type_client, sum(rows) FILTER (side = 'valid')::BIGINT AS valid_rows, "
                      f"sum(rows) FILTER (side = 'invalid')::BIGINT AS invalid_rows FROM ({q['ingest_job']}) "
                      "GROUP BY app, type_client) USING (app, type_client)")
    skewed = _REVIEWS.replace(
        "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE 'r' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS id",
        "CASE WHEN l_orderkey % 3 = 0 THEN 'r-hot' WHEN l_orderkey % 89 = 0 THEN NULL "
        "ELSE 'r' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS id")
    assert skewed != _REVIEWS
    q["skewed_invalid_reviews"] = _with(skewed) + (
        f"SELECT {g}{_OUT} FROM reviews WHERE {_NULL_INVALID} UNION ALL "
        f"SELECT {g}{_OUT} FROM ({_dup_rows_sql('app, type_client, id')}) t")
    requested = """
requested AS (
  SELECT CASE WHEN c_custkey % 50 <> 0 THEN 'app_' || CAST(c_custkey % 6 AS VARCHAR) END AS app, 'pf' AS type_client,
    CAST(CASE WHEN c_custkey % 6 < 4 THEN c_custkey - c_custkey % 4 + c_custkey % 6 ELSE c_custkey END AS VARCHAR) AS product_id
  FROM customer
),
asked AS (
  SELECT app, type_client, product_id, 0 AS held, 0 AS landed FROM requested
  UNION ALL SELECT app, type_client, product_id, CASE WHEN status = 'kept' THEN 1 ELSE 0 END, 1 FROM page_status
)"""
    empties = _with(_PAGES, _page_status_sql(), requested)
    q["empty_apps"] = empties + """
SELECT app, type_client, CAST(sum(landed) AS BIGINT) AS n_pages FROM asked GROUP BY app, type_client HAVING sum(held) = 0"""
    q["empty_requests"] = empties + """
SELECT app, type_client, product_id, CAST(sum(landed) AS BIGINT) AS n_pages FROM asked
GROUP BY app, type_client, product_id HAVING sum(held) = 0"""
    q["requested_pages_job"] = _with(_PAGES, _page_status_sql(), requested, _FAILURES) + """
SELECT app, type_client, CAST(sum(landed) AS BIGINT) AS n_pages, (SELECT count(*) FROM failures) AS failures,
  (SELECT count(*) FROM failures) AS failure_records
FROM asked GROUP BY app, type_client HAVING sum(held) = 0"""
    q["empty_products"] = _with(_PAGES, _page_status_sql()) + """
SELECT DISTINCT app, type_client, product_id FROM pages p
WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.app = p.app AND k.type_client = p.type_client
                  AND k.product_id = p.product_id)"""
    q["failure_records"] = _with(_PAGES, _page_status_sql(), _FAILURES) + """
SELECT app, type_client, product_id, page_no, kind, '2024-01-01T12:03:00.500Z' AS timestamp, 'bronze' AS layer,
  'reviews' AS project, 'reviews_ingestion' AS job, '0' AS priority, 'REVIEWS' AS torre,
  CASE WHEN type_client IS NULL OR type_client = '' THEN 'UNKNOWN_CLIENT' ELSE upper(type_client) END AS client,
  error
FROM failures"""
    q["report_keys"] = f"""
WITH lines AS (
  SELECT doc_id AS run, unnest(range(len(string_split({_strip('text')}, chr(10))))) AS line_no,
    unnest(string_split({_strip('text')}, chr(10))) AS line
  FROM documents
),
parts AS (
  SELECT run, line_no, regexp_split_to_array({_strip('line')}, ' => | = ') AS parts
  FROM lines WHERE length({_strip('line')}) > 0 AND NOT starts_with(line, 'Scheduling mode')
),
pairs AS (
  SELECT run, line_no, {_strip('parts[1]')} AS key, {_strip('parts[2]')} AS value
  FROM parts WHERE len(parts) = 2
)
SELECT run, key, arg_max(value, line_no) AS value, CAST(max(line_no) AS INTEGER) AS line_no
FROM pairs GROUP BY run, key"""
    q["document_check"] = """
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN json_valid(text) THEN 'ok'
  ELSE 'invalid_json' END AS status FROM documents"""
    written = f"""avatar, date, id, iso_date, likes, TRY_CAST(rating AS DOUBLE) AS rating, rating AS rating_raw,
  response['title'] AS response_title, response['snippet'] AS response_snippet, snippet, title, '{ODATE}' AS odate"""
    both_sides = (f"SELECT 'valid' AS side, {g}{written} FROM reviews WHERE {_VALID} UNION ALL "
                  f"SELECT 'invalid', {g}{written} FROM reviews WHERE {_NULL_INVALID} UNION ALL "
                  f"SELECT 'invalid', {g}{written} FROM ({_dup_rows_sql('app, type_client, id')}) t")
    q["ingest_job_rows"] = r + both_sides
    harmed = """
reviews AS (
  SELECT app, type_client, CAST(NULL AS VARCHAR) AS avatar, CAST(NULL AS VARCHAR) AS date,
    product_id || '-' || length(line) AS id, CAST(NULL AS VARCHAR) AS iso_date, CAST(length(line) AS BIGINT) AS likes,
    CASE WHEN length(line) % 7 = 0 THEN 'bad' ELSE CAST(length(line) % 5 + 1 AS VARCHAR) END AS rating,
    CAST(NULL AS MAP(VARCHAR, VARCHAR)) AS response, CASE WHEN length(line) % 10 <> 0 THEN line END AS snippet,
    CAST(NULL AS VARCHAR) AS title
  FROM page_reviews
)"""
    q["ingest_pages_rows"] = _with(_PAGES, _page_status_sql(), _PAGE_REVIEWS, harmed) + both_sides
    q["single_app_job"] = r + (
        f"SELECT 'valid' AS side, {_OUT}, '{ODATE}' AS odate FROM reviews WHERE {_VALID} UNION ALL "
        f"SELECT 'invalid', {_OUT}, '{ODATE}' FROM reviews WHERE {_NULL_INVALID} UNION ALL "
        f"SELECT 'invalid', {_OUT}, '{ODATE}' FROM ({_dup_rows_sql('id')}) t")
    q["many_duplicates_invalid_reviews"] = q["invalid_reviews"]
    q["sink_outcomes"] = """
SELECT call, ok, CASE WHEN ok THEN n ELSE 0 END AS rows, reason, n AS on_disk
FROM (VALUES ('written', TRUE, ''), ('nothing to write', FALSE, 'no rows'), ('no path', FALSE, 'empty target path'),
  ('no frame', FALSE, 'not a DataFrame: list')) AS o(call, ok, reason), (SELECT count(*) AS n FROM lineitem) AS c"""
    q["job_failure_record"] = """
SELECT count(*) AS reviews, '2024-01-01T12:03:00.500Z' AS timestamp, 'bronze' AS layer, 'reviews' AS project,
  'reviews_ingestion' AS job, '0' AS priority, 'REVIEWS' AS torre, 'UNKNOWN_CLIENT' AS client,
  TRUE AS error_is_the_one_raised, FALSE AS has_success
FROM lineitem"""
    q["rejected_documents"] = """
SELECT doc_id, CASE doc_id % 5 WHEN 2 THEN 'empty data' ELSE 'invalid JSON' END AS reason
FROM documents WHERE doc_id % 5 IN (1, 2, 3)"""
    q["empty_batch_job"] = _with(_PAGES) + """
SELECT app, type_client, product_id, page_no, 'PF' AS client,
  'request failed for product ' || product_id || ' on page 0' AS error, CAST(0 AS BIGINT) AS written, 0 AS documents
FROM pages WHERE page_no = 0"""
    q["empty_apps_failed"] = _with(_PAGES, """
failed AS (
  SELECT * REPLACE (request_ok AND app <> 'app_3' AS request_ok, CASE WHEN app <> 'app_2' THEN app END AS app) FROM pages
)""", _page_status_sql(pages="failed")) + """
SELECT app, type_client FROM page_status GROUP BY app, type_client HAVING count(*) FILTER (WHERE status = 'kept') = 0"""
    cases = """
flat AS (
  SELECT conv_id, turn, (conv_id * 7 + turn) % 23 <> 0 AS request_ok,
    CASE WHEN (conv_id * 5 + turn) % 29 <> 0 THEN text END AS review_text,
    CASE WHEN (conv_id + turn) % 6 <> 5 THEN 'tok' || CAST(turn AS VARCHAR) END AS token
  FROM conversations
),
every AS (
  SELECT conv_id, turn, request_ok, review_text, token, fetch_id FROM flat, (VALUES ('f0'), ('f1')) AS f(fetch_id)
  UNION ALL SELECT conv_id, turn, request_ok, review_text, token, 'f1' FROM flat WHERE turn = 1
  UNION ALL SELECT conv_id, n, request_ok, review_text, CASE WHEN n < 13 THEN 't' END, 'long'
  FROM flat, (SELECT unnest(range(14)) AS n) AS r WHERE turn = 0
),
cases AS (
  SELECT CASE WHEN conv_id % 5 <> 0 THEN 'app_' || CAST(conv_id % 4 AS VARCHAR) END AS app, 'pf' AS type_client,
    CASE WHEN conv_id % 7 <> 0 THEN CAST(conv_id AS VARCHAR) END AS product_id,
    CASE WHEN turn <> 6 THEN CAST(turn AS INTEGER) END AS page_no, request_ok, review_text,
    CASE WHEN (conv_id + turn) % 11 = 0 THEN '' ELSE token END AS next_page_token,
    CASE WHEN conv_id % 7 <> 0 THEN fetch_id ELSE fetch_id || conv_id END AS fetch_id
  FROM every
)"""
    q["page_status_cases"] = _with(cases, _page_status_sql(12, "cases", "fetch_id")) + """
SELECT app, page_no, status, count(*) AS pages FROM page_status GROUP BY ALL"""
    q["corrupt_pages"] = _with(_PAGES, """
whole AS (SELECT * FROM pages WHERE (CAST(product_id AS BIGINT) + page_no) % 13 <> 0)""", _page_status_sql(pages="whole")) + """
SELECT app, type_client, product_id, page_no, status FROM page_status
UNION ALL
SELECT NULL, NULL, NULL, NULL, 'failed_request' FROM pages WHERE (CAST(product_id AS BIGINT) + page_no) % 13 = 0"""
    llm, pipeline = _optional("revisor.llm.queries"), _optional("corpus_pipeline")
    if llm is not None:
        q.update(llm.oracle_sql())
        if pipeline is not None and pipeline.ORACLE_SQL:
            q["pipeline"] = pipeline.ORACLE_SQL
    return q
