"""The ingestion batch over every (app, client) pair of the input at once.

Jobs run, in order (nothing loops over apps, no review row and no group reaches
the driver, only totals do):

1. key statistics — scan of the key and flag columns, one partially
   aggregated shuffle, written once to the shared stage folder;
2. duplicated-key sizing — one small aggregate over that table (picks the
   semi-join strategy);
3. the write — by default both sides in one pass, partitioned by
   ``side / app / type_client / odate``, with the declared types and the
   rating as it came beside the typed one;
4. metrics documents and failure records — one row per app and client, as
   JSON under the run key (load date, load id).

Writes use dynamic partition overwrite so a rerun replaces only the
partitions of the apps in this batch, and its documents.  A layout of two trees
is written aside and published together.  Whatever ends a run early is recorded as
a failure record before it is raised again, and a failed write never leaves a
success document.  Staged tables are removed when the run ends.
"""

from __future__ import annotations

import functools
import logging
import os
import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisor.operators import metrics as MX
from revisor.operators.checks import JoinPlan
from revisor.operators.columns import ensure_column, keep_raw_rating
from revisor.operators.validation import Validation, validate
from revisor.schemas import BRONZE_SCHEMA, GROUP_COLUMNS, WRITTEN_SCHEMA
from revisor.session import release, stage_dir
from revisor.sinks.metrics import DEFAULT_LOAD, save_metrics, save_run_metrics
from revisor.sinks.publish import Publication, recover
from revisor.sinks.parquet import WriteOutcome, cluster_by_group, save_dataframe, target_path
from revisor.sources import pages as P

log = logging.getLogger(__name__)

NO_ROWS = "no rows"


@dataclass
class JobResult:
    totals: dict[str, int]  # groups, total_records, valid_records, invalid_records, duplicate_groups
    valid: WriteOutcome
    invalid: WriteOutcome
    join_plan: JoinPlan | None
    metrics_path: str | None
    failures: int = 0
    empty_groups: int = 0
    empty_path: str | None = None
    failures_path: str | None = None
    timings: dict[str, float] = field(default_factory=dict)


def record_failure(spark: SparkSession, base: str, ctx: MX.RunContext, error: Exception, client: str | None = None,
                   odate: str | None = None, load_id: str | None = None) -> None:
    """G8 for a whole run: one failure record appended under the run key; every attempt leaves its own."""
    try:
        row = spark.createDataFrame([(client, f"{type(error).__name__}: {error}")], "client string, error string")
        records = MX.failure_records(row, ctx).withColumn("odate", F.lit(odate or _today(ctx))).withColumn(
            "load_id", F.lit(load_id or DEFAULT_LOAD))
        records.write.mode("append").partitionBy("odate", "load_id").json(os.path.join(base, "fail"))
    except Exception:  # noqa: BLE001 - the first error is the one to raise
        log.exception("the failure could not be recorded under %s", base)


def _today(ctx: MX.RunContext) -> str:
    return ctx.start.strftime("%Y%m%d")


def _recorded(base_of):
    """Record what a run raises, then raise it; ``base_of`` names the metrics folder of a call."""

    def wrap(run):
        @functools.wraps(run)
        def recorded(spark, *args, ctx: MX.RunContext | None = None, **kwargs):
            ctx = ctx or MX.RunContext(application_id=spark.sparkContext.applicationId)
            try:
                return run(spark, *args, ctx=ctx, **kwargs)
            except Exception as error:
                base, client = base_of(*args, **kwargs)
                record_failure(spark, base, ctx, error, client, kwargs.get("odate"), kwargs.get("load_id"))
                raise

        return recorded

    return wrap


def _batch_base(_rows, out_base, **kwargs):
    return kwargs.get("metrics_base") or os.path.join(out_base, "metrics"), None


def _single_base(_rows, valid_base, _invalid_base, _app, type_client, **kwargs):
    return kwargs.get("metrics_base") or single_app_metrics(valid_base), type_client


def single_app_metrics(valid_base: str) -> str:
    """Default metrics folder of a one-app run: ``metrics`` beside the valid base."""
    return os.path.join(os.path.dirname(valid_base.rstrip("/")), "metrics")


def _checked(*outcomes: WriteOutcome) -> None:
    """A side with no rows at all is not a failed write; anything else that is not ok raises."""
    bad = [f"{o.path}: {o.reason}" for o in outcomes if not o.ok and o.reason != NO_ROWS]
    if bad:
        raise RuntimeError("write failed: " + "; ".join(bad))


def _totals(summary: DataFrame) -> dict[str, int]:
    """Sums over the groups: one row reaches the driver."""
    names = ["total_records", "valid_records", "invalid_records", "duplicate_groups"]
    row = summary.agg(F.count(F.lit(1)).alias("groups"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return {n: int(row[n]) for n in ["groups", *names]}


def _documents(v: Validation, totals: dict[str, int], ctx: MX.RunContext, base: str, odate: str, load_id: str | None,
               own_base: bool) -> str | None:
    """Success documents of the groups, one each for a run key; none for a batch without groups."""
    if len(v.group_cols) != 2:
        log.warning("no metrics documents: they need an app and a client column, the groups are %s", v.group_cols)
        return None
    if not totals["groups"]:
        log.warning("no metrics documents: the batch has no reviews")
        return None
    docs = MX.metrics_documents(v.summary, ctx, *v.group_cols, write_ok=F.lit(True))
    if own_base:
        return save_metrics(docs, base, "success", mode="overwrite")
    covers = v.summary.select(F.col(v.group_cols[0]).alias("app"), F.upper(v.group_cols[1]).alias("client"))
    return save_run_metrics(docs, base, "success", odate=odate, load_id=load_id, covers=covers,
                            about={"source.app": "app", "type_client": "client"})


@_recorded(_batch_base)
def run_reviews(
    spark: SparkSession,
    reviews: DataFrame,
    out_base: str,
    *,
    odate: str | None = None,
    ctx: MX.RunContext | None = None,
    group_cols: list[str] | tuple[str, ...] = tuple(GROUP_COLUMNS),
    overwrite: str = "dynamic",
    join_options: dict | None = None,
    metrics_base: str | None = None,
    rows_per_file: int | None = None,
    layout: str = "sides",
    load_id: str | None = None,
) -> JobResult:
    """Validate ``reviews`` (bronze columns + ``group_cols``), write both
    sides and the metrics documents under ``out_base``.

    Both layouts write ``WRITTEN_SCHEMA``: the declared types, and the rating's
    text in ``rating_raw``, so that a rating that is not a number is kept.
    ``layout="sides"`` (default) writes one tree ``<out>/reviews`` partitioned by
    ``side`` first, in one job — a single pass over the reviews when the
    duplicated keys are broadcast.  ``layout="split"`` writes ``<out>/valid`` and
    ``<out>/invalid`` in two jobs.

    ``load_id`` adds a partition level below ``odate`` (``load_id=<id>``):
    several loads of one day (stream epochs) then each replace only their
    own partitions instead of each other's.  Documents lie under
    ``<out_base>/metrics/success`` by (``odate``, ``load_id``); a rerun replaces
    those of its groups.  An explicit ``metrics_base`` is a folder of this run
    alone (a per-epoch folder) and is overwritten.

    Writes are map-only by default, which suits landed files that each hold
    one app.  ``rows_per_file`` rebalances the rows by group first (one extra
    shuffle, sized at run time) so mixed-app input still yields few, large
    files per partition of so many rows at most, with hot groups spread over
    many tasks."""
    return _run_reviews(spark, reviews, out_base, odate, ctx, list(group_cols), overwrite, join_options, metrics_base,
                        rows_per_file, layout, load_id)


def _run_reviews(spark, reviews, out_base, odate, ctx, group_cols, overwrite, join_options, metrics_base,
                 rows_per_file, layout, load_id) -> JobResult:
    if layout not in ("sides", "split"):
        raise ValueError("layout must be 'sides' or 'split'")
    own_base = metrics_base is not None
    metrics_base = metrics_base or os.path.join(out_base, "metrics")
    odate = odate or _today(ctx)
    recover(spark, out_base)
    both = Publication(spark, out_base)
    reviews = keep_raw_rating(ensure_column(reviews, "response"))
    timings: dict[str, float] = {}
    clock = time.perf_counter()

    def lap(name: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        timings[name] = round(now - clock, 3)
        clock = now

    partitions = [*group_cols, "odate"] + (["load_id"] if load_id is not None else [])

    def save(rows: DataFrame, name: str, keys: list[str]) -> WriteOutcome:
        if rows_per_file and keys:
            rows = cluster_by_group(rows, keys)
        if load_id is not None:
            rows = rows.withColumn("load_id", F.lit(str(load_id)))  # a run-wide literal
        own = partitions if name != "reviews" else ["side", *partitions]
        target = os.path.join(out_base, name)
        out = save_dataframe(rows, target if layout == "sides" else both.aside(target), name, odate=odate, schema=WRITTEN_SCHEMA,
                             strict=True, partition_cols=own, overwrite=overwrite, max_records_per_file=rows_per_file,
                             fresh=layout == "split")
        return out if layout == "sides" else both.add(out, target, overwrite, len(own))

    stage_path = stage_dir(spark, "key-stats")
    try:
        v = validate(reviews, group_cols, materialize=True, stage_path=stage_path, **(join_options or {}))
        lap("key_stats_sec")
        totals = _totals(v.summary)
        if layout == "sides":
            out = save(v.sides(), "reviews", ["side", *group_cols])
            _checked(out)
            if out.rows != totals["valid_records"] + totals["invalid_records"]:
                raise RuntimeError(f"written rows {out.rows} differ from the totals {totals}")
            valid, invalid = (
                WriteOutcome(totals[f"{s}_records"] > 0, totals[f"{s}_records"], os.path.join(out_base, "reviews", f"side={s}"),
                             "" if totals[f"{s}_records"] else NO_ROWS) for s in ("valid", "invalid"))
        else:
            valid = save(v.valid, "valid", group_cols)
            invalid = save(v.invalid, "invalid", group_cols)
            _checked(valid, invalid)
            both.commit()
        lap("write_sec")
        stages = {k: f"{x:.3f}" for k, x in timings.items()}
        stages["join_strategy"] = v.join_plan.strategy
        ctx = replace(ctx, stages={**stages, **ctx.stages}).finished()
        metrics_path = _documents(v, totals, ctx, metrics_base, odate, load_id, own_base)
        lap("metrics_sec")
        log.info("batch done: %s", timings)
        return JobResult(totals, valid, invalid, v.join_plan, metrics_path, timings=timings)
    except Exception:
        both.abort()
        raise
    finally:
        release(spark, stage_path)


@_recorded(_batch_base)
def run_pages(
    spark: SparkSession,
    pages: DataFrame,
    out_base: str,
    *,
    requested: DataFrame | None = None,
    max_pages: int | None = None,
    odate: str | None = None,
    ctx: MX.RunContext | None = None,
    overwrite: str = "dynamic",
    join_options: dict | None = None,
    metrics_base: str | None = None,
    rows_per_file: int | None = None,
    layout: str = "sides",
    load_id: str | None = None,
) -> JobResult:
    """Landed pages -> page-prefix rule -> reviews -> ``run_reviews``; failed
    fetches become failure records; groups without reviews are reported under
    ``<metrics>/empty``, those of ``requested`` (a table of requested fetches with
    the group columns) also where they landed nothing at all.  A rerun replaces
    the records of the groups it covers.  A batch whose pages hold no review
    writes no data and no documents."""
    own_base = metrics_base is not None
    base = metrics_base or os.path.join(out_base, "metrics")
    odate = odate or _today(ctx)
    staged = P.stage_pages(pages, max_pages)
    try:
        group_cols = [c for c in GROUP_COLUMNS if c in pages.columns]
        failures = staged.failures()
        client = F.col("type_client") if "type_client" in failures.columns else F.lit(None).cast("string")
        records = MX.failure_records(failures.withColumn("client", client), ctx,
                                     keep=[*P.fetch_keys(failures), "page_no", "kind"])
        empty = staged.empty_groups(group_cols, requested)
        n_failures, n_empty = records.count(), empty.count()  # both read the small staged status table
        covers = staged.status.select(*group_cols)
        if requested is not None:
            covers = covers.unionByName(requested.select(*group_cols))
        about = {c: c for c in group_cols}
        if own_base:
            failures_path, empty_path = os.path.join(base, "fail"), os.path.join(base, "empty")
            if n_failures:
                save_metrics(records, base, "fail", mode="overwrite")
            if n_empty:
                empty.write.mode("overwrite").json(empty_path)
        else:
            key = {"odate": odate, "load_id": load_id, "covers": covers, "about": about}
            failures_path = save_run_metrics(records, base, "fail", stays=F.col("kind").isNull(), **key)  # a run's own failures
            empty_path = save_run_metrics(empty, base, "empty", **key)
        reviews = staged.reviews().select(*group_cols, *BRONZE_SCHEMA.fieldNames())
        result = _run_reviews(spark, reviews, out_base, odate, ctx, group_cols, overwrite, join_options, metrics_base,
                              rows_per_file, layout, load_id)
    finally:
        staged.release()
    result.failures, result.empty_groups = n_failures, n_empty
    result.failures_path, result.empty_path = failures_path if n_failures else None, empty_path if n_empty else None
    return result


@_recorded(_single_base)
def run_single_app(
    spark: SparkSession,
    reviews: DataFrame,
    valid_base: str,
    invalid_base: str,
    app: str,
    type_client: str,
    *,
    odate: str,
    ctx: MX.RunContext | None = None,
    overwrite: str = "static",
    metrics_base: str | None = None,
) -> JobResult:
    """Parity mode with the one-app-per-run layout: the whole input is one
    app, targets are ``<base>/<app>_<client>/`` partitioned by ``odate``
    only, and a static overwrite replaces that folder (earlier load dates
    included), as a per-app run does.  Both sides are published together, and a
    rerun replaces the document of this app and load date.  Neither side's values are changed: the
    valid side is coerced by the default rules (B4), the invalid side not at
    all."""
    reviews = ensure_column(reviews, "response")
    stage_path = stage_dir(spark, "single-app")
    recover(spark, valid_base)
    both = Publication(spark, valid_base)
    valid_target, invalid_target = target_path(valid_base, app, type_client), target_path(invalid_base, app, type_client)
    try:
        v = validate(reviews, [], materialize=True, stage_path=stage_path)
        valid = save_dataframe(v.valid, both.aside(valid_target), "valid", odate=odate, schema=BRONZE_SCHEMA, overwrite=overwrite,
                               fresh=True)
        invalid = save_dataframe(v.invalid, both.aside(invalid_target), "invalid", odate=odate, overwrite=overwrite, fresh=True)
        _checked(valid, invalid)
        valid, invalid = both.add(valid, valid_target, overwrite, 1), both.add(invalid, invalid_target, overwrite, 1)
        both.commit()
        summary = v.summary.select(F.lit(app).alias("app"), F.lit(type_client).alias("type_client"), "*")
        docs = MX.metrics_documents(summary, ctx.finished(), write_ok=F.lit(True))
        covers = spark.createDataFrame([(app, type_client.upper())], "app string, client string")
        metrics_path = save_run_metrics(docs, metrics_base or single_app_metrics(valid_base), "success", odate=odate, load_id=None,
                                        covers=covers, about={"source.app": "app", "type_client": "client"})
        return JobResult(_totals(v.summary), valid, invalid, v.join_plan, metrics_path)
    except Exception:
        both.abort()
        raise
    finally:
        release(spark, stage_path)
