"""Command line: ``python -m revisor <mode> ...``, or on a cluster
``spark-submit --py-files revisor.zip revisor/__main__.py <mode> ...``.

Modes:

* ``pages``      landed page files -> page-prefix rule -> validation -> sinks
* ``reviews``    a review table (Parquet/JSON with the bronze columns plus
                 ``app``/``type_client``) -> validation -> sinks
* ``single-app`` one app's reviews, written to ``<base>/<app>_<client>/``

The session is taken with ``getOrCreate()`` so the cluster's settings apply
(``spark.checkpoint.dir`` in particular); Spark's web UI stays off unless
``--spark-ui`` is given.  A run that fails is recorded under ``metrics/fail``
and ends the process with its error.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _args(argv: list[str] | None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="revisor")
    sub = ap.add_subparsers(dest="mode", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--out", required=True, help="output base folder")
    common.add_argument("--odate", required=True, help="load date, yyyyMMdd")
    common.add_argument("--format", default=None, help="input format (json for pages, parquet for reviews)")
    common.add_argument("--application-id", default=None)
    common.add_argument("--spark-ui", action="store_true", help="start Spark's web UI (off by default)")
    common.add_argument("--load-id", default=None,
                        help="extra partition level below odate, for several loads of one day")
    p = sub.add_parser("pages", parents=[common])
    p.add_argument("--landing", required=True)
    p.add_argument("--requested", default=None, help="table of requested fetches (app, type_client, ...): those that landed "
                                                     "nothing are reported as empty")
    p.add_argument("--requested-format", default="parquet")
    p.add_argument("--max-pages", type=int, default=None, help="read at most so many pages of a fetch (default: all)")
    p.add_argument("--rows-per-file", type=int, default=None)
    p.add_argument("--layout", choices=["sides", "split"], default="sides")
    r = sub.add_parser("reviews", parents=[common])
    r.add_argument("--input", required=True)
    r.add_argument("--rows-per-file", type=int, default=None)
    r.add_argument("--layout", choices=["sides", "split"], default="sides")
    s = sub.add_parser("single-app", parents=[common])
    s.add_argument("--input", required=True)
    s.add_argument("--app", required=True)
    s.add_argument("--client", required=True)
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = _args(argv)
    builder = SparkSession.builder.appName(f"revisor-{a.mode}")
    if not a.spark_ui:
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    from revisor.operators.metrics import RunContext
    from revisor.plans import job

    ctx = RunContext(application_id=a.application_id or spark.sparkContext.applicationId)
    if a.mode == "pages":
        from revisor.schemas import REQUEST_SCHEMA
        from revisor.sources.pages import read_landed_pages

        pages = read_landed_pages(spark, a.landing, a.format or "json")
        requested = spark.read.format(a.requested_format).schema(REQUEST_SCHEMA).load(a.requested) if a.requested else None
        res = job.run_pages(spark, pages, a.out, requested=requested, max_pages=a.max_pages, odate=a.odate, ctx=ctx,
                            rows_per_file=a.rows_per_file, layout=a.layout, load_id=a.load_id)
    else:
        reader = spark.read.format(a.format or "parquet")
        reviews = reader.load(a.input)
        if a.mode == "reviews":
            res = job.run_reviews(spark, reviews, a.out, odate=a.odate, ctx=ctx, rows_per_file=a.rows_per_file,
                                  layout=a.layout, load_id=a.load_id)
        else:
            res = job.run_single_app(spark, reviews, f"{a.out}/valid", f"{a.out}/invalid", a.app, a.client,
                                     odate=a.odate, ctx=ctx, metrics_base=f"{a.out}/metrics")
    print(json.dumps({
        "valid_rows": res.valid.rows, "invalid_rows": res.invalid.rows,
        "join": res.join_plan.strategy if res.join_plan else None,
        "totals": res.totals, "failures": res.failures, "empty_groups": res.empty_groups,
        "empty_path": res.empty_path, "metrics_path": res.metrics_path, "timings": res.timings,
    }, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
