"""revisor — a PySpark batch engine for multi-app review ingestion with
data-quality checks.

Everything is expressed with the DataFrame API so Catalyst plans it and the
executors do the work; the driver only ever sees per-(app, client) summary
rows (a handful per app) and a few scalar counts that pick a join strategy.

Layout:

* ``schemas``     – declared schemas (bronze rows, landed pages, results)
* ``functions``   – column-level helpers (rating cast rule, message text)
* ``sources``     – landed-page reader, page-prefix rule, derived views
* ``operators``   – projections, filters, duplicate detection, validation,
                    metrics documents, report parsing
* ``sinks``       – partitioned Parquet sink, metrics sink
* ``plans``       – the end-to-end batch over all (app, client) pairs
* ``streaming``   – availableNow micro-batch driver over landed page files
"""

from revisor.session import build_session, stage_dir  # noqa: F401

__all__ = ["build_session", "stage_dir"]
