"""Run metrics: split counts and shares (E5, E6), the per-(app, client)
metrics document (G6), report-line parsing (G7), failure records (G8) and
the metrics-document rules (G9).

Everything is computed from ``group_summary`` rows (one per app and client),
never from the review rows again: the counts the document needs were folded
into the one key-level aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisor.operators.validation import check_structs

# ---------------------------------------------------------------------------
# The failure message of a reached page without reviews, the
# priority of a failure record and the client of a record without one; the
# separators of a report line and the prefix of lines that don't count; the
# time formats of a document.  The field names in ``document_struct`` and
# ``failure_records`` are fixed values too.
# ---------------------------------------------------------------------------
MSG_MISSING_REVIEWS = "[*] Não foi possível recuperar as avaliações."
FAILURE_PRIORITY = "0"
UNKNOWN_CLIENT = "UNKNOWN_CLIENT"
KEY_VALUE_SEPARATORS = " => | = "
SKIPPED_LINE_PREFIX = "Scheduling mode"
CLOCK_FORMAT = "%Y-%m-%d %H:%M:%S"
# ---------------------------------------------------------------------------

# The characters that Python's ``str.strip()`` removes (Unicode White_Space plus the four ASCII
# information separators).
PY_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")


def utc_millis(t: datetime) -> str:
    """ISO text of a UTC time, to the millisecond."""
    return t.replace(tzinfo=None).isoformat(timespec="milliseconds") + "Z"


@dataclass(frozen=True)
class RunContext:
    """What a run knows about itself; all of it is a parameter so a rerun
    with the same context reproduces the same document."""

    application_id: str = "local"
    start: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    end: datetime | None = None
    timestamp: datetime | None = None
    owner_sigla: str = "DQ"
    project: str = "reviews"
    layer: str = "bronze"
    source_search: str = "google_play"
    job: str = "reviews_ingestion"
    torre: str = "REVIEWS"
    stages: dict[str, str] = field(default_factory=dict)

    def finished(self, end: datetime | None = None) -> "RunContext":
        end = end or datetime.now(timezone.utc)
        return RunContext(**{**self.__dict__, "end": end, "timestamp": self.timestamp or end})

    @property
    def processing_time(self) -> str:
        end = self.end or self.start
        return f"{(end - self.start).total_seconds() / 60:.2f} min"

    @staticmethod
    def _ts(t: datetime) -> str:
        return t.strftime(CLOCK_FORMAT)

    @property
    def start_ts(self) -> str:
        return self._ts(self.start)

    @property
    def end_ts(self) -> str:
        return self._ts(self.end or self.start)

    @property
    def document_ts(self) -> str:
        return utc_millis(self.timestamp or self.end or self.start)


# -- E5 / E6 ------------------------------------------------------------------

def share(part: Column, whole: Column) -> Column:
    """E5: ``part / whole * 100``, 0.0 when ``whole`` is 0."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def _passed_checks() -> Column:
    total = None
    for s in check_structs():
        term = s.getField("status").cast("int")
        total = term if total is None else total + term
    return total


def with_split(summary: DataFrame) -> DataFrame:
    """``group_summary`` rows plus the E4-E6 columns.  The share denominator
    is valid + invalid, which counts an overlapping row (valid and
    duplicated) twice."""
    valid = F.col("valid_records")
    invalid = F.col("invalid_records")
    total = valid + invalid
    passed = _passed_checks()
    return summary.select(
        "*",
        valid.alias("valid_count"),
        invalid.alias("invalid_count"),
        total.alias("valid_plus_invalid"),
        share(valid, total).alias("valid_percentage"),
        share(invalid, total).alias("invalid_percentage"),
        passed.cast("int").alias("success_count"),
        (F.lit(3) - passed).cast("int").alias("error_count"),
    )


def split_metrics(summary: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """E4-E6 per group."""
    return with_split(summary).select(
        *group_cols,
        F.col("total_records").alias("input_records"),
        "valid_count",
        "invalid_count",
        F.col("valid_plus_invalid").alias("total_records"),
        "valid_percentage",
        "invalid_percentage",
        "success_count",
        "error_count",
    )


# -- G6 -----------------------------------------------------------------------

def _string_map(d: dict[str, str]) -> Column:
    if not d:
        return F.create_map().cast("map<string,string>")
    items = []
    for k, v in d.items():
        items += [F.lit(str(k)), F.lit(str(v))]
    return F.create_map(*items)


def document_struct(ctx: RunContext, app_col: str = "app", client_col: str = "type_client",
                    write_ok: Column | None = None) -> Column:
    """G6 document over ``with_split`` rows."""
    structs = check_structs()
    results = F.map_from_arrays(
        F.array(*[s.getField("check") for s in structs]),
        F.array(*[F.struct(s.getField("message").alias("message"), s.getField("status").alias("status"),
                           s.getField("code").alias("code")) for s in structs]),
    )
    return F.struct(
        F.lit(ctx.application_id).alias("application_id"),
        F.struct(F.lit(ctx.owner_sigla).alias("sigla"), F.lit(ctx.project).alias("projeto"),
                 F.lit(ctx.layer).alias("layer_lake")).alias("owner"),
        F.struct(F.col("valid_count").alias("count"), F.col("valid_percentage").alias("percentage")).alias("valid_data"),
        F.struct(F.col("invalid_count").alias("count"),
                 F.col("invalid_percentage").alias("percentage")).alias("invalid_data"),
        F.col("valid_plus_invalid").alias("total_records"),
        F.lit(ctx.processing_time).alias("total_processing_time"),
        _string_map(ctx.stages).alias("stages"),
        results.alias("validation_results"),
        F.col("success_count"),
        F.col("error_count"),
        F.upper(F.col(client_col)).alias("type_client"),
        F.struct(F.col(app_col).alias("app"), F.lit(ctx.source_search).alias("search")).alias("source"),
        F.struct(F.lit(ctx.start_ts).alias(f"{ctx.project}_start_ts"),
                 F.lit(ctx.end_ts).alias(f"{ctx.project}_end_ts")).alias("_ts"),
        F.lit(ctx.document_ts).alias("timestamp"),
        F.col("total_records").alias("input_records"),
        (write_ok if write_ok is not None else F.lit(None).cast("boolean")).alias("write_ok"),
    )


def metrics_documents(summary: DataFrame, ctx: RunContext, app_col: str = "app",
                      client_col: str = "type_client", write_ok: Column | None = None) -> DataFrame:
    """One metrics document per (app, client) row of ``group_summary``:
    the struct ``document`` and its JSON text ``json``.  The run must be
    finished (``ctx.finished()``): a document without an end time raises."""
    if ctx.start is None or ctx.end is None:
        raise ValueError("run start or end time not set; call RunContext.finished() first")
    docs = with_split(summary).select(
        app_col, client_col, document_struct(ctx, app_col, client_col, write_ok).alias("document")
    )
    return docs.withColumn("json", F.to_json("document"))


def document_schema(spark, ctx: RunContext | None = None):
    """Declared type of the ``document`` struct, for reading written
    documents back without inference."""
    from pyspark.sql import types as T

    from revisor.operators.checks import group_summary, key_stats
    from revisor.schemas import BRONZE_SCHEMA

    fields = [T.StructField("app", T.StringType()), T.StructField("type_client", T.StringType()),
              *BRONZE_SCHEMA.fields]
    empty = spark.createDataFrame([], T.StructType(fields))
    summary = group_summary(key_stats(empty, ["app", "type_client"]), ["app", "type_client"])
    return metrics_documents(summary, ctx or RunContext().finished()).schema["document"].dataType


def flat_documents(documents: DataFrame, app_col: str = "app", client_col: str = "type_client") -> DataFrame:
    """The scalar fields of the documents as columns (for comparisons)."""
    d = F.col("document")
    vr = d.getField("validation_results")
    return documents.select(
        app_col, client_col,
        d.getField("owner").getField("sigla").alias("owner_sigla"),
        d.getField("owner").getField("projeto").alias("owner_projeto"),
        d.getField("owner").getField("layer_lake").alias("owner_layer_lake"),
        d.getField("valid_data").getField("count").alias("valid_count"),
        F.round(d.getField("valid_data").getField("percentage"), 6).alias("valid_percentage"),
        d.getField("invalid_data").getField("count").alias("invalid_count"),
        F.round(d.getField("invalid_data").getField("percentage"), 6).alias("invalid_percentage"),
        d.getField("total_records").alias("total_records"),
        d.getField("input_records").alias("input_records"),
        d.getField("success_count").alias("success_count"),
        d.getField("error_count").alias("error_count"),
        d.getField("type_client").alias("doc_type_client"),
        d.getField("source").getField("app").alias("source_app"),
        d.getField("source").getField("search").alias("source_search"),
        vr.getItem("duplicate_check").getField("code").alias("duplicate_code"),
        vr.getItem("duplicate_check").getField("message").alias("duplicate_message"),
        vr.getItem("null_check").getField("code").alias("null_code"),
        vr.getItem("null_check").getField("message").alias("null_message"),
        vr.getItem("type_consistency_check").getField("code").alias("type_code"),
        vr.getItem("type_consistency_check").getField("message").alias("type_message"),
    )


# -- G7 -----------------------------------------------------------------------

def py_strip(c: Column) -> Column:
    """``str.strip()`` of Python: Unicode whitespace at both ends, in time linear in the text."""
    return F.btrim(c, F.lit(PY_SPACE))


def report_lines(reports: DataFrame, run_col: str = "run", text_col: str = "text") -> DataFrame:
    """Whole report texts -> ``run, line_no, line`` (the text is stripped
    as a whole, then split on newlines; line numbers start at 0)."""
    return reports.select(
        F.col(run_col).alias("run"),
        F.posexplode(F.split(py_strip(F.col(text_col)), "\n", -1)).alias("line_no", "line"),
    )


def report_pairs(lines: DataFrame) -> DataFrame:
    """``run, key, value`` from report lines.  Blank lines and lines that
    start with ``Scheduling mode`` are dropped; a line splits on `` => `` or
    `` = ``; only two-part lines count; key and value are stripped; when a key
    repeats within a run, the later line wins."""
    # a line that is blank has no separator, so it never has two parts
    parts = F.split(py_strip(F.col("line")), KEY_VALUE_SEPARATORS, -1)
    kept = lines.where(~F.col("line").startswith(SKIPPED_LINE_PREFIX) & F.col("line").rlike(KEY_VALUE_SEPARATORS))
    pairs = kept.select("run", "line_no", parts.alias("parts")).where(F.size("parts") == 2).select(
        "run", "line_no", py_strip(F.col("parts")[0]).alias("key"), py_strip(F.col("parts")[1]).alias("value"))
    return pairs.groupBy("run", "key").agg(
        F.max_by("value", "line_no").alias("value"), F.max("line_no").alias("line_no")
    )


def report_maps(pairs: DataFrame) -> DataFrame:
    """One ``stages`` map per run (bounded by the distinct keys of a run)."""
    return pairs.groupBy("run").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("stages")
    )


# -- G8 -----------------------------------------------------------------------

def failure_records(failures: DataFrame, ctx: RunContext, client_col: str = "client",
                    error_col: str = "error", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One failure record per input row (``client``, ``error``)."""
    ts = F.lit(ctx.document_ts)
    client = F.col(client_col)
    return failures.select(
        *keep,
        ts.alias("timestamp"),
        F.lit(ctx.layer).alias("layer"),
        F.lit(ctx.project).alias("project"),
        F.lit(ctx.job).alias("job"),
        F.lit(FAILURE_PRIORITY).alias("priority"),
        F.lit(ctx.torre).alias("torre"),
        F.when(client.isNull() | (client == ""), F.lit(UNKNOWN_CLIENT)).otherwise(F.upper(client)).alias("client"),
        F.col(error_col).cast("string").alias("error"),
    )


# -- G9 -----------------------------------------------------------------------

METRICS_TYPES = ("success", "fail")


def check_metrics_arguments(metrics_type: str, error: object = None, data: object = None) -> str:
    """G9 argument rules of the metrics writer; returns the normalised type."""
    t = metrics_type.lower()
    if t not in METRICS_TYPES:
        raise ValueError("metrics type must be 'success' or 'fail'")
    if t == "fail" and not error:
        raise ValueError("a 'fail' record needs an error")
    if t == "success" and data is None:
        raise ValueError("a 'success' record needs data")
    return t


_JSON = {"allowSingleQuotes": "false"}


def _is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    The parser stops after a value, so the text is read twice inside a wrapper:
    as the only element of an array and as the only member of an object.  What
    follows a value breaks one of them, whatever closing bracket it begins
    with."""
    element = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _JSON)) == 1
    member = F.size(F.map_keys(F.from_json(F.concat(F.lit('{"d":'), text, F.lit("}")), "map<string,string>", _JSON))) == 1
    return F.coalesce(element & member, F.lit(False))


def document_check(docs: DataFrame, text_col: str = "text", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """G9 JSON rule over a frame of document texts: ``empty`` (missing or
    empty text), ``ok`` (one JSON value) or ``invalid_json``.

    The grammar is JSON as Spark's parser reads it: any value at the top,
    repeated keys allowed, NaN and Infinity accepted as numbers, no single quotes,
    no trailing content.  It runs inside the JVM.
    """
    text = F.col(text_col)
    status = (
        F.when(text.isNull() | (text == ""), F.lit("empty"))
        .when(_is_json(text), F.lit("ok"))
        .otherwise(F.lit("invalid_json"))
    )
    return docs.select(*keep, status.alias("status"))
