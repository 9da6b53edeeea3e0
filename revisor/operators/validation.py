"""``validate``: the three data-quality checks and the valid / invalid split
for every (app, client) group of a batch at once (G1-G5).

Plan shape (see ``checks`` for the scale notes):

1. ``key_stats``: one aggregation over (group…, id) — the only shuffle that
   sees every row, and it carries only keys and a few counters.  With
   ``materialize=True`` its two products (per-group totals and duplicated
   keys) are written once as Parquet under the shared checkpoint folder,
   which cuts lineage and survives executor loss; every later consumer reads
   that small table.
2. Per-group counts, check results and summary text derive from the totals;
   they are one row per group (or three, for the results).
3. Valid and NULL-invalid rows are map-only filters of the input.
4. Rows of duplicated keys come from a semi-join whose strategy is chosen
   from the measured size of the duplicated-key set.

With no grouping columns the results equal the single-app semantics: NULL
ids form one duplicate group (counted) but never join (their rows are not
added to the invalid side); a duplicated row with a NULL snippet lands in the
invalid side twice; the valid side keeps all copies of a duplicated key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisor.functions import messages as M
from revisor.operators import checks
from revisor.operators.checks import JoinPlan
from revisor.schemas import GROUP_COLUMNS
from revisor.session import stage_dir


def check_structs() -> list[Column]:
    """G1-G3 as three struct columns over ``group_summary`` output:
    ``check_no, check, status, code, message``."""
    dup = F.col("duplicate_groups")
    nulls = {
        "id": F.col("null_id"),
        "snippet": F.col("null_snippet"),
        "rating": F.col("null_rating"),
        "date": F.col("null_date"),
    }
    no_nulls = None
    for c in nulls.values():
        no_nulls = (c == 0) if no_nulls is None else (no_nulls & (c == 0))
    bad = F.col("bad_ratings")

    def result(no: int, check: str, ok: Column, fail_code: int, message: Column) -> Column:
        return F.struct(
            F.lit(no).alias("check_no"),
            F.lit(check).alias("check"),
            ok.alias("status"),
            F.when(ok, F.lit(M.CODE_OK)).otherwise(F.lit(fail_code)).cast("int").alias("code"),
            message.alias("message"),
        )

    return [
        result(0, M.CHECK_DUPLICATE, dup == 0, M.CODE_CONFLICT, M.duplicate_message(dup)),
        result(1, M.CHECK_NULL, no_nulls, M.CODE_BAD_DATA, M.null_message(nulls)),
        result(2, M.CHECK_TYPE, bad == 0, M.CODE_BAD_DATA, M.type_message(bad)),
    ]


def check_results(summary: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """G1-G3 (+ E2): three rows per group — ``check, status, code, message,
    total_records`` — from ``group_summary`` output."""
    return summary.select(*group_cols, F.col("total_records"), F.inline(F.array(*check_structs()))).select(
        *group_cols, "check_no", "check", "status", "code", "message", "total_records"
    )


def summary_lines(results: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The printed report as rows ``line_no, line`` per group — a header,
    then per check ``Label: PASSOU|FALHOU`` and ``  -> message``."""
    header = results.where(F.col("check_no") == 0).select(
        *group_cols, F.lit(0).alias("line_no"), M.summary_header(F.col("total_records")).alias("line")
    )
    label = results.select(
        *group_cols,
        (F.col("check_no") * 2 + 1).alias("line_no"),
        F.concat(M.check_label(F.col("check")), F.lit(": "), M.status_word(F.col("status"))).alias("line"),
    )
    detail = results.where(F.length("message") > 0).select(
        *group_cols,
        (F.col("check_no") * 2 + 2).alias("line_no"),
        F.concat(F.lit("  -> "), F.col("message")).alias("line"),
    )
    return header.unionByName(label).unionByName(detail)


SUMMARY_PART = "summary"
DUP_KEYS_PART = "dup_keys"


def staged_frame(stats: DataFrame, group_cols: list[str]) -> DataFrame:
    """The per-group totals and the duplicated keys of ``key_stats`` as one
    frame with a ``part`` column.  The duplicated-key branch keeps every
    per-key counter so that both branches prune to the same aggregate and
    share one exchange (the key-level shuffle runs once)."""
    summary = checks.group_summary(stats, group_cols)
    sum_cols = [c for c in summary.columns if c not in group_cols]
    key_cols = [c for c in stats.columns if c not in group_cols and c != "id"]
    dups = stats.where(F.col("n") > 1)
    return summary.select(
        F.lit(SUMMARY_PART).alias("part"), *group_cols, F.lit(None).cast("string").alias("id"),
        *[F.lit(None).cast("bigint").alias(c) for c in key_cols], *sum_cols,
    ).unionByName(
        dups.select(F.lit(DUP_KEYS_PART).alias("part"), *group_cols, "id", *key_cols,
                    *[F.lit(None).cast(summary.schema[c].dataType).alias(c) for c in sum_cols])
    )


def stage_tables(stats: DataFrame, group_cols: list[str], path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``staged_frame`` once, partitioned by ``part``, and read the
    two parts back.  The staged table holds #groups + #duplicated keys rows,
    not one row per key, so it stays small next to the input."""
    spark = stats.sparkSession
    frame = staged_frame(stats, group_cols)
    frame.write.mode("overwrite").partitionBy("part").parquet(path)
    # the declared schema: a batch without rows leaves no file to infer one from
    back = spark.read.schema(frame.schema).parquet(path)
    sum_cols = [c for c in checks.group_summary(stats, group_cols).columns if c not in group_cols]
    return (
        back.where(F.col("part") == SUMMARY_PART).select(*group_cols, *sum_cols),
        back.where(F.col("part") == DUP_KEYS_PART).select(*group_cols, "id", F.col("n").alias("count")),
    )


@dataclass
class Validation:
    """Lazily built outputs of one validation run."""

    source: DataFrame
    group_cols: list[str]
    stats: DataFrame
    join_options: dict = field(default_factory=dict)
    staged_summary: DataFrame | None = None
    staged_keys: DataFrame | None = None
    stage_path: str | None = None
    _invalid: DataFrame | None = None
    _join_plan: JoinPlan | None = None

    @property
    def summary(self) -> DataFrame:
        if self.staged_summary is not None:
            return self.staged_summary
        return checks.group_summary(self.stats, self.group_cols)

    @property
    def results(self) -> DataFrame:
        return check_results(self.summary, self.group_cols)

    @property
    def summary_lines(self) -> DataFrame:
        return summary_lines(self.results, self.group_cols)

    @property
    def valid(self) -> DataFrame:
        return checks.valid_rows(self.source, self.group_cols)

    @property
    def null_invalid(self) -> DataFrame:
        return checks.null_invalid_rows(self.source, self.group_cols)

    @property
    def duplicate_keys(self) -> DataFrame:
        if self.staged_keys is not None:
            return self.staged_keys
        return self.stats.where(F.col("n") > 1).select(*self.group_cols, "id", F.col("n").alias("count"))

    def _plan_duplicates(self) -> None:
        if self._invalid is None:
            self._invalid, self._join_plan = checks.invalid_rows_planned(
                self.source, self.duplicate_keys, self.group_cols, stage_path=self.stage_path, **self.join_options
            )

    @property
    def invalid(self) -> DataFrame:
        self._plan_duplicates()
        return self._invalid

    def sides(self) -> DataFrame:
        """Valid and invalid rows in one frame with a ``side`` column (one
        pass over the input when the duplicated keys are broadcast)."""
        rows, plan = checks.side_rows_planned(self.source, self.duplicate_keys, self.group_cols,
                                              stage_path=self.stage_path, **self.join_options)
        self._join_plan = self._join_plan or plan
        return rows

    @property
    def join_plan(self) -> JoinPlan:
        if self._join_plan is None:
            self._plan_duplicates()
        return self._join_plan


def validate(
    df: DataFrame,
    group_cols: list[str] | tuple[str, ...] | None = None,
    *,
    materialize: bool = False,
    stage_path: str | None = None,
    **join_options,
) -> Validation:
    """G4 over a batch.  ``group_cols`` defaults to ``app, type_client`` when
    both are present, else the whole input is one group.

    ``materialize=True`` runs the key-level aggregation once and stages its
    two products (per-group totals, duplicated keys) as Parquet under
    ``stage_path`` or a fresh folder in the shared checkpoint folder; the
    counts, the check results and the join sizing then read that small table
    and lineage is cut there.
    """
    if group_cols is None:
        group_cols = [c for c in GROUP_COLUMNS if c in df.columns]
        if len(group_cols) != len(GROUP_COLUMNS):
            group_cols = []
    group_cols = list(group_cols)
    stats = checks.key_stats(df, group_cols)
    v = Validation(source=df, group_cols=group_cols, stats=stats, join_options=join_options)
    if materialize:
        if stage_path is None:
            stage_path = stage_dir(df.sparkSession, "validation")
        v.staged_summary, v.staged_keys = stage_tables(stats, group_cols, stage_path)
        v.stage_path = stage_path
    return v
