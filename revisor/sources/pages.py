"""Landed API pages: reader (A1), page-prefix rule (A2), flattening (A3),
empty-group report (A5) and fetch failures (G8 input).

The rule replays the paging loop of every fetch at once.  A *fetch* is one
``(app, type_client, product_id, fetch_id)`` (NULLs compare as equal); its pages
are numbered from 0:

* a page is *reached* when every earlier number was landed and none of those
  pages ended the chain; a page ends the chain when its request failed, when
  its token is NULL or empty, or when it has no reviews;
* a reached good page with reviews is kept;
* a reached failed request is not kept (earlier pages are) and is reported;
* a reached good page *without* reviews fails the whole fetch: none of its
  pages are kept and it is reported.

Every landed page gets exactly one status, the ones outside any chain too: a
line that is no page is a failed request, a page without a usable number is
``unnumbered`` and one at or beyond an explicit cap is ``over_cap``.  Of a number
that was landed more than once in one fetch, a good page with reviews counts
before others and then the one read first; the chain goes on if any copy lets
it.  Good copies whose reviews differ from it share its status (two fetches
landed without a fetch id lose nothing), all other copies are
``repeated_page``.  Repeated and unnumbered pages that held reviews are reported.

Scale: a page is known by its row in the landing.  Parquet landings have one, the
file and the row's place in it, so no page is copied; other landings (JSON) are
parsed once into a staged table that numbers its rows.  The rule reads only narrow
columns and a digest of the reviews; copies and then repeated numbers are folded
by aggregations that combine on the map side, so the window over a fetch holds one
row per distinct page number even where the key is NULL or hot.  Kept pages are a
filter on the scan by their row, which is unique: of the kept and the other rows the
smaller side is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisor.schemas import CORRUPT_COLUMN, GROUP_COLUMNS, LANDED_SCHEMA, PAGE_SCHEMA
from revisor.session import release, stage_dir

KEPT = "kept"
FAILED_REQUEST = "failed_request"
MISSING_REVIEWS = "missing_reviews"
NOT_REACHED = "not_reached"
PRODUCT_FAILED = "product_failed"
OVER_CAP = "over_cap"
REPEATED_PAGE = "repeated_page"
UNNUMBERED = "unnumbered"

ROW = "page_row"
# Most rows (16 bytes each) that a filter of pages takes by broadcast.
KEPT_BROADCAST_MAX_ROWS = 4_000_000
# Plans whose every row is one row of a file.
_ROW_KEEPING = {"Project", "Filter", "LogicalRelation", "SubqueryAlias", "View"}


def read_landed_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A1: landed pages with the declared schema (never inferred).  The token
    is read from the page or from the response's paging object; a line that is
    not a page keeps its text in ``corrupt_line`` and has NULLs elsewhere."""
    reader = spark.read.schema(LANDED_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    token = F.coalesce("next_page_token", "serpapi_pagination.next_page_token")
    return reader.format(fmt).load(path).select(
        *[c for c in PAGE_SCHEMA.fieldNames() if c != "next_page_token"], token.alias("next_page_token"), CORRUPT_COLUMN)


def product_keys(pages: DataFrame) -> list[str]:
    return [c for c in (*GROUP_COLUMNS, "product_id") if c in pages.columns]


def fetch_keys(pages: DataFrame) -> list[str]:
    return product_keys(pages) + [c for c in ("fetch_id",) if c in pages.columns]


def _has_row_places(pages: DataFrame) -> bool:
    """Whether each row of ``pages`` is one row of a file that knows its place: nothing but projections and filters
    above the scan of a format with row numbers (Parquet)."""
    try:
        node = pages._jdf.queryExecution().analyzed()
        while node.children().size() == 1 and node.nodeName() in _ROW_KEEPING:
            node = node.children().head()
        if node.nodeName() not in _ROW_KEEPING or node.children().size():
            return False
        return "row_index" in pages.select("_metadata").schema["_metadata"].dataType.fieldNames()
    except Exception:  # noqa: BLE001 - a remote session shows no plan, a source that is no file has no such column
        return False


def identified(pages: DataFrame) -> tuple[DataFrame, list[str]]:
    """``pages`` with ``page_row``, a row identity that every read of them repeats, and the folders staged for it.

    The identity is (file, row in the file) where Spark knows both; otherwise the
    pages are written once and numbered.
    """
    if _has_row_places(pages):
        return pages.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
                            .alias(ROW)), []
    spark = pages.sparkSession
    path = stage_dir(spark, "pages")
    row = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"))
    numbered = pages.withColumn(ROW, row)
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path), [path]


def _only(pages: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of pages by their row."""
    own = rows.select(F.col(ROW + ".file").alias("_file"), F.col(ROW + ".row").alias("_row"))
    return pages.join(own, (F.col(ROW + ".file") == F.col("_file")) & (F.col(ROW + ".row") == F.col("_row")), how).drop(ROW)


@dataclass
class StagedPages:
    """The pages, their staged statuses and what derives from both."""

    pages: DataFrame
    status: DataFrame
    paths: list[str]
    most_kept: int  # bounds of the number of kept and of other rows, counted while the statuses were written
    most_other: int

    def kept(self) -> DataFrame:
        """A2: the pages a fetch would have concatenated, with all their columns.

        The smaller one of kept and other rows is broadcast, and no page is
        shuffled; a landing with more of both than may be broadcast is joined."""
        is_kept = F.col("status") == KEPT
        kept, other = self.status.where(is_kept).select(ROW), self.status.where(~is_kept).select(ROW)
        if self.most_other < self.most_kept and self.most_other <= KEPT_BROADCAST_MAX_ROWS:
            return _only(self.pages, F.broadcast(other), "left_anti")
        return _only(self.pages, F.broadcast(kept) if self.most_kept <= KEPT_BROADCAST_MAX_ROWS else kept, "left_semi")

    def reviews(self) -> DataFrame:
        return page_reviews(self.kept())

    def failures(self, missing_message: str | None = None) -> DataFrame:
        return failures_from_status(self.status, missing_message)

    def empty_groups(self, group_cols: list[str] | tuple[str, ...], requested: DataFrame | None = None) -> DataFrame:
        """A5: groups that were landed or ``requested`` but kept no review, from the statuses alone.

        ``n_pages`` counts a group's landed pages where ``requested`` is given:
        0 for a request that landed nothing.  Both sides are folded by one
        aggregation that combines on the map side, so NULL keys match and a hot
        group or a request asked for many times never meets in one task.
        """
        held = F.when(F.col("status") == KEPT, F.col("n_reviews")).otherwise(0).cast("long")
        sides = self.status.select(*group_cols, held.alias("_held"), F.lit(1).cast("long").alias("_page"))
        if requested is not None:
            none = F.lit(0).cast("long")
            sides = sides.unionByName(requested.select(
                *[F.col(c).cast(self.status.schema[c].dataType) for c in group_cols], none.alias("_held"), none.alias("_page")))
        empty = sides.groupBy(*group_cols).agg(F.sum("_held").alias("_held"), F.sum("_page").alias("n_pages")).where("_held = 0")
        return empty.select(*group_cols, *([] if requested is None else ["n_pages"]))

    def release(self) -> None:
        release(self.pages.sparkSession, *self.paths)


def stage_pages(pages: DataFrame, max_pages: int | None = None, reviews_col: str = "reviews") -> StagedPages:
    """Give every page its status, staged without the pages themselves where the landing knows its rows.

    ``max_pages`` caps the pages of a fetch (none by default: what was landed is
    read).  ``reviews_col`` may be an array or any column that is NULL where a
    page has no reviews.
    """
    spark = pages.sparkSession
    known, paths = identified(pages)
    path = stage_dir(spark, "page-status")
    status = _status(known, max_pages, reviews_col)
    seen = Observation("page_status")
    is_kept = F.col("status") == KEPT
    status.observe(seen, F.count_if(is_kept).alias("kept"), F.count_if(~is_kept).alias("other"),
                   F.count("differs").alias("differ")).write.parquet(path)
    counts = {k: seen.get.get(k) or 0 for k in ("kept", "other", "differ")}
    staged = spark.read.schema(status.schema).parquet(path)
    if counts["differ"]:
        staged = _settled(staged)
    return StagedPages(known, staged.drop("differs"), [*paths, path], counts["kept"], counts["other"] + counts["differ"])


def _status(pages: DataFrame, max_pages: int | None, reviews_col: str) -> DataFrame:
    keys = fetch_keys(pages)
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in pages.columns else F.lit(False)
    has_reviews = F.col(reviews_col).isNotNull()
    n_reviews = F.size(reviews_col) if isinstance(pages.schema[reviews_col].dataType, T.ArrayType) else F.lit(1)
    ok = F.coalesce(F.col("request_ok"), F.lit(False))
    token = F.col("next_page_token")
    good = ok & has_reviews
    narrow = pages.select(
        *keys, "page_no", ROW, corrupt.alias("corrupt"), ok.alias("ok"), has_reviews.alias("has_reviews"),
        F.when(good, F.md5(F.to_json(F.struct(F.col(reviews_col).alias("r"))))).alias("content"),
        (~ok | token.isNull() | (token == "") | ~has_reviews).alias("ends"),
        F.when(has_reviews, n_reviews).otherwise(0).cast("long").alias("n_reviews"),
    )
    numbered = F.coalesce(F.col("page_no") >= 0, F.lit(False))
    over_cap = F.lit(False) if max_pages is None else numbered & (F.col("page_no") >= max_pages)
    # one page per number: a good one if there is any, then the first row; an aggregation that combines on the map
    # side, so a hot or NULL key never meets in one task
    best = F.min(F.struct(F.col("content").isNull().alias("bad"), ROW, "content", "ok", "has_reviews"))
    chosen = (narrow.where(~F.col("corrupt") & numbered & ~over_cap).groupBy(*keys, "page_no")
              .agg(best.alias("best"), F.min("ends").alias("ends")).select(*keys, "page_no", "best.*", "ends"))
    ordered = Window.partitionBy(*keys).orderBy("page_no")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    reached = (F.col("page_no") == F.row_number().over(ordered) - 1) & ~F.coalesce(
        F.max("ends").over(earlier), F.lit(False))
    chosen = chosen.withColumn("reached", reached)
    fails = F.max(F.col("reached") & F.col("ok") & ~F.col("has_reviews")).over(Window.partitionBy(*keys))
    in_chain = (
        F.when(~F.col("reached"), F.lit(NOT_REACHED))
        .when(~F.col("ok"), F.lit(FAILED_REQUEST))
        .when(~F.col("has_reviews"), F.lit(MISSING_REVIEWS))
        .when(fails, F.lit(PRODUCT_FAILED))
        .otherwise(F.lit(KEPT))
    )
    by_number = chosen.select(*[F.col(c).alias("_n_" + c) for c in (*keys, "page_no", ROW, "content")], in_chain.alias("in_chain"))
    same = F.lit(True)
    for c in (*keys, "page_no"):
        same = same & F.col(c).eqNullSafe(F.col("_n_" + c))
    # a good copy whose reviews differ from the chosen one's waits for ``_settled``
    status = (
        F.when(F.col("corrupt"), F.lit(FAILED_REQUEST))
        .when(~numbered, F.lit(UNNUMBERED))
        .when(over_cap, F.lit(OVER_CAP))
        .when((F.col(ROW) == F.col("_n_" + ROW)) | F.coalesce(F.col("content") != F.col("_n_content"), F.lit(False)), F.col("in_chain"))
        .otherwise(F.lit(REPEATED_PAGE))
    )
    differs = F.when((F.col(ROW) != F.col("_n_" + ROW)) & (F.col("content") != F.col("_n_content")), F.col("content"))
    return narrow.join(by_number, same, "left").select(
        *keys, "page_no", ROW, "corrupt", F.col("ok").alias("request_ok"), "n_reviews", status.alias("status"),
        differs.alias("differs"))


def _settled(status: DataFrame) -> DataFrame:
    """The statuses where some good copies differ from the chosen one: equal ones among them count once."""
    keys = fetch_keys(status)
    waits = status.where(F.col("differs").isNotNull())
    first = waits.groupBy(*keys, "page_no", "differs").agg(F.min(ROW).alias("_first")).select("_first", F.lit(True).alias("_is_first"))
    found = waits.join(first, F.col(ROW) == F.col("_first"), "left").withColumn(
        "status", F.when(F.col("_is_first"), F.col("status")).otherwise(F.lit(REPEATED_PAGE)))
    return status.where(F.col("differs").isNull()).unionByName(found.select(status.columns))


def page_status(pages: DataFrame, max_pages: int | None = None, reviews_col: str = "reviews") -> DataFrame:
    """A2: every landed page with its ``status`` (narrow columns, staged)."""
    return stage_pages(pages, max_pages, reviews_col).status


def kept_pages(pages: DataFrame, max_pages: int | None = None, reviews_col: str = "reviews") -> DataFrame:
    """A2: the pages a fetch would have concatenated."""
    return stage_pages(pages, max_pages, reviews_col).kept()


def page_reviews(kept: DataFrame) -> DataFrame:
    """A3: one row per review of the kept pages (``review_no`` is the
    position within its page)."""
    keys = fetch_keys(kept)
    return kept.select(
        *keys, "page_no", F.posexplode("reviews").alias("review_no", "r")
    ).select(*keys, "page_no", "review_no", "r.*")


def fetch_failures(pages: DataFrame, max_pages: int | None = None, reviews_col: str = "reviews",
                   missing_message: str | None = None) -> DataFrame:
    """Failed pages: a failed request (earlier pages kept), a line that is no
    page, a reached good page without reviews (the fetch fails), or a repeated
    or unnumbered page that held reviews (they are not kept).  Columns:
    fetch keys, ``page_no``, ``kind`` and ``error`` text."""
    return stage_pages(pages, max_pages, reviews_col).failures(missing_message)


def failures_from_status(status: DataFrame, missing_message: str | None = None) -> DataFrame:
    """``fetch_failures`` over staged page statuses."""
    if missing_message is None:
        from revisor.operators.metrics import MSG_MISSING_REVIEWS

        missing_message = MSG_MISSING_REVIEWS
    unused = F.col("status").isin(REPEATED_PAGE, UNNUMBERED) & (F.col("n_reviews") > 0)
    bad = status.where(F.col("status").isin(FAILED_REQUEST, MISSING_REVIEWS) | unused)

    def named(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("NULL"))

    error = (
        F.when(F.col("corrupt"), F.lit("landed line is not a page"))
        .when(F.col("status") == FAILED_REQUEST, F.concat(F.lit("request failed for product "), named("product_id"),
                                                          F.lit(" on page "), named("page_no")))
        .when(F.col("status") == REPEATED_PAGE, F.concat(F.lit("repeated page "), named("page_no"), F.lit(" of product "),
                                                         named("product_id"), F.lit(" not kept")))
        .when(F.col("status") == UNNUMBERED, F.concat(F.lit("page without a usable number of product "),
                                                      named("product_id"), F.lit(" not kept")))
        .otherwise(F.lit(missing_message))
    )
    return bad.select(*fetch_keys(status), "page_no", F.col("status").alias("kind"), error.alias("error"))


def empty_groups(requested: DataFrame, rows: DataFrame, group_cols: list[str] | tuple[str, ...]) -> DataFrame:
    """A5: requested groups without a single row, a NULL key being a group like
    any other.  ``rows`` is reduced to one row per group (partial aggregation)
    before the anti join, so a hot group never reaches one task."""
    found = rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    found = found.select(*[F.col(c).alias("_f_" + c) for c in group_cols])
    cond = F.lit(True)
    for c in group_cols:
        cond = cond & F.col(c).eqNullSafe(F.col("_f_" + c))
    return requested.select(*group_cols).join(found, cond, "left_anti")
