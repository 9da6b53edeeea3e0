"""Golden cases of the three checks and the valid / invalid split."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from revisor.operators import checks
from revisor.operators import metrics as MX
from revisor.operators.validation import validate
from revisor.schemas import BRONZE_SCHEMA

def _row(key, snippet="text", rating=3.0, date="2024-02-01"):
    return (f"https://img.example/{key}", date, key, "2024-02-01T00:00:00Z", 1, rating, None, snippet, "someone")


# One case per rule: what repeats, what lacks a field, what is fine.
RULES = [
    _row("alone"),
    _row("thrice"), _row("thrice"), _row("thrice"),  # every copy stays valid and is invalid as well
    _row("half"), _row("half", snippet=None),  # a repeated id of which one row lacks a field
    _row(None), _row(None),  # NULL ids are one repeated group, but join nothing
    _row("undated", date=None),  # reported, still valid
    _row("unrated", rating=None),  # fails the null check and the type check
]


def _results(v):
    return {r["check"]: r for r in v.results.collect()}


def test_golden_rules(spark):
    v = validate(spark.createDataFrame(RULES, BRONZE_SCHEMA), [])
    res = _results(v)
    assert res["duplicate_check"]["code"] == 409 and not res["duplicate_check"]["status"]
    assert res["duplicate_check"]["message"] == "Registros duplicados encontrados: 3 registros com base no 'id'."
    assert res["null_check"]["code"] == 400
    assert res["null_check"]["message"] == (
        "Valores nulos encontrados nas colunas: {'id': 2, 'snippet': 1, 'rating': 1, 'date': 1}.")
    assert res["type_consistency_check"]["code"] == 400
    assert {r["total_records"] for r in res.values()} == {10}
    assert sorted(r["id"] for r in v.valid.collect()) == ["alone", "half", "thrice", "thrice", "thrice", "undated"]
    assert sorted(str(r["id"]) for r in v.invalid.collect()) == [
        "None", "None", "half", "half", "half", "thrice", "thrice", "thrice", "unrated"]
    assert v.valid.schema == BRONZE_SCHEMA and v.invalid.schema == BRONZE_SCHEMA
    split = MX.split_metrics(v.summary).first()
    assert split["success_count"] == 0 and split["error_count"] == 3
    assert abs(split["valid_percentage"] - 6 / 15 * 100) < 1e-12 and abs(split["invalid_percentage"] - 9 / 15 * 100) < 1e-12


def test_golden_clean(spark):
    v = validate(spark.createDataFrame([_row(k) for k in "abc"], BRONZE_SCHEMA), [])
    res = _results(v)
    assert {r["code"] for r in res.values()} == {200} and all(r["status"] for r in res.values())
    assert res["duplicate_check"]["message"] == "Nenhum registro duplicado encontrado."
    assert res["null_check"]["message"] == "Nenhum valor nulo encontrado nas colunas criticas."
    assert res["type_consistency_check"]["message"] == "Consistência dos tipos de dados verificada com sucesso."
    assert v.valid.count() == 3 and v.invalid.count() == 0
    lines = [r["line"] for r in v.summary_lines.orderBy("line_no").collect()]
    assert lines[0] == "[*] Validação da ingestão concluída para 3 registros."
    assert [x for x in lines if x.endswith("PASSOU")] == [
        "Duplicate Check: PASSOU", "Null Check: PASSOU", "Type Consistency Check: PASSOU"]


def _edge_frame(spark, rows):
    schema = "id string, snippet string, rating string, date string"
    df = spark.createDataFrame(rows, schema)
    for c in ["avatar", "iso_date", "title"]:
        df = df.withColumn(c, F.lit("x"))
    return df.withColumn("likes", F.lit(1).cast("bigint")).withColumn(
        "response", F.lit(None).cast("map<string,string>"))


def test_null_ids_and_overlap(spark):
    rows = [(None, "a", "1", "d"), (None, "b", "2", "d"), ("x", "c", "1", "d"), ("x", None, "1", "d"),
            ("y", "e", None, "d"), ("z", "f", "3", None)]
    v = validate(_edge_frame(spark, rows), [])
    assert v.valid.count() == 2
    assert v.invalid.count() == 6
    s = v.summary.first()
    assert s["duplicate_groups"] == 2  # the NULL group counts
    assert s["duplicate_rows"] == 2  # ... but its rows do not join
    res = _results(v)
    assert res["null_check"]["message"] == (
        "Valores nulos encontrados nas colunas: {'id': 2, 'snippet': 1, 'rating': 1, 'date': 1}.")
    assert not res["type_consistency_check"]["status"]  # NULL rating fails it too
    # the duplicated row with the NULL snippet lands in the invalid side twice
    assert v.invalid.where((F.col("id") == "x") & F.col("snippet").isNull()).count() == 2


def test_date_null_only_is_valid(spark):
    v = validate(_edge_frame(spark, [("z", "f", "3", None)]), [])
    assert v.valid.count() == 1 and v.invalid.count() == 0
    res = _results(v)
    assert res["null_check"]["message"] == "Valores nulos encontrados nas colunas: {'date': 1}."
    assert res["duplicate_check"]["status"] and res["type_consistency_check"]["status"]


def test_bad_and_decimal_rating_strings(spark):
    bad = ["bad", "1e3", "3000000000"]
    good = ["4.5", "5.", "+3", " 5 ", ".5", "-0.4"]
    rows = [(f"b{i}", "s", r, "d") for i, r in enumerate(bad)] + [(f"g{i}", "s", r, "d") for i, r in enumerate(good)]
    df = _edge_frame(spark, rows)
    flagged = {r["rating"] for r in checks.bad_rating_rows(df).collect()}
    assert flagged == set(bad)
    v = validate(df, [])
    assert v.valid.count() == len(rows)  # a bad rating keeps the row valid
    assert not _results(v)["type_consistency_check"]["status"]


def test_numeric_rating_only_null_fails(spark):
    df = spark.createDataFrame([("a", "s", 4.5), ("b", "s", float("nan")), ("c", "s", None)],
                               "id string, snippet string, rating double")
    assert checks.bad_rating_rows(df.withColumn("date", F.lit("d")).withColumn("avatar", F.lit(None).cast("string"))
                                  .withColumn("iso_date", F.lit(None).cast("string"))
                                  .withColumn("likes", F.lit(1).cast("bigint"))
                                  .withColumn("response", F.lit(None).cast("map<string,string>"))
                                  .withColumn("title", F.lit(None).cast("string"))).count() == 1


def test_reply_on_second_row_survives(spark):
    rows = [("https://i/1", "d", "r1", "t", 1, 5.0, None, "ok", "A"),
            ("https://i/2", "d", "r2", "t", 2, 4.0, {"text": "obrigado"}, "ok", "B")]
    v = validate(spark.createDataFrame(rows, BRONZE_SCHEMA), [])
    got = {r["id"]: r["response"] for r in v.valid.collect()}
    assert got["r2"] == {"text": "obrigado"} and got["r1"] is None


def test_empty_input(spark):
    df = spark.createDataFrame([], BRONZE_SCHEMA)
    v = validate(df, [])
    split = MX.split_metrics(v.summary).first()
    assert split["total_records"] == 0
    assert split["valid_percentage"] == 0.0 and split["invalid_percentage"] == 0.0
    assert v.invalid.count() == 0
    grouped = validate(df.withColumn("app", F.lit("a")).withColumn("type_client", F.lit("pf")))
    assert grouped.summary.count() == 0


def test_join_strategies_agree(spark):
    from revisor.sources import tables

    from conftest import SF001

    r = tables.reviews(spark, SF001)
    keys = checks.duplicate_ids(r, ["app", "type_client"])
    cols = ["app", "type_client", "id", "snippet", "rating", "date", "avatar"]

    def rows(**kw):
        out, plan = checks.duplicate_rows_planned(r, keys, ["app", "type_client"], **kw)
        return sorted((tuple(x) for x in out.select(*cols).collect()), key=repr), plan

    base, p0 = rows()
    assert p0.strategy == "broadcast"
    shuffled, p1 = rows(broadcast_max_bytes=0, hot_rows=10**9)
    assert p1.strategy == "shuffle"
    split, p2 = rows(broadcast_max_bytes=0, hot_rows=2)
    assert p2.strategy == "hot_split" and p2.hot_keys > 0
    split3, p3 = rows(broadcast_max_bytes=0, hot_rows=3)
    assert base == shuffled == split == split3
    assert len(base) > 0


def test_hot_key_is_split_not_shuffled(spark):
    """One id holding a third of all rows: the hot branch is a broadcast join."""
    rows = [("hot", "s", "1", "d")] * 300 + [(f"k{i // 2}", "s", "1", "d") for i in range(600)]
    df = _edge_frame(spark, rows).withColumn("app", F.lit("a")).withColumn("type_client", F.lit("pf"))
    v = validate(df, broadcast_max_bytes=0, hot_rows=100)
    assert v.join_plan.strategy == "hot_split" and v.join_plan.hot_keys == 1
    assert v.invalid.count() == 900
    plan = v.invalid._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_partition_count_invariance(spark):
    from revisor.sources import tables

    from conftest import SF001

    r = tables.reviews(spark, SF001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            v = validate(r)
            got.append((sorted((tuple(x) for x in v.summary.collect()), key=repr),
                        sorted((tuple(x) for x in v.invalid.select("app", "id", "snippet").collect()), key=repr)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]


def test_materialized_stats_equal_lazy(spark):
    from revisor.sources import tables

    from conftest import SF001

    r = tables.reviews(spark, SF001)
    lazy = sorted((tuple(x) for x in validate(r).summary.collect()), key=repr)
    mat = sorted((tuple(x) for x in validate(r, materialize=True).summary.collect()), key=repr)
    assert lazy == mat


def test_staging_runs_the_key_shuffle_once(spark):
    from revisor.operators.validation import staged_frame
    from revisor.sources import tables

    from conftest import SF001

    r = tables.reviews(spark, SF001)
    df = staged_frame(checks.key_stats(r, ["app", "type_client"]), ["app", "type_client"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_invalid_side_strategies_agree(spark):
    """The one-pass broadcast form, the shuffled form and the hot/cold split
    give the same invalid rows as the plain union of filter and semi-join."""
    from revisor.sources import tables

    from conftest import SF001

    r = tables.reviews(spark, SF001)
    g = ["app", "type_client"]
    keys = checks.duplicate_ids(r, g)
    cols = ["app", "type_client", "id", "snippet", "rating", "date", "avatar"]

    def rows(df):
        return sorted((tuple(x) for x in df.select(*cols).collect()), key=repr)

    plain = rows(checks.invalid_rows(checks.null_invalid_rows(r, g), checks.duplicate_rows(r, keys, g)))
    got = {}
    for name, kw in {"broadcast": {}, "shuffle": {"broadcast_max_bytes": 0, "hot_rows": 10**9},
                     "hot_split": {"broadcast_max_bytes": 0, "hot_rows": 2}}.items():
        out, plan = checks.invalid_rows_planned(r, keys, g, **kw)
        assert plan.strategy == name
        got[name] = rows(out)
    assert got["broadcast"] == got["shuffle"] == got["hot_split"] == plain


def test_sides_frame_scans_the_source_once(spark, tmp_dir):
    """With broadcast keys the valid and invalid sides come from one scan of
    the review source."""
    from revisor.sources import tables

    from conftest import SF001

    path = tmp_dir + "/bronze"
    tables.reviews(spark, SF001).write.parquet(path)
    v = validate(spark.read.parquet(path), ["app", "type_client"], materialize=True,
                 stage_path=tmp_dir + "/stage")
    sides = v.sides()
    sides.collect()
    plan = sides._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert v.join_plan.strategy == "broadcast"
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "/bronze" in line]
    assert len(scans) == 1, plan
    assert "Exchange hashpartitioning" not in plan  # no shuffle of review rows


def test_staged_table_holds_groups_and_duplicated_keys_only(spark, tmp_dir):
    from revisor.sources import tables

    from conftest import SF001

    r = tables.reviews(spark, SF001)
    g = ["app", "type_client"]
    validate(r, g, materialize=True, stage_path=tmp_dir + "/stage")
    staged = spark.read.parquet(tmp_dir + "/stage")
    n_groups = r.select(*g).distinct().count()
    n_dup_keys = checks.duplicate_ids(r, g).count()
    n_keys = checks.key_counts(r, g).count()
    assert staged.count() == n_groups + n_dup_keys < n_keys


def test_hot_threshold_does_not_grow_with_the_data(spark, monkeypatch):
    keys = spark.createDataFrame([("a", "k%d" % i, 10 ** (i % 7)) for i in range(70)], "app string, id string, count long")
    assert checks._hot_keys(keys, ["app", "id"], "count", None) == (checks.HOT_ROWS, 20)
    assert checks._hot_keys(keys, ["app", "id"], "count", 2) == (2, 60)
    # only where the hot set would not fit does the threshold rise
    monkeypatch.setattr(checks, "HOT_BROADCAST_MAX_BYTES", 500)
    assert checks._hot_keys(keys, ["app", "id"], "count", 100) == (10 ** 6, 10)


def _scans(df, folder):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "FileScan parquet" in line and folder in line]


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_keys_too_many_to_broadcast_take_one_scan(spark, tmp_dir, hot_rows):
    """Above the broadcast limit the rows are read once, and only what the key filter lets pass is shuffled."""
    from revisor.sources import tables

    from conftest import SF001

    tables.reviews(spark, SF001).write.parquet(tmp_dir + "/bronze")
    rows = spark.read.parquet(tmp_dir + "/bronze")
    v = validate(rows, ["app", "type_client"], materialize=True, stage_path=tmp_dir + "/stage", broadcast_max_bytes=0, hot_rows=hot_rows)
    assert v.join_plan.strategy == ("hot_split" if hot_rows else "shuffle")
    assert len(_scans(v.invalid, "/bronze")) == 1
    keys = checks.duplicate_ids(rows, ["app", "type_client"])
    found, _ = checks.duplicate_rows_planned(rows, keys, ["app", "type_client"], broadcast_max_bytes=0, hot_rows=hot_rows)
    assert found.count() == checks.duplicate_rows(rows, keys, ["app", "type_client"]).count() > 0


@pytest.mark.parametrize("most", [None, 1 << 12])
def test_key_filter_has_no_false_negatives(spark, monkeypatch, most):
    """All keys pass, few others do; with the largest size reached more pass and none is missed."""
    if most:
        monkeypatch.setattr(checks, "FILTER_MAX_BYTES", most)
    n = 20_000
    every = spark.range(3 * n).select(F.when(F.col("id") % 2 == 0, "a").alias("app"), F.col("id").cast("string").alias("id"))
    keys = every.where(f"CAST(id AS LONG) < {n}")
    blocks, n_wide = checks.key_filter(keys, ["app", "id"], n)
    wide, block, bits = checks._places(["app", "id"], n_wide)
    marked = every.withColumn("_at", wide * checks._BLOCKS + block).join(blocks, F.col("_at") == F.col("_block"), "left").select(
        (F.col("id").cast("long") < n).alias("own"), checks._perhaps(bits).alias("passes"))
    got = {(r["own"], r["passes"]): r["count"] for r in marked.groupBy("own", "passes").count().collect()}
    assert got[True, True] == n and (True, False) not in got
    assert most or got[False, True] < 0.05 * 2 * n


def test_rows_with_a_settled_reason_are_spread(spark):
    """A third of the rows lacks id, snippet and rating: they meet in no one partition of the join."""
    rows = [(None, None, None, "d")] * 400 + [(f"k{i // 2}", "s", "1", "d") for i in range(800)]
    df = _edge_frame(spark, rows).withColumn("app", F.lit("a")).withColumn("type_client", F.lit("pf"))
    v = validate(df, broadcast_max_bytes=0)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        parted = v.invalid.select(F.spark_partition_id().alias("part"), "id").collect()
        sizes = list(Counter(r["part"] for r in parted if r["id"] is None).values())
    finally:
        for k, value in saved.items():
            spark.conf.set(k, value)
    assert sum(sizes) == 400 and max(sizes) < 200
    assert v.invalid.count() == 1200


def test_staged_empty_batch(spark):
    """Grouped and staged, an input without rows gives empty frames, not an error."""
    df = spark.createDataFrame([], BRONZE_SCHEMA).withColumn("app", F.lit("a")).withColumn("type_client", F.lit("pf"))
    v = validate(df, materialize=True)
    assert v.summary.count() == 0 and v.invalid.count() == 0 and v.join_plan.strategy == "empty"


def _keys_frame(spark):
    """Ids of one to three copies in groups that may be NULL, rows without id, snippet or rating, and one id with many copies."""
    n = F.col("id")
    rows = spark.range(6000).select(
        F.when(n % 17 != 0, F.concat(F.lit("k"), F.when(n % 5 < 2, n - n % 5).otherwise(n).cast("string"))).alias("key"),
        F.when(n % 13 != 0, "s").alias("snippet"), F.when(n % 11 != 0, "1").otherwise("bad").alias("rating"),
        F.when(n % 3 != 0, F.concat(F.lit("a"), (n % 2).cast("string"))).alias("app"))
    many = spark.range(700).select(F.lit("many").alias("key"), F.lit("s").alias("snippet"), F.lit("1").alias("rating"), F.lit("a0").alias("app"))
    null = F.lit(None).cast("string")
    return rows.unionByName(many).select(
        null.alias("avatar"), F.lit("d").alias("date"), F.col("key").alias("id"), null.alias("iso_date"), F.lit(0).cast("bigint").alias("likes"),
        "rating", F.lit(None).cast("map<string,string>").alias("response"), "snippet", null.alias("title"), "app", F.lit("pf").alias("type_client"))


@pytest.mark.parametrize("hot_rows", [None, 100])
@pytest.mark.parametrize("most", [None, 1 << 12])
@pytest.mark.parametrize("groups", [[], ["app", "type_client"]])
def test_staged_runs_shuffle_no_rows(spark, tmp_dir, monkeypatch, hot_rows, most, groups):
    """Keys too many to broadcast: both sides are flagged map-side in one scan, exactly, however full the filter is."""
    if most:
        monkeypatch.setattr(checks, "FILTER_MAX_BYTES", most)
        monkeypatch.setattr(checks, "FILTER_BITS_PER_KEY", 2)
    _keys_frame(spark).write.parquet(tmp_dir + "/bronze")
    rows = spark.read.parquet(tmp_dir + "/bronze")
    v = validate(rows, groups, materialize=True, stage_path=tmp_dir + "/stage", broadcast_max_bytes=0, hot_rows=hot_rows)
    keys = checks.duplicate_ids(rows, groups)
    plain = checks.invalid_rows(checks.null_invalid_rows(rows, groups), checks.duplicate_rows(rows, keys, groups))

    def found(df):
        return Counter(tuple(r) for r in df.select(*groups, "id", "snippet", "rating").collect())

    assert found(v.invalid) == found(plain) and plain.count() > 1000
    assert v.join_plan.strategy == ("hot_split" if hot_rows else "shuffle")
    sides = v.sides()
    assert sides.where("side = 'invalid'").count() == plain.count()
    assert sides.where("side = 'valid'").count() == checks.valid_rows(rows, groups).count()
    for df in (v.invalid, sides):
        assert len(_scans(df, "/bronze")) == 1
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_unsure_keys_too_many_to_broadcast(spark, tmp_dir, monkeypatch):
    """With no room for them the rows are joined behind the exchange, with the same result."""
    rows = _keys_frame(spark)
    want = validate(rows).invalid.count()
    monkeypatch.setattr(checks, "HOT_BROADCAST_MAX_BYTES", -1)
    v = validate(rows, materialize=True, stage_path=tmp_dir + "/stage", broadcast_max_bytes=0)
    assert v.invalid.count() == want
    assert v.sides().where("side = 'invalid'").count() == want


def test_sides_run_as_generated_code(spark, tmp_dir):
    """No lambda above the flags: it would be interpreted for every row, with the probes of the filter below it."""
    v = validate(_keys_frame(spark), ["app", "type_client"], materialize=True, stage_path=tmp_dir + "/stage", broadcast_max_bytes=0)
    plan = v.sides()._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "lambda" not in plan
