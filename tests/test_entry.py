"""Driver contract smoke checks."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "id" in df.columns


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_valid_reviews_plan_is_map_only(spark):
    plan = E.q_valid_reviews(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and "Exchange" not in plan


def test_valid_filter_reaches_the_scan(spark, tmp_dir):
    """On a bronze Parquet source the C1 predicate is pushed into the scan and
    only the projected columns are read."""
    from revisor.operators import checks
    from revisor.sources import tables

    path = tmp_dir + "/bronze"
    tables.reviews(spark, "/root/testdata/sf0.001").write.parquet(path)
    plan = checks.valid_rows(spark.read.parquet(path), ["app", "type_client"]).select("app", "id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), IsNotNull(snippet), IsNotNull(rating)]" in text
    assert "ReadSchema: struct<id:string,rating:string,snippet:string,app:string>" in text


def test_queries_read_the_benchmark_tables(spark):
    """Every query plans a scan of the benchmark tables, or of a table that it
    staged from them (pages, jobs)."""
    sf = "/root/testdata/sf0.001"
    for name, fn in E._QUERIES.items():
        files = fn(spark, sf).inputFiles()
        assert name == "sink_outcomes" or any(sf in f or "revisor-stage" in f for f in files), name


def test_optional_queries_hide_only_a_missing_subpackage(monkeypatch):
    import pytest

    assert E._optional("revisor.llm_that_is_not_there") is None

    def broken(name):
        raise ModuleNotFoundError("No module named 'elsewhere'", name="elsewhere")

    monkeypatch.setattr(E.importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        E._optional("revisor.llm.queries")


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from revisor import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
