"""The availableNow stream drains landed files and runs the batch plan."""

import os

from revisor.schemas import PAGE_SCHEMA
from revisor.streaming.landed import start_landed_stream


def _review(i):
    return (None, "2024-01-01", f"id{i}", None, 1, "5", None, "ok", None)


def _land(spark, folder, rows):
    spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1).write.json(folder)


def _drain(spark, landing, out, ckpt):
    q = start_landed_stream(spark, os.path.join(landing, "*"), out, ckpt, odate="20240101")
    q.awaitTermination(120)
    return q


def test_stream_drains_landed_files(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt"))
    _land(spark, os.path.join(landing, "run1"), [("app_s", "pf", "p1", 0, True, [_review(1), _review(1)], None, None)])
    _drain(spark, landing, out, ckpt)
    rows = spark.read.parquet(os.path.join(out, "reviews"))
    assert rows.where("side = 'valid'").count() == 2 and rows.where("side = 'invalid'").count() == 2
    # a second run lands later; the rerun only reads the new file
    _land(spark, os.path.join(landing, "run2"), [("app_s", "pf", "p2", 0, True, [_review(7)], None, None)])
    _drain(spark, landing, out, ckpt)
    valid = spark.read.parquet(os.path.join(out, "reviews")).where("side = 'valid'")
    assert sorted(r["id"] for r in valid.select("id").collect()) == ["id1", "id1", "id7"]
    loads = sorted(r["load_id"] for r in valid.select("load_id").distinct().collect())
    assert [x.rpartition("-")[2] for x in loads] == ["0", "1"] and len({x.rpartition("-")[0] for x in loads}) == 1
    assert spark.read.json(os.path.join(out, "metrics", "*", "success")).count() == 2
    # a stream with a new checkpoint starts at epoch 0 again and replaces nothing
    later = os.path.join(tmp_dir, "later")
    _land(spark, os.path.join(later, "run3"), [("app_s", "pf", "p3", 0, True, [_review(9)], None, None)])
    _drain(spark, later, out, os.path.join(tmp_dir, "ckpt2"))
    valid = spark.read.parquet(os.path.join(out, "reviews")).where("side = 'valid'")
    assert sorted(r["id"] for r in valid.select("id").collect()) == ["id1", "id1", "id7", "id9"]


def test_stream_refuses_a_fetch_without_its_first_page(spark, tmp_dir):
    import pytest
    from pyspark.errors import StreamingQueryException

    landing, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    _land(spark, os.path.join(landing, "run1"), [("app_s", "pf", "p1", 1, True, [_review(1)], None, None)])
    with pytest.raises(StreamingQueryException, match="lack their first page"):
        _drain(spark, landing, out, os.path.join(tmp_dir, "ckpt"))
    assert not os.path.exists(out)
