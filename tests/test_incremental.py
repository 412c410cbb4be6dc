"""Upsert, SCD2 (M6), keep-last, high-water marks, and their properties."""

import datetime as dt

from pyspark.sql import functions as F

from deckframe.operators.incremental import high_water_mark, newer_than, upsert
from deckframe.operators.latest import dedupe_keep_last, latest_per_key
from deckframe.operators.scd2 import current, scd2_apply

KV = "id int, v string"


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_replaces_and_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    batch = spark.createDataFrame([(2, "c"), (2, "c2"), (3, "d")], KV)
    out = upsert(target, batch, "id")
    assert _rows(out, ["id", "v"]) == [(1, "a"), (2, "c"), (2, "c2"), (3, "d")]


def test_upsert_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    batch = spark.createDataFrame([(2, "c"), (3, "d")], KV)
    once = upsert(target, batch, "id")
    twice = upsert(once, batch, "id")
    assert _rows(once, ["id", "v"]) == _rows(twice, ["id", "v"])


def test_scd2_m6(spark):
    r1 = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    r2 = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], KV)
    r3 = spark.createDataFrame([(1, "a"), (3, "d")], KV)
    t1, t2, t3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    h = scd2_apply(None, r1, "id", t1)
    h = scd2_apply(h, r2, "id", t2)
    h = scd2_apply(h, r3, "id", t3)
    got = _rows(h, ["id", "v", "valid_from", "valid_to"])
    assert got == [(1, "a", t1, None), (2, "b", t1, t2), (2, "c", t2, t3), (3, "d", t2, None)]
    again = scd2_apply(h, r3, "id", dt.datetime(2024, 1, 4))
    assert _rows(again, ["id", "v", "valid_from", "valid_to"]) == got
    # at most one open row per key
    assert current(again).groupBy("id").count().filter("count > 1").count() == 0
    assert h.select("scd_id").distinct().count() == h.count()


def test_scd2_null_safe_change_detection(spark):
    a = spark.createDataFrame([(1, None)], KV)
    h = scd2_apply(None, a, "id", dt.datetime(2024, 1, 1))
    h2 = scd2_apply(h, a, "id", dt.datetime(2024, 1, 2))
    assert h2.count() == 1


def test_latest_per_key_drops_null_keys_and_versions(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 2), (1, 2), (2, 5)], "k int, v int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], "v").collect())
    assert got == [(1, 2), (1, 2), (2, 5)]


def test_dedupe_keep_last_and_first(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (1, 3, "z"), (2, 1, "w")],
                               "k int, o int, p string")
    assert _rows(dedupe_keep_last(df, "k", "o"), ["k", "o", "p"]) == [(1, 3, "z"), (2, 1, "w")]
    assert _rows(dedupe_keep_last(df, "k", "o", keep="first"), ["k", "o", "p"]) == \
        [(1, 1, "x"), (2, 1, "w")]


def test_dedupe_hot_key_is_partially_aggregated(spark):
    # one key holds most rows; the plan must aggregate before the shuffle
    df = spark.range(0, 20000).select((F.when(F.col("id") < 15000, 0).otherwise(F.col("id"))).alias("k"),
                                      F.col("id").alias("o"))
    out = dedupe_keep_last(df, "k", "o")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan
    assert out.filter("k = 0").first()["o"] == 14999


def test_high_water_mark_and_newer_than(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))],
                               "id int, ts timestamp")
    assert high_water_mark(None, "ts") is None
    mark = high_water_mark(df, "ts")
    assert mark == dt.datetime(2024, 1, 2)
    new = spark.createDataFrame([(3, dt.datetime(2024, 1, 2)), (4, dt.datetime(2024, 1, 3))],
                                "id int, ts timestamp")
    assert [r["id"] for r in newer_than(new, "ts", mark).collect()] == [4]   # equal ts dropped
    assert newer_than(new, "ts", None).count() == 2
    # the literal mark is pushed into the scan filter
    plan = newer_than(new, "ts", mark)._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-02" in plan


def test_high_water_mark_with_runs_and_backfill(spark, scratch):
    import os
    from deckframe.sources import database_at, land_run, read_table, upsert_table
    from deckframe.sources.tables import backfill
    target = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, ts timestamp")
    run = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (1, dt.datetime(2024, 1, 6)),
                                 (2, dt.datetime(2024, 1, 5))], "id int, ts timestamp")
    path = land_run(run, scratch, "asset", 1704412800)   # 2024-01-05 00:00 UTC
    runs = spark.read.parquet(os.path.join(scratch, "asset"))
    assert high_water_mark(target, "ts", runs=runs) == dt.datetime(2024, 1, 5)
    table = f"{database_at(spark, os.path.join(scratch, 'tables'))}.t"
    upsert_table(target, table, ["id"], 4)
    backfill(spark, path, table, ["id"], "ts")
    assert _rows(read_table(spark, table), ["id", "ts"]) == [(1, dt.datetime(2024, 1, 6)), (2, dt.datetime(2024, 1, 5))]


def test_apply_transforms_and_jsonify(spark):
    from deckframe.functions.json import apply_transforms, jsonify_nested
    df = spark.createDataFrame([("2024-01-02T03:04:05Z", "12", "x", ["a"], {"k": 1})],
                               "t string, n string, bad string, arr array<string>, m map<string,int>")
    out = apply_transforms(df, {"t": "datetime", "n": "int", "bad": "float", "arr": "json"}).first()
    assert out["t"] == dt.datetime(2024, 1, 2, 3, 4, 5) and out["n"] == 12 and out["bad"] is None
    assert out["arr"] == '["a"]'
    flat = jsonify_nested(df).first()
    assert flat["m"] == '{"k":1}' and flat["arr"] == '["a"]'


def test_scd2_step_append_only_closed_part(spark):
    from deckframe.operators.scd2 import scd2_step
    r1 = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    r2 = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], KV)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    closed, open1 = scd2_step(None, r1, "id", t1)
    assert closed is None and open1.count() == 2
    closed, open2 = scd2_step(open1, r2, "id", t2)
    assert _rows(closed, ["id", "v", "valid_to"]) == [(2, "b", t2)]
    assert _rows(open2, ["id", "v", "valid_from"]) == [(1, "a", t1), (2, "c", t2), (3, "d", t2)]
