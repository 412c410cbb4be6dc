"""Plan-level checks: JVM-only plans, the driver contract, the format build."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from deckframe.operators.latest import dedupe_keep_last
from deckframe.plans import formats, star
from deckframe.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def test_every_query_has_an_oracle_or_is_documented():
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plans_stay_in_the_jvm(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["commander", "card_name", "quantity", "total_decks"]
    assert df.count() >= 0


def test_scan_prunes_columns(spark):
    df = E.queries()["average_basket_budget"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with only the columns the model needs
    assert "l_extendedprice" not in plan and "l_comment" not in plan


def test_build_format_all_models(spark, scratch):
    docs = star.deck_documents(spark, SF_SMALL)
    hist = star.deck_history(spark, SF_SMALL).drop("lastUpdatedAtUtc")
    latest_docs = dedupe_keep_last(docs, "id", "lastUpdatedAtUtc")
    deck_history = latest_docs.join(hist, "id").withColumn(
        "format", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    out = formats.build_format(spark, deck_history, star.collection_export(spark, SF_SMALL),
                               star.printings(spark, SF_SMALL), star.printings(spark, SF_SMALL),
                               os.path.join(scratch, "models"), size=50, budget=20)
    assert set(out) >= {"board_cards", "decklists", "deck_details", "average_decks",
                        "buildable_decks", "buildable_average_decks", "deck_build_progress",
                        "top_cards", "top_commanders", "prices", "images", "collection"}
    lists = out["decklists"]
    assert lists.count() > 0
    totals = lists.groupBy("format", "deck_id").agg(F.sum("quantity").alias("t"))
    assert totals.filter("t <> 50").count() == 0
    assert {r["format"] for r in out["average_decks"].select("format").distinct().collect()} <= {"even", "odd"}
    assert out["top_cards"].groupBy("format").count().filter("count > 200").count() == 0


def test_build_format_bucketed_joins_skip_the_shuffle(spark, scratch):
    from deckframe.plans import decks
    docs = star.deck_documents(spark, SF_SMALL)
    hist = star.deck_history(spark, SF_SMALL).drop("lastUpdatedAtUtc")
    deck_history = dedupe_keep_last(docs, "id", "lastUpdatedAtUtc").join(hist, "id")
    out = formats.build_format(spark, deck_history, star.collection_export(spark, SF_SMALL),
                               star.printings(spark, SF_SMALL), star.printings(spark, SF_SMALL),
                               os.path.join(scratch, "bucketed"), size=50, budget=20,
                               deck_buckets=4, database="deckframe_test_models")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lists, boards = out["decklists"], out["board_cards"]
        joined = lists.join(boards.filter(F.col("type") == "Commander").select("format", "deck_id"),
                            ["format", "deck_id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() >= 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_models_by_format_read_stored_boards(spark):
    for name in ("average_by_format", "decklists_by_format", "details_by_format", "buildable_by_format", "top_items_by_format"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        # lineitem, part and orders are joined once, not in the tasks of the models
        assert "l_orderkey" not in plan and "deck_id" in plan, name


def test_boards_without_cards_are_written_as_a_constant(spark, scratch):
    d = os.path.join(scratch, "feed")
    spark.createDataFrame([(1, 7, 3, 1, 4.0, None), (1, 8, 3, 4, -2.0, None), (1, 7, 3, 5, None, None)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp") \
         .write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(7, 'a "b', "SMALL", "B", 1, 1.0), (8, None, "SMALL", "B", 1, 1.0)],
                          "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double") \
         .write.parquet(f"{d}/part.parquet")
    docs = star.deck_documents(spark, d)
    r = docs.first()
    assert r["commanders"] == '{"count":1,"cards":{"1-7-3":{"quantity":4,"card":{"name":"a \\"b"}}}}'
    assert r["companions"] == star.NO_CARDS
    entries = ['"4-8-3":{"quantity":-2,"card":{}}', '"5-7-3":{"card":{"name":"a \\"b"}}']
    assert r["mainboard"] in ['{"count":2,"cards":{' + ",".join(e) + "}}" for e in (entries, entries[::-1])]
    assert star.NO_CARDS in docs._jdf.queryExecution().optimizedPlan().toString()
