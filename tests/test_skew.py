"""Hot keys: one commander / one card holding a third of all rows."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from deckframe.plans import decks, web

TS = dt.datetime(2024, 1, 1)


def _hot_boards(spark, n_decks=90):
    rows = []
    for i in range(n_decks):
        d = f"d{i}"
        cmd = "Hot" if i % 3 == 0 else f"C{i}"
        rows.append((d, TS, cmd, "f", 1, "Commander"))
        rows.append((d, TS, "Island", "f", 2, "Mainboard"))       # hot card: in every deck
        rows.append((d, TS, f"X{i % 5}", "f", 1, "Mainboard"))
    schema = "deck_id string, lastUpdatedAtUtc timestamp, card_name string, format string, quantity int, type string"
    return spark.createDataFrame(rows, schema)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_commander_average(spark):
    b = _hot_boards(spark)
    lists = decks.decklists(b, size=4)
    avg = decks.average_decks(lists, b.filter(F.col("type") == "Commander"), budget=100)
    hot = {r["card_name"]: (r["quantity"], r["total_decks"])
           for r in avg.filter("commander = 'Hot'").collect()}
    # 30 decks: Island 2 per deck -> 60/30 = 2; X cards 6 each -> ceil(6/30) = 1
    assert hot["Island"] == (2, 30) and hot["Hot"] == (1, 30) and hot["X0"] == (1, 30)


def test_hot_card_ownership_is_broadcast(spark):
    b = _hot_boards(spark)
    lists = decks.decklists(b, size=4)
    coll = spark.createDataFrame([("Island", 2), ("Hot", 1), ("X0", 1)], "name string, quantity bigint")
    out = decks.buildable_decks(lists, coll, size=4)
    assert sorted({r["deck_id"] for r in out.collect()}) == [f"d{i}" for i in sorted(range(0, 90, 15))]
    plan = _plan(out)    # as adaptive execution ran it, once the collection's size was known
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan


def test_images_are_looked_up_for_distinct_names_only(spark):
    b = _hot_boards(spark)
    images = spark.createDataFrame([("Island", "i", "o1", "Basic Land"), ("Hot", "h", "o2", "Creature")],
                                   "card_name string, image_url string, oracle_id string, type_line string")
    top = web.top_cards(decks.decklists(b, size=4), images)
    assert [r["card_name"] for r in top.collect()] == ["Hot"]
    plan = top._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(plan) if "image_url" in x and "Join" not in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    joins = [x for x in plan if "Join Inner" in x]
    counted = [x for x in plan if "count(" in x and "Aggregate" in x]
    # decks are counted below the joins with the images, never above them
    assert at and joins and min(depth(x) for x in counted) > min(depth(x) for x in joins)


def test_a_hot_group_has_its_running_total_in_ranges(spark):
    """One group holds nearly all rows; ties share a total, NULLs come first."""
    from deckframe.operators import running_total_split
    rows = [("hot", i // 3 if i % 50 else None, i % 7) for i in range(3000)] + [("cold", 5, 1), ("cold", 5, None), (None, 1, 2), (None, 2, 3), ("nothing", 1, None)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    whole = Window.partitionBy("g").orderBy(F.col("o").asc_nulls_first())
    want = df.withColumn("t", F.sum("v").over(whole))
    got = running_total_split(df, "v", "g", "o", parts=8, total_alias="t")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    dealt = got.filter("g = 'hot'").select("o").distinct().count()
    assert dealt > 900
