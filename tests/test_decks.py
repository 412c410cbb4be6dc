"""Deck analytics on the hand-worked fixtures."""

from pyspark.sql import functions as F

from deckframe.plans import decks
from tests.fixtures import collection, m1_boards


def _lists(rows):
    out = {}
    for r in rows:
        out.setdefault(r["deck_id"], {})[r["card_name"]] = r["quantity"]
    return out


def test_decklists_latest_per_board_and_complete(spark):
    lists = decks.decklists(m1_boards(spark), size=4)
    got = _lists(lists.collect())
    # d1: Old dropped (older mainboard row); d3 keeps its stale companion (T1);
    # d2 is incomplete (3 cards)
    assert got == {"d1": {"C1": 1, "Bolt": 1, "Island": 2},
                   "d3": {"C1": 1, "Island": 2, "K": 1}}


def test_decklists_methods_agree(spark):
    a = decks.decklists(m1_boards(spark), size=4).collect()
    for method in ("semi", "window"):
        b = decks.decklists(m1_boards(spark), size=4, method=method).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_decklists_deck_scope_drops_stale_companion(spark):
    got = _lists(decks.decklists(m1_boards(spark), size=3, scope="deck").collect())
    # per-deck latest: d3's companion (ts 3) is older than its deck (ts 5)
    assert got == {"d2": {"A-C1": 1, "Bolt": 1, "K": 1}, "d3": {"C1": 1, "Island": 2}}


def test_latest_ties_are_kept(spark):
    b = m1_boards(spark)
    tie = b.filter("deck_id = 'd1' AND card_name = 'Bolt'").withColumn("card_name", F.lit("Bolt2"))
    lists = decks.decklists(b.unionByName(tie), size=5)
    assert sorted(r["card_name"] for r in lists.filter("deck_id='d1'").collect()) == \
        ["Bolt", "Bolt2", "C1", "Island"]


def test_average_decks_m2(spark):
    b = m1_boards(spark)
    lists = decks.decklists(b, size=4)
    cmd = b.filter(F.col("type") == "Commander")
    avg = decks.average_decks(lists, cmd, budget=4, keep_type=True)
    got = sorted((r["commander"], r["card_name"], r["type"], r["quantity"], r["total_decks"])
                 for r in avg.collect())
    # total_decks counts d2 through the stripped name (T4); K (running 5) is cut
    assert got == [("C1", "Bolt", "Mainboard", 1, 3), ("C1", "C1", "Commander", 1, 3),
                   ("C1", "Island", "Mainboard", 2, 3)]


def test_average_decks_prefixed_commander_gets_no_count(spark):
    # a commander seen only under the rebalanced prefix: no deck count
    b = m1_boards(spark).filter("deck_id = 'd2'")
    b = b.withColumn("lastUpdatedAtUtc", F.lit("2024-01-09").cast("timestamp"))
    lists = decks.decklists(b, size=3)
    cmd = b.filter(F.col("type") == "Commander")
    assert decks.average_decks(lists, cmd, budget=100).count() == 0
    fixed = decks.average_decks(lists, cmd, budget=100, normalize_join=True).collect()
    assert {(r["commander"], r["card_name"]) for r in fixed} == \
        {("C1", "C1"), ("C1", "Bolt"), ("C1", "K")}


def test_running_total_range_frame_ties(spark):
    # the same card on two boards ties on (avg, name) and shares one total (T5)
    rows = [("d1", "Commander", "X", 1), ("d1", "Mainboard", "Y", 1), ("d1", "Companion", "Y", 1)]
    b = spark.createDataFrame([(d, c, q, t) for d, t, c, q in rows],
                              "deck_id string, card_name string, quantity int, type string") \
        .withColumn("lastUpdatedAtUtc", F.lit("2024-01-01").cast("timestamp")) \
        .withColumn("format", F.lit("f"))
    lists = decks.decklists(b, size=3)
    cmd = b.filter(F.col("type") == "Commander")
    got = decks.average_decks(lists, cmd, budget=2).collect()
    # X (1) then both Y rows share running total 3 > 2: both cut together
    assert [r["card_name"] for r in got] == ["X"]


def test_buildable_m3(spark):
    lists = decks.decklists(m1_boards(spark), size=4)
    coll = collection(spark, [("Island", 1), ("Bolt", 1), ("C1", 1), ("K", 4)])
    assert decks.buildable_decks(lists, coll, size=4).count() == 0
    ok = decks.buildable_decks(lists, coll, size=4, unlimited=["Island"])
    assert sorted({r["deck_id"] for r in ok.collect()}) == ["d1", "d3"]
    # all rows of a buildable deck come back, owned marker set
    assert ok.filter("name IS NULL").count() == 0


def test_ownership_is_all_or_nothing(spark):
    lists = decks.decklists(m1_boards(spark), size=4)
    coll = collection(spark, [("Island", 1), ("Bolt", 1), ("C1", 1), ("K", 4)])
    have = decks.owned_collection(coll, [])
    from deckframe.operators.ownership import owned_rows
    rows = owned_rows(lists.filter("deck_id='d1'"), have, "card_name", "quantity").collect()
    owned = {r["card_name"]: r["name"] for r in rows}
    assert owned == {"C1": "C1", "Bolt": "Bolt", "Island": None}  # T8: 1 of 2 is not owned


def test_unlimited_basic_not_in_collection_still_unowned(spark):
    lists = decks.decklists(m1_boards(spark), size=4)
    coll = collection(spark, [("Bolt", 1), ("C1", 1)])  # no Island at all (T9)
    ok = decks.buildable_decks(lists, coll, size=4, unlimited=["Island"])
    assert ok.count() == 0


def test_collection_totals(spark):
    src = collection(spark, [("A", 1), ("A", 2), ("B", 5)])
    got = {r["name"]: r["quantity"] for r in decks.collection_totals(src).collect()}
    assert got == {"A": 3, "B": 5}


def _history(spark):
    import datetime as dt
    rows = [("d1", "Deck one", "desc", "u1", 1, 2, 3, "W", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 1), "{}"),
            ("d3", "Deck three", None, "u3", 0, 0, 0, "U", dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 2), "{}"),
            ("d9", "No commander", None, "u9", 0, 0, 0, "B", dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 2), "{}")]
    return spark.createDataFrame(rows, "id string, name string, description string, publicUrl string, "
                                       "likeCount bigint, viewCount bigint, commentCount bigint, colors string, "
                                       "lastUpdatedAtUtc timestamp, createdAtUtc timestamp, hubs string")


def test_deck_details_and_incremental(spark):
    b = m1_boards(spark)
    extra = spark.createDataFrame([("d1", b.first()["lastUpdatedAtUtc"], "Z", "cedh", 1, "Commander")],
                                  b.schema)
    b = b.unionByName(extra)
    lists = decks.decklists(b, size=4)
    cmd = b.filter(F.col("type") == "Commander")
    det = {r["deck_id"]: r for r in decks.deck_details(_history(spark), cmd, lists).collect()}
    assert det["d1"]["commander_name"] == "C1[and]Z"          # M9 ordering
    assert det["d1"]["card_count"] is None                    # d1 no longer complete (5 cards)
    assert det["d3"]["card_count"] == 3
    assert det["d9"]["commander_name"] is None and det["d9"]["card_count"] is None
    # incremental: only rows strictly newer than the target's mark are rebuilt
    target = decks.deck_details(_history(spark), cmd, lists).filter("deck_id = 'd1'")
    refreshed = decks.refresh_deck_details(target, _history(spark), cmd, lists)
    assert sorted(r["deck_id"] for r in refreshed.collect()) == ["d1", "d3", "d9"]


def test_build_progress_prices_and_sentinels(spark):
    b = m1_boards(spark)
    lists = decks.decklists(b, size=4)
    cmd = b.filter(F.col("type") == "Commander")
    details = decks.deck_details(_history(spark), cmd, lists)
    coll = collection(spark, [("Island", 1), ("Bolt", 1), ("C1", 1), ("K", 4)])
    prices = spark.createDataFrame(
        [("Island", 0.10), ("Bolt", 999999999.0), ("C1", 2.50)], "name string, min_usd double")
    prog = {r["deck_id"]: r for r in
            decks.deck_build_progress(lists, details, coll, prices, size=4).collect()}
    # Island is a basic: unlimited in the progress report
    assert prog["d1"]["percent_complete"] == 4
    # Bolt's sentinel price -> 0; Island 2 x 0.10; C1 2.50
    assert abs(prog["d1"]["price"] - 2.70) < 1e-9
    # d3: K has no price row -> NULL line ignored by SUM
    assert abs(prog["d3"]["price"] - 2.70) < 1e-9


def test_buildable_average_decks(spark):
    b = m1_boards(spark)
    lists = decks.decklists(b, size=4)
    cmd = b.filter(F.col("type") == "Commander")
    avg = decks.average_decks(lists, cmd, budget=4)
    coll = collection(spark, [("Island", 2), ("Bolt", 1), ("C1", 1)])
    out = decks.buildable_average_decks(avg, coll, size=4).collect()
    assert sorted(r["copy_paste"] for r in out) == ["1 Bolt", "1 C1", "2 Island"]


def test_deck_cost_of_cards_with_many_printings(spark):
    lists = spark.createDataFrame(
        [("d1", "A", 3), ("d1", "B", 1), ("d2", "A", 3), ("d2", "A", 40), ("d3", "A", None), ("d4", "C", 2), ("d4", None, 1)],
        "deck_id string, card_name string, quantity bigint")
    priced = [("A", 1.0 + i % 500) for i in range(2000)] + [("B", 9999.0), ("B", 9999.5), ("B", None), (None, 1.0), ("C", None)]
    prices = spark.createDataFrame(priced, "name string, usd double").select("name", F.col("usd").cast("decimal(12,2)").alias("min_usd"))
    want = {}
    for deck, card, quantity in [tuple(r) for r in lists.collect()]:
        amounts = [p * quantity if quantity is not None else 0 for n, p in priced if n is not None and n == card and p is not None]
        if amounts:
            want[deck] = want.get(deck, 0) + sum(a for a in amounts if 0 <= a <= 9999)
    out = decks.deck_cost(lists, prices)
    got = {r["deck_id"]: r["cost"] for r in out.collect()}
    assert {k: v if v is None else float(v) for k, v in got.items()} == {**want, "d4": None}
    # the prices of a card are never gathered beside its lines
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
