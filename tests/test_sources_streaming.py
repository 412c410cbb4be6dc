"""Sources, sinks, versioned table store and the streaming upsert."""

import datetime as dt
import json
import glob
import os

import pytest
from pyspark.sql import functions as F

from deckframe.schemas import DECK_SCHEMA
from deckframe.sources import (AssetSpec, database_at, land_run, read_collection, read_combos, read_table, upsert_table,
                               read_decks, split_bad_records, write_chunks, write_landing)
from deckframe.streaming import landing_stream, run_upsert_stream


def _deck(i, ts, boards=None, hubs=None):
    return {"id": f"d{i}", "name": f"Deck {i}", "format": "commander", "likeCount": i,
            "lastUpdatedAtUtc": ts, "createdAtUtc": "2024-01-01T00:00:00Z",
            "hubs": hubs if hubs is not None else [], "colors": ["W"],
            "boards": boards or {"commanders": {"count": 1, "cards": {
                "x": {"quantity": 1, "card": {"name": f"C{i}"}}}}}}


def test_read_decks_flatten_since_and_cap(spark, scratch):
    p = os.path.join(scratch, "decks.json")
    with open(p, "w") as f:
        f.write(json.dumps(_deck(1, "2024-01-02T10:00:00.12Z", hubs=["a", "b"])) + "\n")
        f.write(json.dumps(_deck(2, "2024-01-03T10:00:00Z")) + "\n")
        f.write(json.dumps(_deck(3, "2024-01-04T10:00:00Z")) + "\n")
    all_ = read_decks(spark, p)
    assert [f.name for f in all_.schema.fields] == [f.name for f in DECK_SCHEMA.fields]
    r = all_.filter("id = 'd1'").first()
    assert r["hubs"] == '{"0":"a","1":"b"}'
    assert r["mainboard"] == "{}" and json.loads(r["commanders"])["count"] == 1
    assert r["lastUpdatedAtUtc"] == dt.datetime(2024, 1, 2, 10, 0, 0, 120000)
    newer = read_decks(spark, p, since=dt.datetime(2024, 1, 2, 12))
    assert sorted(x["id"] for x in newer.collect()) == ["d2", "d3"]
    # a capped load takes the oldest first, and runs that follow the mark lose none
    seen, mark = [], None
    while True:
        got = read_decks(spark, p, since=mark, max_rows=1).collect()
        if not got:
            break
        seen += [x["id"] for x in got]
        mark = max(x["lastUpdatedAtUtc"] for x in got)
    assert seen == ["d1", "d2", "d3"]


def test_read_combos_and_collection(spark, scratch):
    p = os.path.join(scratch, "combos.json")
    with open(p, "w") as f:
        f.write(json.dumps({"id": 7, "status": "ok", "uses": [{"card": {"id": 1, "name": "A"}}],
                            "identity": "W"}) + "\n")
    r = read_combos(spark, p).first()
    assert r["id"] == "7" and json.loads(r["combodata"])["identity"] == "W"
    c = os.path.join(scratch, "coll.csv")
    with open(c, "w", encoding="utf-16") as f:
        f.write("extras,language,Name,Quantity,print_id\n,en,Bolt,3,x1\n,en,Bolt,1,x2\n")
    coll = read_collection(spark, c)
    assert sorted((x["name"], x["quantity"]) for x in coll.collect()) == [("Bolt", 1), ("Bolt", 3)]


def test_split_bad_records(spark):
    df = spark.createDataFrame([(1, 5), (None, 2), (3, -1)], "id int, q int")
    good, bad = split_bad_records(df, {"id_present": F.col("id").isNotNull(), "q_positive": F.col("q") > 0})
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted(tuple(r["failed_rules"]) for r in bad.collect()) == [("id_present",), ("q_positive",)]


def test_write_landing_checks_required(spark, scratch):
    ok = spark.createDataFrame([("d1", "x", 1)], "id string, name string, extra int")
    write_landing(ok, DECK_SCHEMA, os.path.join(scratch, "land1"))
    back = spark.read.parquet(os.path.join(scratch, "land1"))
    assert back.columns == [f.name for f in DECK_SCHEMA.fields]
    bad = spark.createDataFrame([(None, "x")], "id string, name string")
    with pytest.raises(ValueError):
        write_landing(bad, DECK_SCHEMA, os.path.join(scratch, "land2"))


def test_chunks_runs_and_assets(spark, scratch):
    df = spark.range(0, 250).coalesce(1)
    write_chunks(df, os.path.join(scratch, "chunks"), rows=100)
    files = [f for f in os.listdir(os.path.join(scratch, "chunks")) if f.endswith(".parquet")]
    assert len(files) == 3
    land_run(df, scratch, "asset", 1700000000)
    with pytest.raises(Exception):
        land_run(df, scratch, "asset", 1700000000)
    assert spark.read.parquet(os.path.join(scratch, "asset")).select("run").distinct().count() == 1
    spec = AssetSpec.from_dict({"asset": {"name": "cedh_decks"},
                                "nature": {"name": "incremental", "tombstone": "lastUpdatedAtUtc",
                                           "unique_key": "id"},
                                "parameters": {"max_rows": 5000}, "filters": {"fmt": "commander"}})
    assert spec.unique_key == ["id"] and spec.max_rows == 5000 and spec.nature == "incremental"


def test_streaming_upsert_multiple_batches(spark, scratch):
    land = os.path.join(scratch, "landing")
    schema = "id int, ts timestamp, v string"
    b1 = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a"), (1, dt.datetime(2024, 1, 2), "b"),
                                (2, dt.datetime(2024, 1, 1), "x")], schema)
    b2 = spark.createDataFrame([(1, dt.datetime(2024, 1, 3), "c"), (2, dt.datetime(2023, 12, 1), "late"),
                                (3, dt.datetime(2024, 1, 1), "n")], schema)
    b1.coalesce(1).write.parquet(os.path.join(land, "f1"))
    b2.coalesce(1).write.parquet(os.path.join(land, "f2"))
    table = f"{database_at(spark, os.path.join(scratch, 'tables'))}.newest"
    stream = landing_stream(spark, os.path.join(land, "*"), b1.schema, max_files_per_trigger=1)
    q = run_upsert_stream(stream, table, ["id"], "ts", os.path.join(scratch, "ck"), buckets=4)
    q.awaitTermination()
    got = sorted((r["id"], r["v"]) for r in read_table(spark, table).collect())
    assert got == [(1, "c"), (2, "x"), (3, "n")]          # late row for 2 dropped (R3)


def test_upsert_reads_and_rewrites_only_touched_buckets(spark, scratch):
    table = f"{database_at(spark, os.path.join(scratch, 'tables'))}.k"
    files = lambda: {f for f in spark.table(table).inputFiles()}
    upsert_table(spark.range(0, 200).selectExpr("cast(id as int) id", "'a' v"), table, ["id"], buckets=8)
    before = files()
    upsert_table(spark.createDataFrame([(5, "b"), (500, "n")], "id int, v string"), table, ["id"])
    cur = {r["id"]: r["v"] for r in read_table(spark, table).collect()}
    assert len(cur) == 201 and cur[5] == "b" and cur[500] == "n" and cur[6] == "a"
    changed = {f.split("key_bucket=")[1].split("/")[0] for f in before ^ files()}
    assert 1 <= len(changed) <= 2


def test_stream_goes_on_from_its_checkpoint(spark, scratch, monkeypatch):
    """A stream that dies in its second batch and is started again."""
    from deckframe.streaming import ingest
    land = os.path.join(scratch, "landing2")
    schema = "id int, ts timestamp, v string"
    days = [[(1, 5, "e"), (2, 1, "x")], [(1, 3, "late"), (3, 1, "n")], [(1, 5, "e"), (2, 2, "y")], [(3, 9, "z")]]
    for n, rows in enumerate(days):
        spark.createDataFrame([(i, dt.datetime(2024, 1, d), v) for i, d, v in rows], schema).coalesce(1).write.parquet(os.path.join(land, f"f{n}"))
    table = f"{database_at(spark, os.path.join(scratch, 'tables'))}.newest"
    batches = []

    def start():
        stream = landing_stream(spark, os.path.join(land, "*"), spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
        return run_upsert_stream(stream, table, ["id"], "ts", os.path.join(scratch, "ck2"), buckets=4)

    def dying(batch, *args):
        batches.append(1)
        if len(batches) == 2:
            raise RuntimeError("lost executor")
        upsert_table(batch, *args)

    with monkeypatch.context() as m:
        m.setattr(ingest, "upsert_table", dying)
        with pytest.raises(Exception, match="lost executor"):
            start().awaitTermination()
    start().awaitTermination()
    assert sorted((r["id"], r["v"]) for r in read_table(spark, table).collect()) == [(1, "e"), (2, "y"), (3, "z")]


def test_read_cards_json_array_and_freshness(spark, scratch):
    from deckframe.sources import read_cards
    p = os.path.join(scratch, "cards.json")
    with open(p, "w") as f:
        json.dump([{"id": "c1", "name": "Bolt", "prices": {"usd": "1.00", "eur": None}},
                   {"id": "c2", "name": "Island", "prices": {"usd": None}}], f, indent=1)
    cards = read_cards(spark, p)
    assert sorted(r["name"] for r in cards.collect()) == ["Bolt", "Island"]
    assert read_cards(spark, p, since=dt.datetime(2999, 1, 1)).count() == 0
    from deckframe.plans.cards import card_prices
    got = {r["name"]: r["min_usd"] for r in card_prices(cards).collect()}
    assert float(got["Bolt"]) == 1.0 and float(got["Island"]) == 999999999


def test_read_json_with_rejects(spark, scratch):
    from deckframe.sources import read_json_with_rejects
    p = os.path.join(scratch, "mixed.json")
    with open(p, "w") as f:
        f.write('{"id": "a", "n": 1}\n{"id": "b", "n": "not a number"}\n{broken\n{"id": "c", "n": 3}\n')
    good, bad = read_json_with_rejects(spark, p, spark.createDataFrame([], "id string, n int").schema)
    assert sorted((r["id"], r["n"]) for r in good.collect()) == [("a", 1), ("c", 3)]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == \
        ['{"id": "b", "n": "not a number"}', "{broken"]


def test_read_asset_filters_and_cap(spark, scratch):
    from deckframe.sources import read_asset
    p = os.path.join(scratch, "asset.json")
    d1 = _deck(1, "2024-01-02T10:00:00Z")
    d1["hubNames"] = ["Competitive"]
    d2 = _deck(2, "2024-01-03T10:00:00Z")
    d2["hubNames"] = ["Budget"]
    d3 = _deck(3, "2024-01-04T10:00:00Z")
    d3["hubNames"] = ["Competitive"]
    d3["format"] = "pauperedh"
    with open(p, "w") as f:
        for d in (d1, d2, d3):
            f.write(json.dumps(d) + "\n")
    spec = AssetSpec.from_dict({"asset": {"name": "cedh_decks"}, "nature": {"name": "incremental"},
                                "filters": {"hubName": "Competitive", "fmt": "commander"},
                                "parameters": {"max_rows": 5}})
    assert [r["id"] for r in read_asset(spark, p, spec).collect()] == ["d1"]
    spec.filters = {}
    spec.max_rows = 2
    assert [r["id"] for r in read_asset(spark, p, spec).collect()] == ["d1", "d2"]


def test_flatten_keeps_unmodelled_fields_as_variant(spark, scratch):
    p = os.path.join(scratch, "raw.json")
    d = _deck(1, "2024-01-02T10:00:00Z")
    d["primer"] = {"sections": 3}
    with open(p, "w") as f:
        f.write(json.dumps(d) + "\n")
    flat = read_decks(spark, p, keep_raw=True)
    r = flat.select("id", F.expr("variant_get(raw, '$.primer.sections', 'int')").alias("s")).first()
    assert (r["id"], r["s"]) == ("d1", 3)


def _array_file(path, rows, comma=True):
    with open(path, "w") as f:
        f.write("[\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n")


def test_one_array_is_read_by_many_tasks_in_order(spark, scratch):
    from deckframe.sources import read_cards
    folder = os.path.join(scratch, "bulk")
    os.makedirs(folder)
    rows = [{"id": str(i), "name": f"n{i}", "oracle_id": "x" * (i % 50), "prices": {"usd": "1.0"}, "other": {"a": [i]}} for i in range(4000)]
    _array_file(os.path.join(folder, "a.json"), rows[:3000])
    _array_file(os.path.join(folder, "b.json"), rows[3000:])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        cards = read_cards(spark, folder)
        got = sorted((r["seq"], r["id"]) for r in cards.select("seq", "id").collect())
        assert spark.read.text(folder).rdd.getNumPartitions() > 10
        assert got == [(i, str(i)) for i in range(4000)]            # gapless, files in order
        assert read_cards(spark, folder, since=dt.datetime(2999, 1, 1)).count() == 0
    finally:
        spark.conf.set(key, before)


def test_a_broken_record_of_an_array_is_no_silent_loss(spark, scratch):
    from deckframe.sources import read_cards
    path = os.path.join(scratch, "cards.json")
    with open(path, "w") as f:
        f.write('[\n{"id": "1"},\n{"id": "2"},\n{"id": "3\n]\n')
    with pytest.raises(Exception):
        read_cards(spark, path).collect()
    _array_file(path, [{"id": "1"}])
    assert [(r["seq"], r["id"]) for r in read_cards(spark, path).collect()] == [(0, "1")]
    with open(path, "w") as f:
        f.write('[]')
    assert read_cards(spark, path).count() == 0
