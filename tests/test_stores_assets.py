"""Stores that survive interrupted commits, asset loads, documents with many keys."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from deckframe.functions.json import object_text
from deckframe.operators.scd2 import scd2_apply
from deckframe.plans.assets import load_asset, load_rows
from deckframe.plans.decks import board_cards
from deckframe.sources import (AssetSpec, apply_snapshot, asset_filter, database_at, read_cards, read_combos, read_decks,
                               read_table, upsert_table, write_snapshot)
from deckframe.streaming.ingest import latest_state_batch
from tests.conftest import SF_SMALL


class Lost(Exception):
    pass


def _lost(*args, **kwargs):
    raise Lost


@pytest.fixture
def db(spark, scratch):
    return database_at(spark, os.path.join(scratch, "tables"))


def _pairs(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, v string")


def test_snapshot_after_a_lost_switch(spark, db, monkeypatch):
    t = f"{db}.t"
    assert read_table(spark, t) is None
    write_snapshot(_rows(spark, (1, "a")), t)
    held = read_table(spark, t)
    with monkeypatch.context() as m:  # the rows are written, the view isn't switched
        m.setattr(type(spark), "sql", _lost)
        with pytest.raises(Lost):
            write_snapshot(_rows(spark, (2, "b")), t)
    assert _pairs(read_table(spark, t)) == [(1, "a")]
    write_snapshot(_rows(spark, (3, "c")), t)
    assert _pairs(read_table(spark, t)) == [(3, "c")]
    assert _pairs(held) == [(1, "a")]        # readers of the snapshot before go on
    write_snapshot(_rows(spark), t)          # an empty snapshot
    assert _pairs(read_table(spark, t)) == []
    assert len([x for x in spark.catalog.listTables(db) if "__snap_" in x.name]) == 2


@pytest.mark.parametrize("at", ["insertInto", "drop"])
def test_upsert_that_dies_half_way_is_finished(spark, db, monkeypatch, at):
    t = f"{db}.k"
    upsert_table(_rows(spark, (1, "a"), (2, "a")), t, ["id"], buckets=4)
    batch = _rows(spark, (2, "b"), (3, "b"))
    with monkeypatch.context() as m:
        if at == "insertInto":   # before the partitions are overwritten
            m.setattr(DataFrameWriter, "insertInto", _lost)
        else:                    # after it, before the pending rows are dropped
            real = type(spark).sql
            m.setattr(type(spark), "sql", lambda self, q, *a: _lost() if q.startswith("DROP") else real(self, q, *a))
        with pytest.raises(Lost):
            upsert_table(batch, t, ["id"])
    assert _pairs(read_table(spark, t)) == [(1, "a"), (2, "b"), (3, "b")]    # the next reader or writer finishes it
    upsert_table(batch, t, ["id"])
    assert _pairs(read_table(spark, t)) == [(1, "a"), (2, "b"), (3, "b")]    # a repeated batch changes nothing
    assert not [x for x in spark.catalog.listTables(db) if "pending" in x.name]


def test_upsert_whose_rows_fail_leaves_the_table(spark, db):
    t = f"{db}.k"
    upsert_table(_rows(spark, (1, "a")), t, ["id"], buckets=4)
    with pytest.raises(Exception, match="lost"):
        upsert_table(_rows(spark, (1, "b"), (7, "c")).withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))), t, ["id"])
    assert _pairs(read_table(spark, t)) == [(1, "a")]
    upsert_table(_rows(spark, (1, "b"), (7, "c")), t, ["id"])
    assert _pairs(read_table(spark, t)) == [(1, "b"), (7, "c")]


def test_partitioned_snapshots_write_few_files(spark, scratch, db):
    write_snapshot(spark.range(20000).selectExpr("id", "id % 16 as g").repartition(8), f"{db}.t", ["g"])
    files = [f for _, _, names in os.walk(os.path.join(scratch, "tables")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 16 + 1 and read_table(spark, f"{db}.t").count() == 20000


def test_stored_history_with_null_keys(spark, db):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 3)]
    snaps = [[(1, "a"), (2, "b"), (None, "n")], [(1, "a"), (2, "c"), (3, "d"), (None, "n")], [(1, "a"), (3, "d"), (None, "m")], [(1, "a"), (3, "d"), (None, "m")]]
    full = None
    for now, rows in zip(days, snaps):
        snap = spark.createDataFrame(rows, "id int, v string")
        apply_snapshot(snap, f"{db}.h", ["id"], now)
        full = scd2_apply(full, snap, ["id"], now)
    want = {(1, "a", 1, None), (2, "b", 1, 2), (2, "c", 2, 3), (3, "d", 2, None), (None, "n", 1, 3), (None, "m", 3, None)}
    for history in (read_table(spark, f"{db}.h"), full):
        assert {(r["id"], r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in history.collect()} == want
    apply_snapshot(_rows(spark), f"{db}.h", ["id"], dt.datetime(2024, 1, 4))    # every row is closed
    assert {r["valid_to"].day for r in read_table(spark, f"{db}.h").collect()} == {2, 3, 4}


def test_a_snapshot_reads_the_open_partition_only(spark, db):
    for day, rows in ((1, [(1, "a"), (2, "b")]), (2, [(1, "z")]), (3, [(1, "y")])):
        apply_snapshot(spark.createDataFrame(rows, "id int, v string"), f"{db}.h", ["id"], dt.datetime(2024, 1, day))
    plan = spark.table(f"{db}.h").filter("closed_at = 'open'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed_at" in plan


def test_late_rows_never_replace_newer_state(spark):
    schema = "id int, ts int, v string"
    state = spark.createDataFrame([(1, 5, "new"), (2, 1, "old")], schema)
    batch = spark.createDataFrame([(1, 3, "late"), (2, 2, "newer"), (2, 2, "newer"), (3, 1, "first")], schema)
    got = sorted((r["id"], r["v"]) for r in latest_state_batch(batch, state, "id", "ts").collect())
    assert got == [(1, "new"), (2, "newer"), (3, "first")]


def test_document_schema_does_not_grow_with_the_cards(spark, scratch):
    path = os.path.join(scratch, "decks.json")
    with open(path, "w") as f:
        for d in range(100):
            cards = {f"k{d}-{i}": {"quantity": [1, "2", 3.0, None][i % 4], "card": {"name": f"c{i}"}} for i in range(1000)}
            f.write(json.dumps({"id": f"d{d}", "format": "x", "lastUpdatedAtUtc": "2024-01-02T10:00:00Z", "hubs": [{"n": 1}, "a"], "createdByUser": {"u": 1.0},
                                "boards": {"mainboard": {"count": 1000, "cards": cards}, "commanders": None, "companions": {"cards": {}}}}) + "\n")
    landed = read_decks(spark, path)
    assert len(landed.schema) == 37
    rows = board_cards(landed)
    assert rows.count() == 100_000
    got = {r["card_name"]: r["quantity"] for r in rows.filter("deck_id = 'd7'").collect()}
    assert (got["c0"], got["c1"], got["c2"], got["c3"]) == (1, 2, 3, None)
    first = landed.filter("id = 'd7'").first()
    assert first["hubs"] == '{"0":{"n":1},"1":"a"}' and first["createdByUser"] == '{"u": 1.0}' and first["commanders"] == "{}"


def test_object_text(spark):
    df = spark.createDataFrame([("[]",), ("null",), (None,), ('{"a": 1}',), ('["x", null, 2]',)], "c string")
    assert [r[0] for r in df.select(object_text("c")).collect()] == ["{}", "{}", "{}", '{"a": 1}', '{"0":"x","1":null,"2":2}']


def test_commander_filter_compares_card_ids(spark, scratch):
    path = os.path.join(scratch, "decks.json")
    board = lambda key, name, cid: {"cards": {key: {"quantity": 1, "card": {"name": name, "id": cid}}}}
    with open(path, "w") as f:
        for i, b in enumerate([board("k", "n", "wanted"), board("wanted", "n", "x"), board("k", "wanted", "x")]):
            f.write(json.dumps({"id": f"d{i}", "boards": {"commanders": b}}) + "\n")
    assert [r["id"] for r in read_decks(spark, path, filters={"commanderCardId": "wanted"}).collect()] == ["d0"]


def test_combo_text_is_untouched(spark, scratch):
    path = os.path.join(scratch, "combos.json")
    lines = ['{"id": 1, "status": "OK", "popularity": 5, "notes": null}', '{"id": "2", "status": "OK", "popularity": 2.5}']
    with open(path, "w") as f:
        f.write("\n".join(lines))
    rows = {r["id"]: r["combodata"] for r in read_combos(spark, path).collect()}
    assert rows == {"1": lines[0], "2": lines[1]}


def test_cards_come_in_file_order(spark, scratch):
    path = os.path.join(scratch, "cards.json")
    with open(path, "w") as f:
        json.dump([{"id": str(i), "name": f"n{i}", "unknown": i} for i in range(300)], f)
    rows = read_cards(spark, path).orderBy("seq").collect()
    assert [r["id"] for r in rows] == [str(i) for i in range(300)] and rows[0]["flavor_name"] is None


def test_snapshot_asset_keeps_history(spark, db):
    spec = AssetSpec(name="cards", nature="snapshot", unique_key=["id"], history=True)
    one, two = _rows(spark, (1, "a"), (2, "b")), _rows(spark, (1, "z"))
    load_rows(spark, spec, lambda mark: asset_filter(one, spec.filters), db, 86400)
    for _ in range(2):   # a repeated load changes nothing
        assert _pairs(load_rows(spark, spec, lambda mark: two, db, 2 * 86400)) == [(1, "z")]
    history = {(r["id"], r["v"], r["valid_to"] is None) for r in read_table(spark, f"{db}.cards_history").collect()}
    assert history == {(1, "a", False), (2, "b", False), (1, "z", True)}
    assert spark.table(f"{db}.cards_runs").groupBy("run").count().count() == 2


def test_incremental_asset_reads_from_its_mark(spark, scratch, db):
    path = os.path.join(scratch, "decks.json")
    with open(path, "w") as f:
        for i, day in enumerate([5, 1, 3, 3, 2]):
            f.write(json.dumps({"id": f"d{i}", "lastUpdatedAtUtc": f"2024-01-0{day}T00:00:00Z", "likeCount": i}) + "\n")
    spec = AssetSpec(name="decks", nature="incremental", tombstone="lastUpdatedAtUtc", max_rows=2)
    loaded = [sorted(r["id"] for r in load_asset(spark, spec, path, db, run, buckets=4).collect()) for run in (1, 2, 3)]
    assert loaded == [["d1", "d4"], ["d1", "d2", "d3", "d4"], ["d0", "d1", "d2", "d3", "d4"]]


def test_a_carried_over_load_is_shuffled_once(spark, scratch, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    table = f"{database_at(spark, scratch)}.once"
    rows = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "id * 2 AS v")
    upsert_table(rows(0, 40), table, ["id"], buckets=4)
    hints, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda self, name, *by: hints.append(name) or hint(self, name, *by))
    upsert_table(rows(20, 60).selectExpr("id", "-id AS v"), table, ["id"])
    assert hints == ["rebalance"]     # before the pending table, not again before its rows are carried over
    want = {i: (-i if i >= 20 else 2 * i) for i in range(60)}
    assert {r["id"]: r["v"] for r in read_table(spark, table).collect()} == want


def test_models_are_built_from_parsed_decks(spark, monkeypatch):
    from deckframe.plans import registry
    plans = []

    def build(spark, decks_so_far, *args, **kwargs):
        plans.append(decks_so_far._jdf.queryExecution().optimizedPlan().toString())
        none = registry._boards(spark, SF_SMALL).limit(0)
        return {"board_cards": none}

    monkeypatch.setattr(registry, "build_format", build)
    registry.q_models_built_incrementally(spark, SF_SMALL)
    assert len(plans) == 2 and all("parquet" in p and "json" not in p for p in plans)


def test_second_build_parses_its_batch_once(spark, scratch, monkeypatch):
    from deckframe.plans import formats, registry, star
    feed = os.path.join(scratch, "feed")
    star.deck_feed(spark, SF_SMALL).write.text(feed)
    landed = read_decks(spark, feed).select(*formats.DECK_COLUMNS)
    plans, upserted = [], formats.decks.upsert_board

    def upsert_board(target, batch, by=()):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        return upserted(target, batch, by)

    monkeypatch.setattr(formats.decks, "upsert_board", upsert_board)
    early = F.col("lastUpdatedAtUtc") < F.lit(registry.ORDERS_LOADED_BEFORE).cast("timestamp")
    for part in (landed.filter(early), landed):
        out = formats.build_format(spark, part, star.collection_export(spark, SF_SMALL), star.printings(spark, SF_SMALL), star.printings(spark, SF_SMALL),
                                   os.path.join(scratch, "tables"), size=44, budget=60, incremental=True)
    assert [p.count("from_json(") for p in plans] == [1, 0]
    assert out["board_cards"].count() > 0 and out["deck_details"].count() > 0


def test_documents_are_read_as_sent_without_new_names(spark, scratch, monkeypatch):
    from deckframe.sources import readers
    card = lambda name: '{"quantity": 1.0, "card":{"name":"' + name + '", "set":":" } }'
    board = lambda *keys: '{ "count":1,\t"cards" : {' + ",".join(f'{k} : {card("x")}' for k in keys) + "} }"
    lines = [
        '{"id":"a","hubs":[{"n" :1.50}, "x"],"boards":{"mainboard":' + board('"1-2"', '"1-2"', '"é{},"', '":"', '""') + ',"tokens":{}}}',
        '{"id":"b", "other":{"id":"no","boards":1},"boards":{"other":{"mainboard":{"q":1}},"mainboard":' + board('"a\\"b"', '"\\u0069d"', '"n"') + "}}",
        '{"id":"c","createdByUser":{"u": 1.0, "v":{"w" : [ {"x":-0} ]}},"name":{"first" : "é"},"description":1.50,"colors":[{"r" :1.0},"W",null]}',
        '{"id":"d","description":"{\\"a\\":1, \\"k\\":\\"v\\"} \\\\","likeCount":"x","autoBracket":1,"viewCount":7,"createdByUser":"{\\"u\\":1}"}',
        "{'id':'e','boards':{'mainboard':{'a\"b\":':1,\"c\":2}}}", '{"id":"f","x":\'"y":1\',"createdByUser":{"a":1}}',
        '{"id":"g","createdByUser":{"a":1},"boards":{"mainboard":{"cards":{"k":', '{"id":"h","a":,"name":"n"}', '{"id":"i" "a":1}', '{"id":"j","a":"b":1,"name":"n"}',
        '[{"id":"k","x":1},{"id":"l","createdByUser":{"y":2}}]', "", "  ", "null", '"x":1', '{"id":"m"} {"id":"n"}', "x", '["a":1]',
        '{"id":"o","createdByUser":{"a\x01b":1, "c":2}}', '{"id":"p","' + "n" * 60_000 + '":1,"name":"n"}', '{"id":"q","createdByUser":{"' + "n" * 1200 + '":1}}',
        '{"createdByUser":{"a":1},"createdByUser":{"b" : 2},"id":"r","id":"s"}', '{"id":"t","boards":null}', '{"id":"u","boards":[1]}',
        '{"id":"v","boards":{"mainboard":{"cards":{' + ",".join(f'"{i} k":{{"z{i}": {i}}}' for i in range(4000)) + "}}}}"]
    path = os.path.join(scratch, "decks.json")
    with open(path, "wb") as f:
        f.write("\n".join(lines).encode() + b'\n{"id":"w","createdByUser":{"\xff":1}}\n{"id":"x","createdByUser":{"a":"\xe9"}}\r\n{"id":"y","createdByUser":{"a": 1}}\r{"id":"z"}')
    got = read_decks(spark, path)
    want = readers.flatten_decks(spark.read.schema(readers.DECK_DOC_SCHEMA).json(path))
    assert got.dtypes == want.dtypes
    rows = got.collect()
    assert len(rows) > 25
    for r, w in zip(rows, want.collect(), strict=True):
        assert r == w
    copies, write = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, p, *a, **k: copies.append(p) or write(self, p, *a, **k))
    read_decks(spark, path)
    copied = {r[0] for r in spark.read.text(copies[0]).collect()}
    assert not any('"3999 k":' in c for c in copied) and any('"3999 k","' in c for c in copied)
    # folders that are columns
    part = os.path.join(scratch, "parts")
    spark.createDataFrame([('{"id":"a","boards":{"mainboard":{"k":1}}}', "x")], "value string, format string").write.partitionBy("format").text(part)
    r = read_decks(spark, part).first()
    assert (r["id"], r["format"], r["mainboard"]) == ("a", "x", '{"k":1}')
