"""Average decks kept current: equal to a full rebuild after every load, whatever dies."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from deckframe.plans import decks, maintained
from deckframe.sources.tables import BUCKET, database_at, last_load, read_table
from tests.fixtures import BOARD_COLS, m1_boards, ts

SIZE, BUDGET = 4, 5


class Lost(Exception):
    pass


def _lost(*args, **kwargs):
    raise Lost


@pytest.fixture()
def db(spark, scratch):
    return database_at(spark, os.path.join(scratch, "tables"))


def _random_rows(r, day):
    rows = []
    for d in r.sample(range(12), r.randint(1, 5)):
        left = SIZE + r.choice([0, 0, 0, 1])
        for board in ("Commander", "Companion", "Mainboard"):
            for card in r.sample(["C1", "A-C1", "C2", "Island", "A-Bolt", "Bolt", None], r.randint(1, 2)):
                q = min(left, r.randint(0, 2))
                left -= q
                rows.append((f"d{d}", ts(day), card, r.choice(["cedh"]), q if r.random() > 0.05 else None, board))
    return rows


def _average(df):
    return sorted(str((r["format"], r["commander"], r["card_name"], r["quantity"], r["total_decks"])) for r in df.collect())


def _rebuilt(boards, by):
    return decks.average_decks(decks.decklists(boards, SIZE, by=by), boards.filter("type = 'Commander'"), BUDGET, by=by)


def test_equals_a_rebuild_after_every_load(spark, db):
    r, boards, by, seen = random.Random(5), None, ["format"], 0
    for load in range(1, 4):
        batch = spark.createDataFrame(_random_rows(r, load), BOARD_COLS)
        got = _average(maintained.maintain_average_decks(batch, db, load, SIZE, BUDGET, by, buckets=4))
        boards = spark.createDataFrame(decks.upsert_board(boards, batch, by).select(*batch.columns).collect(), BOARD_COLS)
        assert got == _average(_rebuilt(boards, by))
        lists = read_table(spark, f"{db}.decklists").select(*boards.columns)
        assert sorted(map(str, lists.collect())) == sorted(map(str, decks.decklists(boards, SIZE, by=by).collect()))
        seen += len(got)
    assert seen > 5


@pytest.mark.parametrize("table, at", [("commander_copies", "pending"), ("commander_decks", "after"), ("average_decks", "before"), ("deck_boards", "pending")])
def test_a_load_that_dies_is_repeated(spark, db, monkeypatch, table, at):
    by, first, r = ["format"], m1_boards(spark), random.Random(8)
    second = spark.createDataFrame(_random_rows(r, 9) + _random_rows(r, 9), BOARD_COLS)
    run = lambda rows, n: maintained.maintain_average_decks(rows, db, n, SIZE, BUDGET, by, buckets=2)
    run(first, 1)
    real = maintained.upsert_table

    def dies(batch, name, *args):
        if name.endswith("." + table) and at == "before":
            _lost()
        with monkeypatch.context() as m:
            if name.endswith("." + table) and at == "pending":   # the rows are written, not yet carried over
                m.setattr(DataFrameWriter, "insertInto", _lost)
            real(batch, name, *args)
        if name.endswith("." + table):
            _lost()

    with monkeypatch.context() as m:
        m.setattr(maintained, "upsert_table", dies)
        with pytest.raises(Lost):
            run(second, 2)
    got = _average(run(second, 2))
    assert got == _average(_rebuilt(decks.upsert_board(first, second, by), by))
    assert {last_load(spark, f"{db}.{t}") for t in ("commander_copies", "commander_decks", "decklists", "average_decks", "deck_boards")} == {2}


def test_the_first_load_that_dies_is_repeated(spark, db, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "insertInto", _lost)
        with pytest.raises(Lost):
            maintained.maintain_average_decks(m1_boards(spark), db, 1, SIZE, BUDGET, ["format"], buckets=2)
    got = _average(maintained.maintain_average_decks(m1_boards(spark), db, 1, SIZE, BUDGET, ["format"], buckets=2))
    assert got == _average(_rebuilt(m1_boards(spark), ["format"])) and got


def test_commanders_without_changes_are_not_written(spark, db):
    rows = [(f"d{c}", ts(1), name, "x", q, board) for c in range(40)
            for name, q, board in ((f"C{c}", 1, "Commander"), ("Island", 3, "Mainboard"))]
    maintained.maintain_average_decks(spark.createDataFrame(rows, BOARD_COLS), db, 1, SIZE, BUDGET, buckets=16)
    table = spark.table(f"{db}.average_decks")
    files = lambda: {(r[0], r[1]) for r in table.select(BUCKET, F.input_file_name()).distinct().collect()}
    before, bucket = files(), table.filter("commander = 'C7'").first()[BUCKET]
    change = [("d7", ts(2), "C7", "x", 1, "Commander"), ("d7", ts(2), "Swamp", "x", 3, "Mainboard")]
    got = maintained.maintain_average_decks(spark.createDataFrame(change, BOARD_COLS), db, 2, SIZE, BUDGET, buckets=16)
    spark.catalog.refreshTable(f"{db}.average_decks")
    table = spark.table(f"{db}.average_decks")
    assert {b for b, _ in before ^ files()} == {bucket}
    assert sorted(r["card_name"] for r in got.filter("commander = 'C7'").collect()) == ["C7", "Swamp"]
    # the same rows once more move no sum and so touch no commander
    before = files()
    maintained.maintain_average_decks(spark.createDataFrame(change, BOARD_COLS), db, 3, SIZE, BUDGET, buckets=16)
    spark.catalog.refreshTable(f"{db}.average_decks")
    table = spark.table(f"{db}.average_decks")
    assert files() == before and last_load(spark, f"{db}.average_decks") == 3


def test_a_deck_that_is_no_longer_complete_leaves(spark, db):
    whole = [("d1", ts(1), "C1", "x", 1, "Commander"), ("d1", ts(1), "Bolt", "x", 3, "Mainboard")]
    run = lambda rows, n: maintained.maintain_average_decks(spark.createDataFrame(rows, BOARD_COLS), db, n, SIZE, BUDGET, buckets=2)
    assert run(whole, 1).count() == 2
    assert run([("d1", ts(2), "Bolt", "x", 1, "Mainboard")], 2).count() == 0
    assert read_table(spark, f"{db}.decklists").count() == 0 and read_table(spark, f"{db}.commander_copies").count() == 0
    assert read_table(spark, f"{db}.commander_decks").collect()[0]["total_decks"] == 1
    assert run(whole[:0] + [("d1", ts(3), "Bolt", "x", 3, "Mainboard")], 3).count() == 2
