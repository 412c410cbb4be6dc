"""Average decks kept current from the decks that changed (Q1, Q2, Q4, Q15).

A load brings new board rows of some decks.  Their board rows before and after
it give their complete lists before and after, and the difference of the two,
as signed sums, is added to two stored aggregates: copies per (commander, card,
board) and decks per commander.  The budget cut is redone for the commanders
whose sums changed and replaces their rows; other commanders are neither read
nor written, up to the hash buckets they share.

Tables of the database, each keyed and bucketed (:mod:`deckframe.sources.tables`):
``deck_boards`` and ``decklists`` by deck, ``commander_copies``,
``commander_decks`` and ``average_decks`` by commander.

Loads are numbered upwards.  Each table notes the load together with its rows,
and ``deck_boards``, from which the differences come, is written last.  A load
that died is repeated with the same rows: it finds the same differences and
skips the tables that hold it already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckframe.functions.names import strip_prefix
from deckframe.operators.util import as_list
from deckframe.plans import decks
from deckframe.session import staged
from deckframe.sources.tables import last_load, read_table, rows_beside, upsert_table

COMMANDER = "type = 'Commander'"


def _lines(boards: DataFrame, lists: DataFrame, by: list[str]) -> DataFrame:
    return decks.commander_lines(lists, boards.filter(COMMANDER), by).withColumn("commander", strip_prefix("cmd_raw"))


def _decks_of(boards: DataFrame, by: list[str]) -> DataFrame:
    return decks.commander_keys(boards.filter(COMMANDER), by).filter(F.col("deck_id").isNotNull()).distinct()


def _signed(new: DataFrame, old: DataFrame | None) -> DataFrame:
    rows = new.withColumn("sign", F.lit(1))
    return rows if old is None else rows.unionByName(old.withColumn("sign", F.lit(-1)))


def copies_delta(new: DataFrame, old: DataFrame | None, by=()) -> DataFrame:
    """Signed sums of commander lines: copies, lines with a known quantity, lines."""
    known = F.col("quantity").isNotNull().cast("int")
    sums = (_signed(new, old).groupBy(*as_list(by), "commander", "cmd_raw", "card_name", "type")
            .agg(F.sum(F.col("sign") * F.coalesce("quantity", F.lit(0))).alias("copies"),
                 F.sum(F.col("sign") * known).alias("counted"), F.sum("sign").alias("lines")))
    return sums.filter("copies <> 0 OR counted <> 0 OR lines <> 0")


def decks_delta(new: DataFrame, old: DataFrame | None, by=()) -> DataFrame:
    """Signed numbers of decks per commander key, from distinct (key, deck)."""
    return (_signed(new, old).groupBy(*as_list(by), "cmd_key").agg(F.sum("sign").alias("total_decks"))
            .filter("total_decks <> 0"))


def _adder(keys: list[str], sums: list[str], alive: str):
    """Merge that adds the batch to the rows of its keys; rows without any ``alive`` go."""
    def merge(rows: DataFrame | None, batch: DataFrame) -> DataFrame:
        every = batch if rows is None else rows.unionByName(batch)
        return every.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums)).filter(F.col(alive) > 0)
    return merge


def _replacer(keys: list[str], fresh: DataFrame):
    """Merge that puts ``fresh`` in the place of the rows of the batch's keys."""
    def merge(rows: DataFrame | None, batch: DataFrame) -> DataFrame:
        return fresh if rows is None else rows.join(batch, keys, "left_anti").unionByName(fresh)
    return merge


def maintain_average_decks(batch: DataFrame, database: str, load: int, size: int = 100, budget: int = 100,
                           by=(), buckets: int = 256) -> DataFrame:
    """Upsert board rows (``batch``) and bring lists and average decks up to date;
    returns the average decks."""
    spark, by = batch.sparkSession, as_list(by)
    table = lambda name: f"{database}.{name}"
    if (last_load(spark, table("deck_boards")) or 0) < load:
        deck, leader = by + ["deck_id"], by + ["commander"]
        batch = staged(batch, "board-rows")
        changed = staged(batch.select(*deck).distinct(), "changed-decks")
        beside = rows_beside(changed, table("deck_boards"), deck)
        old = None if beside is None else staged(beside.join(changed, deck, "left_semi"), "boards-before")
        new = staged(decks.upsert_board(old, batch, by), "boards-after")
        lists = staged(decks.decklists(new, size, by=by), "lists-after")
        lines, led = None, None
        if old is not None:
            lines, led = _lines(old, decks.decklists(old, size, by=by), by), _decks_of(old, by)
        copies = staged(copies_delta(_lines(new, lists, by), lines, by), "copies")
        counts = staged(decks_delta(_decks_of(new, by), led, by), "counts")
        upsert_table(copies, table("commander_copies"), leader, buckets,
                     _adder(leader + ["cmd_raw", "card_name", "type"], ["copies", "counted", "lines"], "lines"), load)
        upsert_table(counts, table("commander_decks"), by + ["cmd_key"], buckets,
                     _adder(by + ["cmd_key"], ["total_decks"], "total_decks"), load)
        upsert_table(changed, table("decklists"), deck, buckets, _replacer(deck, lists), load)
        moved = staged(copies.select(*leader).unionByName(counts.select(*by, strip_prefix("cmd_key").alias("commander"))).distinct(), "commanders")
        sums = rows_beside(moved, table("commander_copies"), leader).join(moved, leader, "left_semi")
        sums = sums.withColumn("quantity", F.when(F.col("counted") > 0, F.col("copies")))
        average = decks.average_of(sums, read_table(spark, table("commander_decks")), budget, by=by)
        upsert_table(moved, table("average_decks"), leader, buckets, _replacer(leader, average), load)
        upsert_table(changed, table("deck_boards"), deck, buckets, _replacer(deck, new), load)
    return read_table(spark, table("average_decks"))
