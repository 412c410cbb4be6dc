"""Deck analytics: boards, decklists, details, average decks, ownership, progress.

Column vocabulary (as landed): a board row is
``deck_id, lastUpdatedAtUtc, card_name, format, quantity, type``.
Every function takes ``by`` -- extra leading group keys such as ``format`` -- so
all formats run in one job instead of one copy of the model per format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deckframe.constants import BOARD_TYPES, MAX_LINE_COST
from deckframe.functions.json import board_quantity, parse_board, plain_keys
from deckframe.functions.names import (BUILDABLE_UNLIMITED, PARTNER_SEPARATOR,
                                       PROGRESS_UNLIMITED, strip_prefix,
                                       unlimited_quantity)
from deckframe.operators.groups import (complete_groups, distinct_count,
                                        groups_where_total, ordered_concat)
from deckframe.operators.incremental import high_water_mark, newer_than, upsert
from deckframe.operators.latest import latest_per_key
from deckframe.operators.ownership import fully_owned_groups, owned_rows
from deckframe.operators.running import budget_cut
from deckframe.operators.util import as_list


VERSION = "lastUpdatedAtUtc"
# Columns of a deck row that its details are made of.
DETAIL_COLUMNS = ["id", "name", "description", "publicUrl", "likeCount", "viewCount", "commentCount", "colors", VERSION,
                  "createdAtUtc", "hubs"]
COST_TYPE = "decimal(24,2)"
NO_CARDS = ["{}", '{"count":0,"cards":{}}']    # boards that give no rows: not parsed


def explode_board(decks: DataFrame, board: str, since=None) -> DataFrame:
    """One row per card key of one board (Q1).

    ``decks``: ``id, lastUpdatedAtUtc, format, <board>`` (board = JSON text).
    ``since``: optional incremental mark on ``lastUpdatedAtUtc``.
    """
    src = newer_than(decks, VERSION, since)
    parsed = src.select(F.col("id").alias("deck_id"), F.col(VERSION), F.col("format"),
                        parse_board(board)["cards"].alias("cards"))
    return (parsed.select("deck_id", VERSION, "format", F.explode("cards").alias("key", "entry"))
                  .select("deck_id", VERSION, F.col("entry.card.name").alias("card_name"),
                          "format", board_quantity("entry.quantity").alias("quantity")))


def board_cards(decks: DataFrame, boards: dict[str, str] | None = None, since=None, carry=()) -> DataFrame:
    """All boards of all decks in one scan, tagged with ``type`` (Q1 x3 + X1).
    ``carry``: deck columns that stay beside the cards.

    Each deck row is expanded to its boards and each board to its cards, with no
    union of three separate scans.  Boards without cards go before any is
    parsed, and each is parsed once: in a projection of its own, as within an
    expansion it would be interpreted, and expanded by ``explode_outer``, as for
    ``explode`` a filter on the parsed cards, so a second parse, is put in front.
    """
    boards = boards or BOARD_TYPES
    src = newer_than(decks, VERSION, since)
    texts = F.array(*[F.struct(F.lit(t).alias("type"), F.when(~F.col(c).isin(NO_CARDS), F.col(c)).alias("text")) for c, t in boards.items()])
    per_board = (src.select(F.col("id").alias("deck_id"), F.col(VERSION), F.col("format"), *carry, F.explode(texts).alias("b"))
                    .filter(F.col("b.text").isNotNull()))
    parsed = per_board.select("deck_id", VERSION, "format", *carry, F.col("b.type").alias("type"),
                              parse_board(plain_keys("b.text"))["cards"].alias("cards"))
    return (parsed.select("deck_id", VERSION, "format", *carry, "type", F.explode_outer("cards").alias("key", "entry"))
                  .filter(F.col("key").isNotNull())     # null for no cards only
                  .select("deck_id", VERSION, F.col("entry.card.name").alias("card_name"),
                          "format", board_quantity("entry.quantity").alias("quantity"), "type", *carry))


def upsert_board(target: DataFrame | None, batch: DataFrame, by=()) -> DataFrame:
    """Board table maintenance: upsert on (deck_id, card_name[, type]); removed
    cards are not deleted and linger with their older timestamp (as landed)."""
    keys = as_list(by) + ["deck_id", "card_name"] + (["type"] if "type" in batch.columns else [])
    return upsert(target, batch, keys)


def decklists(boards: DataFrame, size: int = 100, scope: str = "board", by=(),
              method: str = "aggregate") -> DataFrame:
    """Latest complete decklists (Q2).

    Latest version is taken per board of a deck (``scope="board"``: a dropped
    companion keeps its stale row); ``scope="deck"`` takes it per deck.  Ties on
    the timestamp are all kept.  Decks whose latest rows total exactly ``size``
    are returned with all their latest rows.

    ``method="aggregate"`` (default): quantity per (board, version), the newest
    version of each board with its quantity (``max_by``), then one row per deck
    with its total and the list of its newest versions (one entry per board).
    Complete decks give their (deck, board, version) keys, and the board rows
    pass one left-semi join against them: two scans of the board rows, one
    shuffle of them.  ``method="semi"`` composes the generic
    :func:`latest_per_key` and :func:`complete_groups`; ``method="window"`` uses
    windows (one shuffle; for small groups only).
    """
    by = as_list(by)
    keys = by + ["deck_id"] + (["type"] if scope == "board" else [])
    if method in ("semi", "window"):
        latest = latest_per_key(boards, keys, VERSION, method=method)
        return complete_groups(latest, by + ["deck_id"], "quantity", size)
    valid = boards
    for k in keys + [VERSION]:
        valid = valid.filter(F.col(k).isNotNull())
    per_version = valid.groupBy(*keys, VERSION).agg(F.sum("quantity").alias("__q"))
    newest = per_version.groupBy(*keys).agg(F.max(VERSION).alias(VERSION),
                                            F.max_by("__q", VERSION).alias("__q"))
    boards_of = [k for k in keys if k not in by + ["deck_id"]] + [VERSION]
    complete = (newest.groupBy(*by, "deck_id")
                      .agg(F.sum("__q").alias("__total"), F.collect_list(F.struct(*boards_of)).alias("__boards"))
                      .filter(F.col("__total") == F.lit(size)))
    keep = complete.select(*by, "deck_id", F.inline("__boards")).select(*keys, VERSION)
    return boards.join(keep, on=keys + [VERSION], how="left_semi").select(*boards.columns)


def deck_details(history: DataFrame, commanders: DataFrame, lists: DataFrame,
                 mark=None, by=()) -> DataFrame:
    """Deck details (Q3): history row, ``[and]``-joined commander names, distinct
    card count of the complete list.

    The count is joined through the commander row, so a deck without commander
    rows gets a NULL count.  ``mark``: only history rows strictly newer than it
    (incremental refresh; combine with :func:`upsert` on ``deck_id``).
    """
    by = as_list(by)
    decks = newer_than(history, VERSION, mark).select(
        *by, *[F.col(c).alias({"id": "deck_id", "name": "deck_name"}.get(c, c)) for c in DETAIL_COLUMNS])
    if mark is not None:  # strings and counts of the newer decks only
        fresh = decks.select(*by, "deck_id")
        commanders = commanders.join(fresh, by + ["deck_id"], "left_semi")
        lists = lists.join(fresh, by + ["deck_id"], "left_semi")
    cmd = ordered_concat(commanders, by + ["deck_id"], "card_name", PARTNER_SEPARATOR,
                         alias="commander_name")
    counts = distinct_count(lists, by + ["deck_id"], "card_name", alias="card_count")
    cmd_counts = cmd.join(counts, on=by + ["deck_id"], how="left")
    out = decks.join(cmd_counts, on=by + ["deck_id"], how="left")
    return out.select(*by, "deck_id", "commander_name", "deck_name", "description",
                      F.col("card_count").cast("bigint").alias("card_count"), "colors",
                      "publicUrl", "likeCount", "viewCount", "commentCount", VERSION,
                      "createdAtUtc", "hubs")


def refresh_deck_details(target: DataFrame | None, history: DataFrame, commanders: DataFrame,
                         lists: DataFrame, by=(), mark=None) -> DataFrame:
    """Incremental Q3: details of decks newer than ``mark`` (by default the
    target's newest row), upserted on ``deck_id``."""
    mark = high_water_mark(target, VERSION) if mark is None else mark
    fresh = deck_details(history, commanders, lists, mark, by)
    return upsert(target, fresh, as_list(by) + ["deck_id"])


def average_decks(lists: DataFrame, commanders: DataFrame, budget: int = 100,
                  normalize_join: bool = False, by=(), keep_type: bool = False) -> DataFrame:
    """Average deck per commander (Q4).

    Per (commander, card, board type): total copies over the complete lists of
    the commander's decks, divided by the number of decks of the commander
    (all decks in the commander board, complete or not), rounded up.  Cards are
    taken most-played first (average DESC, name ASC) while the running total of
    rounded copies stays within ``budget``; cards tied on both order keys share
    one running total.

    The deck count is keyed by the prefix-stripped commander name but joined on
    the raw name (``normalize_join=False``), so commanders seen only under the
    rebalanced prefix get no count; ``normalize_join=True`` joins on the
    stripped name.
    """
    by = as_list(by)
    led = commander_lines(lists, commanders, by)
    # copies per raw commander name first: the counts then meet one row per
    # (commander, card, board) instead of every line
    copies = led.groupBy(*by, "cmd_raw", "card_name", "type").agg(F.sum("quantity").alias("quantity"))
    counts = (commander_keys(commanders, by).groupBy(*by, "cmd_key")
              .agg(F.count_distinct("deck_id").alias("total_decks")))
    return average_of(copies, counts, budget, normalize_join, by, keep_type)


def commander_keys(commanders: DataFrame, by=()) -> DataFrame:
    """(cmd_key, deck_id): decks under the prefix-stripped names of their commanders."""
    return (commanders.filter(F.col("card_name").isNotNull())
            .select(*as_list(by), strip_prefix("card_name").alias("cmd_key"), "deck_id"))


def commander_lines(lists: DataFrame, commanders: DataFrame, by=()) -> DataFrame:
    """(cmd_raw, card_name, type, quantity): the lines of complete lists under
    each commander of their deck; card names are stripped."""
    by = as_list(by)
    cmd = (commanders.select(*by, "deck_id", F.col("card_name").alias("cmd_raw"))
                     .filter(F.col("cmd_raw").isNotNull()))
    return (lists.select(*by, "deck_id", "card_name", "type", "quantity")
                 .join(cmd, on=by + ["deck_id"], how="inner")
                 .select(*by, "cmd_raw", strip_prefix("card_name").alias("card_name"), "type", "quantity"))


def average_of(copies: DataFrame, counts: DataFrame, budget: int = 100, normalize_join: bool = False,
               by=(), keep_type: bool = False) -> DataFrame:
    """Q4 from copies per (cmd_raw, card_name, type) and deck counts per cmd_key."""
    by = as_list(by)
    per_commander = counts.select(*[F.col(b).alias(f"__pc_{b}") for b in by], "cmd_key", "total_decks")
    join_key = strip_prefix("cmd_raw") if normalize_join else F.col("cmd_raw")
    on = join_key == F.col("cmd_key")
    for b in by:
        on = on & (F.col(b) == F.col(f"__pc_{b}"))
    rows = copies.join(per_commander, on, "left")
    stats = (rows.groupBy(*by, strip_prefix("cmd_raw").alias("commander"), "card_name", "type")
                 .agg(F.sum("quantity").alias("quantity"),
                      F.max("total_decks").alias("total_decks"))
                 .withColumn("avg", F.col("quantity") / F.col("total_decks"))
                 .withColumn("ceilavg", F.ceil("avg")))
    kept = budget_cut(stats, "ceilavg", by + ["commander"],
                      [F.col("avg").desc(), F.col("card_name").asc()], budget)
    return kept.select(*by, "commander", "card_name", *(["type"] if keep_type else []),
                       F.col("ceilavg").alias("quantity"), "total_decks")


def collection_totals(src: DataFrame, name: str = "name", quantity: str = "quantity") -> DataFrame:
    """Owned copies per card name (Q11)."""
    return src.groupBy(F.col(name).alias("name")).agg(F.sum(quantity).alias("quantity"))


def owned_collection(collection: DataFrame, unlimited=BUILDABLE_UNLIMITED) -> DataFrame:
    """Collection with unlimited entries (basics) raised to 99 copies."""
    return collection.select("name", unlimited_quantity("name", "quantity", unlimited).alias("quantity"))


def buildable_decks(lists: DataFrame, collection: DataFrame, size: int = 100,
                    unlimited=BUILDABLE_UNLIMITED, by=()) -> DataFrame:
    """Complete lists whose fully owned lines total exactly ``size`` (Q5).

    A line is owned only when the collection has at least its quantity.  Rows
    of buildable decks come back with ``name`` (NULL for unowned lines).
    """
    have = owned_collection(collection, unlimited)
    return fully_owned_groups(lists, have, as_list(by) + ["deck_id"], "card_name", "quantity",
                              size, "==")


def buildable_average_decks(average: DataFrame, collection: DataFrame, size: int = 100,
                            unlimited=BUILDABLE_UNLIMITED, by=()) -> DataFrame:
    """Average decks a collection can build (Q6) plus a ``quantity card`` line
    (NULL where the average is)."""
    have = owned_collection(collection, unlimited)
    rows = fully_owned_groups(average, have, as_list(by) + ["commander"], "card_name",
                              "quantity", size, "==")
    return rows.withColumn("copy_paste", F.concat(F.col("quantity").cast("string"),
                                                  F.lit(" "), F.col("card_name")))


def deck_cost(lists: DataFrame, prices: DataFrame, by=()) -> DataFrame:
    """Cost per deck: ``SUM(min_usd * quantity)`` over the lines and the printings
    of their card, with costs outside [0, 9999] (unpriced sentinels) set to 0;
    unmatched cards add nothing.

    Each different (card, quantity) of the lists is priced once: against its
    card's different prices, each with its number of printings.  Complete lists
    total a fixed size, so a card has few quantities, and the work grows with
    the printings, not with lines times printings.  ``lists`` is read twice.
    """
    by = as_list(by)
    kind = COST_TYPE if isinstance(prices.schema["min_usd"].dataType, T.DecimalType) else "double"
    p = (prices.filter(F.col("name").isNotNull() & F.col("min_usd").isNotNull())
               .groupBy(F.col("name").alias("__pname"), "min_usd").agg(F.count(F.lit(1)).alias("__printings")))
    pairs = lists.select(F.col("card_name").alias("__card"), F.col("quantity").alias("__copies")).distinct()
    cost = F.col("min_usd") * F.col("__copies")
    counted = F.when(cost.between(0, MAX_LINE_COST), cost).otherwise(F.lit(0))
    lines = (pairs.join(p, F.col("__card") == F.col("__pname"))
                  .groupBy("__card", "__copies")
                  .agg(F.sum((counted * F.col("__printings")).cast(kind)).cast(kind).alias("__line")))
    joined = lists.join(lines, (F.col("card_name") == F.col("__card")) & F.col("quantity").eqNullSafe(F.col("__copies")), "left")
    return joined.groupBy(*by, "deck_id").agg(F.sum("__line").alias("cost"))


def deck_build_progress(lists: DataFrame, details: DataFrame, collection: DataFrame,
                        prices: DataFrame, size: int = 100,
                        unlimited=PROGRESS_UNLIMITED, by=()) -> DataFrame:
    """Per deck with at least one owned line: owned copies (at most ``size``),
    deck price and details (Q7)."""
    by = as_list(by)
    have = owned_collection(collection, unlimited)
    marked = owned_rows(lists, have, "card_name", "quantity")
    progress = groups_where_total(marked.filter(F.col("name").isNotNull()),
                                  by + ["deck_id"], "quantity", size, "<=", alias="percent_complete")
    cost = deck_cost(lists, prices, by)
    d = details.select(*by, "deck_id", F.col("deck_id").alias("__details_deck"),
                       "commander_name", "deck_name", "card_count", "hubs",
                       "description", "commentCount", "likeCount", "viewCount", "publicUrl",
                       VERSION)
    out = progress.join(d, on=by + ["deck_id"], how="left")
    # price joins through the details row: no details -> no price
    c = cost.select(*[F.col(b).alias(f"__cost_{b}") for b in by],
                    F.col("deck_id").alias("__cost_deck"), "cost")
    on = F.col("__cost_deck") == F.col("__details_deck")
    for b in by:
        on = on & (F.col(f"__cost_{b}") == F.col(b))
    out = out.join(c, on, "left")
    return out.select(*by, "deck_id", "commander_name", "deck_name", "card_count",
                      "percent_complete", F.col("cost").alias("price"), "hubs", "description",
                      "commentCount", "likeCount", "viewCount", "publicUrl", VERSION)


# Presentation orders (O1, O2).  Tables are unordered; apply these only to the
# final result shown to a reader.


def decklist_display(lists: DataFrame) -> DataFrame:
    """Deck, board, larger quantities first, then name."""
    return lists.orderBy("deck_id", "type", F.col("quantity").desc(), "card_name")


def average_display(average: DataFrame) -> DataFrame:
    """Commander, board type (when kept), larger quantities first."""
    cols = ["commander"] + (["type"] if "type" in average.columns else [])
    return average.orderBy(*cols, F.col("quantity").desc(), "card_name")


def buildable_average_display(rows: DataFrame) -> DataFrame:
    """Commander, the commander card itself first, then larger quantities."""
    first = F.when(F.col("commander") == F.col("card_name"), F.lit("a")).otherwise(F.lit("b"))
    return rows.orderBy("commander", first, F.col("quantity").desc(), "card_name")


def progress_display(progress: DataFrame) -> DataFrame:
    """Most complete decks first."""
    return progress.orderBy(F.col("percent_complete").desc(), "deck_id")
