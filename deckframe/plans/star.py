"""Binding of the star-schema test tables to the deck vocabulary.

The analytics are generic over column names; this module derives deck-shaped
inputs from ``lineitem / part / orders / events`` so the real code paths run
on data that grows with the tables:

* deck = order (``l_orderkey``), one landed version per ship date
  (``lastUpdatedAtUtc = l_shipdate``);
* board = Commander for line 1, Companion for line 2, Mainboard otherwise;
* card = part name; PROMO parts are double-faced cards named
  ``"<word1> // <word2>"`` whose faces are the two words, and other parts whose
  size is a multiple of six are rebalanced cards, named with the prefix;
* quantity = ``l_quantity``;
* collection export lines = parts with ``p_size <= 10`` (name, p_size);
* printings (for images and prices) = parts: release rank ``p_size``, input
  order ``p_partkey``, usd = retail price, usd_foil = retail price + size;
* deck history = orders (name = priority, description = status, ...);
* combos = orders whose ``uses`` are the order's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deckframe.functions.names import FACE_SEPARATOR, REBALANCED_PREFIX

# Binding parameters (fixed so results are reproducible).
COLLECTION_MAX_SIZE = 10
DOUBLE_FACED_TYPE = "PROMO"
FOREIGN_BRAND = "Brand#9"       # printings of this brand are not English
REBALANCED_EVERY = 6            # single-faced parts of these sizes are rebalanced cards
FLAVOR_MIN_SIZE = 49            # printings at least this size carry a flavour name
DECK_FORMAT = "lineitem"
# Names that play the role of basic lands (always owned) in this binding.
BASIC_PATTERNS = ["small%"]


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table.  The schema is inferred once per path and then given to
    the reader, so repeated reads in a query skip the footer-reading job (the
    input tables are read-only)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def board_type(linenumber) -> Column:
    ln = F.col(linenumber) if isinstance(linenumber, str) else linenumber
    return (F.when(ln == 1, F.lit("Commander"))
             .when(ln == 2, F.lit("Companion"))
             .otherwise(F.lit("Mainboard")))


def card_name(p_name="p_name", p_type="p_type", p_size="p_size") -> Column:
    return (F.when(F.col(p_type) == DOUBLE_FACED_TYPE,
                   F.replace(F.col(p_name), F.lit(" "), F.lit(FACE_SEPARATOR)))
             .when(F.col(p_size) % REBALANCED_EVERY == 0, F.concat(F.lit(REBALANCED_PREFIX), F.col(p_name)))
             .otherwise(F.col(p_name)))


def parts(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", card_name().alias("card_name"),
                                          "p_name", "p_type", "p_brand", "p_size",
                                          "p_retailprice")


def deck_boards(spark: SparkSession, d: str, fmt: Column | None = None) -> DataFrame:
    """Board rows ``deck_id, lastUpdatedAtUtc, card_name, format, quantity, type``."""
    li = table(spark, d, "lineitem")
    p = parts(spark, d).select("p_partkey", "card_name")
    rows = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    cols = [F.col("l_orderkey").alias("deck_id"), F.col("l_shipdate").alias("lastUpdatedAtUtc"),
            F.col("card_name"), (fmt if fmt is not None else F.lit(DECK_FORMAT)).alias("format"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            board_type("l_linenumber").alias("type")]
    return rows.select(*cols)


def deck_boards_by_priority(spark: SparkSession, d: str) -> DataFrame:
    """Board rows whose ``format`` is the order priority (one model family per value)."""
    b = deck_boards(spark, d)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return (b.join(o, b["deck_id"] == o["o_orderkey"], "inner")
             .withColumn("format", F.col("o_orderpriority"))
             .drop("o_orderkey", "o_orderpriority"))


NO_CARDS = '{"count":0,"cards":{}}'    # the text of a board without cards
LATER_DAYS = 400   # between the two documents of an order in the asset feed


def commanders(boards: DataFrame) -> DataFrame:
    return boards.filter(F.col("type") == "Commander")


def collection_export(spark: SparkSession, d: str) -> DataFrame:
    """Collection export lines ``name, quantity`` (several lines per name)."""
    return (parts(spark, d).filter(F.col("p_size") <= COLLECTION_MAX_SIZE)
            .select(F.col("card_name").alias("name"), F.col("p_size").cast("bigint").alias("quantity")))


def printings(spark: SparkSession, d: str) -> DataFrame:
    """One printing per part in the shape of a card bulk file."""
    p = parts(spark, d)
    words = F.split(F.col("p_name"), " ")
    face = lambda i, side: F.struct(
        words.getItem(i).alias("name"), F.col("p_type").alias("type_line"),
        F.struct(F.concat(F.lit(f"/normal/{side}/"), F.col("p_partkey").cast("string"))
                 .alias("normal")).alias("image_uris"))
    double = F.col("p_type") == DOUBLE_FACED_TYPE
    return p.select(
        F.col("card_name").alias("name"),
        F.when(double, F.lit("transform")).otherwise(F.lit("normal")).alias("layout"),
        F.when(F.col("p_brand") == FOREIGN_BRAND, F.lit("fr")).otherwise(F.lit("en")).alias("lang"),
        F.when(F.col("p_size") >= FLAVOR_MIN_SIZE, F.col("p_brand")).alias("flavor_name"),
        F.col("p_size").alias("released_at"),
        F.col("p_partkey").alias("seq"),
        F.col("p_partkey").cast("string").alias("oracle_id"),
        F.col("p_type").alias("type_line"),
        F.struct(F.when(~double, F.concat(F.lit("/normal/"), F.col("p_brand"), F.lit("/"),
                                          F.col("p_partkey").cast("string")))
                 .alias("normal")).alias("image_uris"),
        F.when(double, F.array(face(0, "front"), face(1, "back"))).alias("card_faces"),
        F.struct(F.col("p_retailprice").cast("string").alias("usd"),
                 (F.col("p_retailprice") + F.col("p_size")).cast("string").alias("usd_foil"),
                 F.lit(None).cast("string").alias("usd_etched"),
                 F.when(F.col("p_size") > 25, F.col("p_retailprice").cast("string")).alias("eur"),
                 F.lit(None).cast("string").alias("eur_foil"),
                 F.lit(None).cast("string").alias("tix")).alias("prices"),
    )


def deck_history(spark: SparkSession, d: str) -> DataFrame:
    """Deck history rows (one per deck) derived from orders."""
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("description"),
        F.concat(F.lit("/decks/"), F.col("o_orderkey").cast("string")).alias("publicUrl"),
        F.col("o_custkey").alias("likeCount"),
        F.floor("o_totalprice").cast("bigint").alias("viewCount"),
        F.col("o_orderkey").alias("commentCount"),
        F.col("o_orderstatus").alias("colors"),
        F.col("o_orderdate").alias("lastUpdatedAtUtc"),
        F.col("o_orderdate").alias("createdAtUtc"),
        F.lit("{}").alias("hubs"))


def deck_feed(spark: SparkSession, d: str) -> DataFrame:
    """The deck documents as JSON text lines, as a feed would send them: some
    quantities quoted, some with a fraction, boards without cards as JSON null,
    hubs as a list."""
    docs = deck_documents(spark, d)
    odd = F.pmod(F.col("id"), F.lit(3))

    def board(c):
        text = F.when(odd == 0, F.regexp_replace(c, r'"quantity":(\d+)', '"quantity":"$1"')) \
                .when(odd == 1, F.regexp_replace(c, r'"quantity":(\d+)', '"quantity":$1.0')).otherwise(F.col(c))
        return F.when(F.col(c).startswith('{"count":0'), F.lit("null")).otherwise(text)

    line = F.concat(F.lit('{"id":"'), F.col("id").cast("string"), F.lit('","format":"'), F.col("format"), F.lit('","lastUpdatedAtUtc":"'),
                    F.date_format("lastUpdatedAtUtc", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit('","hubs":["h",{"n":1}],"boards":{"commanders":'),
                    board("commanders"), F.lit(',"mainboard":'), board("mainboard"), F.lit(',"companions":'), board("companions"), F.lit("}}"))
    return docs.select(line.alias("value"))


def asset_feed(spark: SparkSession, d: str) -> DataFrame:
    """Deck documents as JSON text lines with hubs and commander cards: one per
    order, and a later one for every third order."""
    o = table(spark, d, "orders")
    again = F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.array(F.lit(0), F.lit(LATER_DAYS))).otherwise(F.array(F.lit(0)))
    o = o.withColumn("later", F.explode(again))
    hub = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Competitive").otherwise("Budget")
    card = F.struct(F.lit(1).alias("quantity"), F.struct(
        F.concat(F.lit("c"), F.pmod("o_custkey", F.lit(10)).cast("string")).alias("id"), F.col("o_orderpriority").alias("name")).alias("card"))
    return o.select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderstatus") == "F", "commander").otherwise("modern").alias("format"), F.array(hub, F.lit("All")).alias("hubNames"),
        F.floor("o_totalprice").cast("string").alias("publicId"), F.col("later").cast("string").alias("description"),
        F.date_format(F.expr("o_orderdate + make_dt_interval(later, 0, 0, 0)"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("lastUpdatedAtUtc"),
        F.struct(F.struct(F.create_map(F.lit("k"), card).alias("cards")).alias("commanders")).alias("boards"))).alias("value"))


def deck_documents(spark: SparkSession, d: str) -> DataFrame:
    """Landed deck documents: one per (order, ship date) with three JSON boards.

    Card keys are ``line-part-supplier`` (unique within a document).  The
    per-document grouping holds one order's lines for one date (bounded).
    """
    li = table(spark, d, "lineitem")
    p = parts(spark, d).select("p_partkey", "card_name")
    rows = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    key = F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey")
    entry = F.struct(F.col("l_quantity").cast("int").alias("quantity"),
                     F.struct(F.col("card_name").alias("name")).alias("card"))
    t = board_type("l_linenumber")

    def board(label):
        # collect_list leaves nulls out
        return F.collect_list(F.when(t == label, F.struct(key.alias("k"), entry.alias("v")))).alias(label)

    def text(label, name):
        e = F.col(label)
        full = F.to_json(F.struct(F.size(e).alias("count"), F.map_from_entries(e).alias("cards")))
        return F.when(F.size(e) == 0, F.lit(NO_CARDS)).otherwise(full).alias(name)

    # Partition on exactly the document key: the grouping below then needs no
    # further exchange, and list building (which partial aggregation would not
    # shrink) runs after the shuffle instead of in the scan tasks.
    docs = (rows.repartition("l_orderkey", "l_shipdate")
                .groupBy("l_orderkey", "l_shipdate")
                .agg(board("Commander"), board("Mainboard"), board("Companion")))
    return docs.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("lastUpdatedAtUtc"),
                       F.lit(DECK_FORMAT).alias("format"),
                       text("Commander", "commanders"), text("Mainboard", "mainboard"), text("Companion", "companions"))


def combo_history(spark: SparkSession, d: str) -> DataFrame:
    """Combo documents ``id, status, combodata`` (one per order, uses = its lines)."""
    li = table(spark, d, "lineitem")
    p = parts(spark, d).select("p_partkey", "card_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority",
                                         "o_totalprice")
    rows = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    use = F.struct(F.struct(F.col("l_partkey").cast("int").alias("id"),
                            F.col("card_name").alias("name"),
                            F.col("l_suppkey").cast("string").alias("oracleId")).alias("card"))
    uses = rows.repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(use)).alias("uses"))
    doc = uses.join(o, uses["l_orderkey"] == o["o_orderkey"], "inner")
    data = F.to_json(F.struct(
        F.col("uses"),
        F.col("o_orderstatus").alias("identity"),
        F.col("o_orderpriority").alias("description"),
        F.round(F.col("o_totalprice") / 1000, 0).cast("int").alias("popularity"),
        F.lit(False).alias("spoiler")))
    return doc.select(F.col("o_orderkey").cast("string").alias("id"),
                      F.lit("ok").alias("status"), data.alias("combodata"))
