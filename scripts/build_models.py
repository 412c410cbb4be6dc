"""Land new deck documents and rebuild every model.

    python scripts/build_models.py --decks <landing folder or glob> \\
        --cards <card bulk json> --collection <export csv> --out <model root> \\
        [--state <deck history root>] [--formats cedh pauperedh] [--buckets 64]

1. read deck documents newer than the deck history's high-water mark,
2. keyed upsert (newest document per deck) into the deck table,
3. build boards, decklists, details, average decks, ownership, progress,
   prices, images and leaderboards for every format in one job.

Paths may be on any file system Spark can reach.  The tables are in the session's
catalog: give Spark a metastore, so that the next run finds them.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deckframe.operators.incremental import high_water_mark  # noqa: E402
from deckframe.operators.latest import dedupe_keep_last  # noqa: E402
from deckframe.plans.formats import build_format  # noqa: E402
from deckframe.session import get_spark  # noqa: E402
from deckframe.sources.readers import read_cards, read_collection, read_combos, read_decks  # noqa: E402
from deckframe.sources.tables import database_at, read_table, upsert_table  # noqa: E402


DECK_BUCKETS = 64


def land_decks(spark, decks_path: str, state_root: str, max_rows: int = 0):
    """Steps 1-2: returns the current deck history after the upsert."""
    table = f"{database_at(spark, state_root)}.decks"
    history = read_table(spark, table)
    mark = high_water_mark(history, "lastUpdatedAtUtc")
    fresh = read_decks(spark, decks_path, since=mark, max_rows=max_rows)
    upsert_table(dedupe_keep_last(fresh, "id", ["lastUpdatedAtUtc"]), table, ["id"], DECK_BUCKETS)
    return read_table(spark, table)


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--decks", required=True)
    ap.add_argument("--cards", required=True)
    ap.add_argument("--collection", required=True)
    ap.add_argument("--collection-encoding", default="UTF-16")
    ap.add_argument("--out", required=True)
    ap.add_argument("--state", default=None, help="deck history root (default: <out>/_state)")
    ap.add_argument("--formats", nargs="*", default=None)
    ap.add_argument("--buckets", type=int, default=0)
    ap.add_argument("--combos", default=None, help="combo documents, one to a line")
    ap.add_argument("--incremental", action="store_true", help="upsert board rows and details of newer decks")
    ap.add_argument("--max-rows", type=int, default=0)
    ap.add_argument("--size", type=int, default=100)
    ap.add_argument("--budget", type=int, default=100)
    args = ap.parse_args(argv)

    spark = get_spark(app="deckframe-models")
    history = land_decks(spark, args.decks, args.state or f"{args.out.rstrip('/')}/deck_history",
                         args.max_rows)
    cards = read_cards(spark, args.cards)
    collection = read_collection(spark, args.collection, args.collection_encoding)
    models = build_format(spark, history, collection.select("name", "quantity"), cards, cards,
                          args.out, formats=args.formats, size=args.size, budget=args.budget,
                          deck_buckets=args.buckets, incremental=args.incremental,
                          combo_history=read_combos(spark, args.combos) if args.combos else None)
    for name, df in models.items():
        print(name, df.count())


if __name__ == "__main__":
    main()
