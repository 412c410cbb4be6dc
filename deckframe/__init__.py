"""deckframe: deck-list and basket analytics expressed as Spark DataFrame plans.

Layout
------
``functions``  column expressions (JSON, time parsing, names, prices)
``operators``  generic DataFrame -> DataFrame building blocks (latest version,
               keyed upsert, SCD2, completeness, running budgets, ownership,
               relational division, top-k, arg-min lookups)
``sources``    readers and writers for landed JSON / CSV / Parquet
``plans``      the deck-named analytics (decklists, average decks, buildable
               decks, build progress, prices, combos, leaderboards) and the
               binding of the star-schema test tables to them
``streaming``  Structured Streaming ingest with micro-batch upserts
"""

from deckframe.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
