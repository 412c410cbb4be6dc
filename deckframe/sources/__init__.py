"""Readers and writers for landed documents and tables."""

from deckframe.sources.readers import (asset_filter, flatten_decks, read_asset, read_cards, read_collection,
                                       oldest_first, read_combos, read_decks,
                                       read_json_with_rejects, split_bad_records)
from deckframe.sources.tables import (apply_snapshot, database_at, materialize, read_table, upsert_table,
                                      write_increment, write_snapshot)
from deckframe.sources.writers import AssetSpec, land_run, write_chunks, write_csv, write_jdbc, write_landing

__all__ = ["asset_filter", "read_asset", "flatten_decks", "read_cards", "read_collection", "read_combos", "read_decks",
           "read_json_with_rejects", "split_bad_records", "AssetSpec", "land_run", "materialize",
           "write_chunks", "write_csv", "write_increment", "write_jdbc", "write_landing",
           "write_snapshot", "read_table", "upsert_table", "apply_snapshot", "database_at", "oldest_first"]
