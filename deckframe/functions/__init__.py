"""Column expressions: everything here returns a ``Column`` and stays in the JVM."""

from deckframe.functions.names import (first_part, last_part, like_any,
                                       strip_prefix, unlimited_quantity)
from deckframe.functions.json import (BOARD_SCHEMA, COMBO_USES_SCHEMA, apply_transforms,
                                      PRICE_SCHEMA, json_field,
                                      list_to_indexed_map, jsonify_nested,
                                      parse_board, parse_price_repr)
from deckframe.functions.time import canonical_ts_text, parse_utc
from deckframe.functions.prices import price_bounds

__all__ = [
    "first_part", "last_part", "like_any", "strip_prefix", "unlimited_quantity",
    "BOARD_SCHEMA", "COMBO_USES_SCHEMA", "apply_transforms", "PRICE_SCHEMA", "json_field",
    "list_to_indexed_map", "jsonify_nested", "parse_board", "parse_price_repr",
    "canonical_ts_text", "parse_utc", "price_bounds",
]
