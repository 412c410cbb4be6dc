"""Hand-worked micro fixtures (FIXTURES.md M1-M9)."""

import datetime as dt

BOARD_COLS = "deck_id string, lastUpdatedAtUtc timestamp, card_name string, format string, quantity int, type string"


def ts(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


# M1: (deck, board, ts, card, qty)
M1 = [
    ("d1", "Commander", 2, "C1", 1),
    ("d1", "Mainboard", 2, "Island", 2),
    ("d1", "Mainboard", 2, "Bolt", 1),
    ("d1", "Mainboard", 1, "Old", 1),
    ("d2", "Commander", 1, "A-C1", 1),
    ("d2", "Mainboard", 1, "Bolt", 1),
    ("d2", "Companion", 1, "K", 1),
    ("d3", "Commander", 5, "C1", 1),
    ("d3", "Mainboard", 5, "Island", 2),
    ("d3", "Companion", 3, "K", 1),
]


def m1_boards(spark):
    rows = [(d, ts(t), c, "cedh", q, b) for d, b, t, c, q in M1]
    return spark.createDataFrame(rows, BOARD_COLS)


def collection(spark, items):
    return spark.createDataFrame(list(items), "name string, quantity bigint")
