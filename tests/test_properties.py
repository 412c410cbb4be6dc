"""Property tests against brute-force Python models on small random inputs."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from deckframe.operators.scd2 import current, scd2_apply
from deckframe.plans import decks
from tests.fixtures import BOARD_COLS

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

board_rows = st.lists(
    st.tuples(st.sampled_from(["d1", "d2", "d3", None]),
              st.sampled_from(["Commander", "Mainboard", "Companion"]),
              st.one_of(st.none(), st.integers(0, 3)),
              st.sampled_from(["A", "B", "C", "A-C"]),
              st.integers(1, 4)),
    min_size=0, max_size=25)


def brute_decklists(rows, size):
    newest = {}
    for d, b, t, c, q in rows:
        if d is None or t is None:
            continue
        newest[(d, b)] = max(newest.get((d, b), t), t)
    latest = [r for r in rows if r[0] is not None and r[2] is not None and newest[(r[0], r[1])] == r[2]]
    totals = defaultdict(int)
    for d, b, t, c, q in latest:
        totals[d] += q
    return sorted((d, b, t, c, q) for d, b, t, c, q in latest if totals[d] == size)


def _df(spark, rows):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(d, None if t is None else base + dt.timedelta(days=t), c, "f", q, b) for d, b, t, c, q in rows],
        BOARD_COLS)


@SETTINGS
@given(rows=board_rows, size=st.integers(2, 8))
def test_decklists_matches_brute_force(spark, rows, size):
    base = dt.datetime(2024, 1, 1)
    want = [(d, b, base + dt.timedelta(days=t), c, q) for d, b, t, c, q in brute_decklists(rows, size)]
    for method in ("aggregate", "semi", "window"):
        got = sorted((r["deck_id"], r["type"], r["lastUpdatedAtUtc"], r["card_name"], r["quantity"])
                     for r in decks.decklists(_df(spark, rows), size, method=method).collect())
        assert got == want, method
    # every returned deck totals exactly `size`
    out = decks.decklists(_df(spark, rows), size)
    assert out.groupBy("deck_id").sum("quantity").filter(f"`sum(quantity)` <> {size}").count() == 0


snapshots = st.lists(st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", None]), max_size=5),
                     min_size=1, max_size=4)


@SETTINGS
@given(snaps=snapshots)
def test_scd2_matches_brute_force(spark, snaps):
    hist = None
    model = []  # [key, value, from, to]
    for i, snap in enumerate(snaps):
        now = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
        df = spark.createDataFrame(sorted(snap.items()), "id int, v string")
        hist = scd2_apply(hist, df, "id", now)
        open_rows = {r[0]: r for r in model if r[3] is None}
        for k, r in open_rows.items():
            if k not in snap or snap[k] != r[1]:
                r[3] = now
        for k, v in snap.items():
            if k not in open_rows or open_rows[k][1] != v:
                model.append([k, v, now, None])
    got = sorted((r["id"], r["v"] or "", r["valid_from"], r["valid_to"] or dt.datetime.max)
                 for r in hist.collect())
    want = sorted((k, v or "", f, t or dt.datetime.max) for k, v, f, t in model)
    assert got == want
    assert current(hist).groupBy("id").count().filter("count > 1").count() == 0


def _strip(n):
    return n.replace("A-", "") if n is not None and n.startswith("A-") else n


def brute_average(lists, commanders, budget):
    """Python model of the average deck: deck counts keyed by the stripped
    commander name but joined on the raw name; RANGE running total."""
    counts = defaultdict(set)
    for d, c in commanders:
        if c is not None:
            counts[_strip(c)].add(d)
    stats = {}
    for d, t, card, q in lists:
        for cd, c in commanders:
            if cd != d or c is None:
                continue
            key = (_strip(c), _strip(card), t)
            qs, tot = stats.get(key, (0, None))
            n = len(counts[c]) if c in counts else None
            tot = n if tot is None else (max(tot, n) if n is not None else tot)
            stats[key] = (qs + q, tot)
    out = []
    by_cmd = defaultdict(list)
    for (cmd, card, t), (qs, tot) in stats.items():
        avg = qs / tot if tot else None
        by_cmd[cmd].append((avg, card, t, None if avg is None else -(-qs // tot), tot))
    for cmd, rows in by_cmd.items():
        def sort_key(r):
            return (r[0] is None, -(r[0] or 0), r[1])
        rows.sort(key=sort_key)
        for r in rows:
            peers = [x for x in rows if sort_key(x) <= sort_key(r)]
            vals = [x[3] for x in peers if x[3] is not None]
            running = sum(vals) if vals else None
            if running is not None and running <= budget:
                out.append((cmd, r[1], r[3], r[4]))
    return sorted(out, key=repr)


deck_rows = st.lists(
    st.tuples(st.sampled_from(["d1", "d2", "d3", "d4"]),
              st.sampled_from(["Mainboard", "Companion"]),
              st.sampled_from(["X", "A-X", "Y", "Z"]),
              st.integers(1, 3)),
    min_size=1, max_size=15)
commander_rows = st.lists(st.tuples(st.sampled_from(["d1", "d2", "d3", "d4", "d5"]),
                                    st.sampled_from(["C", "A-C", "D"])),
                          min_size=1, max_size=8, unique=True)


@SETTINGS
@given(lists=deck_rows, cmds=commander_rows, budget=st.integers(1, 8))
def test_average_decks_matches_brute_force(spark, lists, cmds, budget):
    ldf = spark.createDataFrame(lists, "deck_id string, type string, card_name string, quantity bigint")
    cdf = spark.createDataFrame(cmds, "deck_id string, card_name string")
    got = sorted(((r["commander"], r["card_name"], r["quantity"], r["total_decks"])
                  for r in decks.average_decks(ldf, cdf, budget).collect()), key=repr)
    assert got == brute_average(lists, cmds, budget)
