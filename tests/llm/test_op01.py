import itertools
import random
import re

import numpy as np

from deckframe.llm import op01_spaced_seeds as op

from corpus_rows import FIELDS, prose


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = tokens(text), tokens(item)
            best = len(b) if 0 < len(b) < op.LEAST_ITEM and any(a[k:k + len(b)] == b for k in range(len(a))) else None
            for shift in range(-len(b), len(a)) if len(b) >= op.LEAST_ITEM else ():
                low, high = max(0, -shift), min(len(b), len(a) - shift)
                match = [a[k + shift] == b[k] for k in range(low, high)]
                seeded = any(all(match[s + k] for k, c in enumerate(m) if c == "1")
                             for m in op.MASKS for s in range(len(match) - len(m) + 1))
                if not seeded:
                    continue
                score, at = (0, 0, 0), 0
                for s in range(len(match)):
                    total = 0
                    for e in range(s, len(match)):
                        total += 1 if match[e] else -op.MISMATCH
                        if total > score[0]:
                            score = (total, s, e + 1)
                same = sum(match[score[1]:score[2]])
                n = score[2] - score[1]
                if n >= min(op.OVERLAP, len(b)) and same >= op.IDENTITY * n:
                    best = max(best or 0, same)
            if best:
                out[d, i] = best
    return out


def test_against_brute_force(spark):
    items = [(k, prose(12 + 5 * k, 100 + k)) for k in range(6)] + [(20, "too short"), (21, None), (22, "")]
    w = [x[1].split() if x[1] else [] for x in items]
    sub = list(w[4])
    sub[6], sub[13], sub[20] = "x1", "x2", "x3"
    docs = [(1, prose(20, 1) + " " + items[0][1] + " " + prose(10, 2)), (2, prose(30, 3)), (3, items[5][1].upper().replace(" ", "*** ")),
            (4, prose(5, 4) + ", " + " ".join(sub)), (5, " ".join(w[3][2:17])), (6, " ".join(w[3][2:10]) + " " + prose(20, 5)),
            (7, " ".join(w[2]) + " " + " ".join(w[1])), (8, None), (9, ""), (10, "too short"), (11, items[0][1]), (11, items[0][1])]
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], FIELDS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_same"] for r in op.overlaps(frame, bench).collect()}
    expected = brute(docs, items)
    assert got == expected and {(1, 0), (3, 5), (4, 4), (5, 3), (10, 20)} <= set(got) and not {d for d, _ in got} & {2, 6, 8, 9}


def test_odd_and_empty(spark, odd, empty):
    bench = spark.createDataFrame([(1, prose(120, 1)), (1, prose(120, 1)), (None, None), (2, prose(120, 1))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op.overlaps(odd, bench).collect()}
    assert {d for d, _ in got} == {5, 3, 9, 4, None} and {i for _, i in got} == {1, 2}
    left = op.drop_contaminated(odd, bench)
    assert left.columns == odd.columns
    rows = [r["doc_id"] for r in left.collect()]
    assert rows.count(None) == 2 and rows.count(12) == 2 and not {5, 3, 9, 4} & set(rows)
    assert op.overlaps(empty, bench).count() == 0 and op.overlaps(odd, bench.limit(0)).count() == 0


def test_the_filter_only_saves_work(spark, monkeypatch):
    bench = spark.createDataFrame([(k, prose(40, k)) for k in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(k, prose(10, 500 + k) + " " + prose(40, k), None, None, 0) for k in range(0, 60)], FIELDS)
    full = sorted(op.overlaps(docs, bench).drop("doc_key").collect())
    monkeypatch.setattr(op, "BLOOM_BITS_MOST", 1 << 6)
    assert sorted(op.overlaps(docs, bench).drop("doc_key").collect()) == full and {r["doc_id"] for r in full} == set(range(30))


def test_every_placement_of_the_allowed_substitutions_shares_a_seed():
    for n, k in ((8, 1), (9, 1), (10, 2), (11, 2), (12, 2), (13, 2), (15, 3), (20, 4)):
        places = list(itertools.combinations(range(n), k))
        item = np.arange(1, n + 1, dtype=np.uint64)
        copies = np.tile(item, (len(places), 1))
        for row, places_ in enumerate(places):
            copies[row, list(places_)] += np.uint64(1000)
        sought = {(m, int(a), int(s)) for m, (at, seed) in enumerate(op.seeds(item, np.array([0, n]))) for a, s in zip(at, seed)}
        hit = set()
        for m, (at, seed) in enumerate(op.seeds(copies.ravel(), np.arange(len(places) + 1) * n)):
            hit |= {int(a) // n for a, s in zip(at, seed) if (m, int(a) % n, int(s)) in sought}
        assert len(hit) == len(places), (n, k)
    every_fifth = sum(1 << i for i in range(4, 25, 5))
    masks = [sum(1 << i for i, c in enumerate(m) if c == "1") << s for m in op.MASKS for s in range(26 - len(m))]
    assert any(not every_fifth & m for m in masks)
    for places in itertools.combinations(range(25), 5):
        assert not all(sum(1 << i for i in places) & m for m in masks), places


def longest_overlaps(docs, items):
    """By trying every stretch of every diagonal, without seeds."""
    out = {}
    for (d, text), (i, item) in itertools.product(docs, items):
        a, b = tokens(text), tokens(item)
        best = None
        for shift in range(-len(b), len(a)):
            low, high = max(0, -shift), min(len(b), len(a) - shift)
            sums = [0, *itertools.accumulate(a[k + shift] == b[k] for k in range(low, high))]
            for s, e in itertools.combinations(range(len(sums)), 2) if sums[-1] > 5 else ():
                n, same = e - s, sums[e] - sums[s]
                if n >= min(13, len(b)) and 5 * same >= 4 * n:
                    best = max(best or (0, 0), (n, same))
        if best:
            out[d, i] = best
    return out


def test_every_overlap_is_found_at_its_full_length(spark):
    r = random.Random(7)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate([8, 9, 10, 11, 12, 13, 14, 20, 20, 30, 30, 59, 90])]
    docs = []
    for i, text in items:
        for rate in (0, 0.1, 0.2, 0.25, 0.3):
            for _ in range(6):
                copy = [f"other{r.random()}" if r.random() < rate else w for w in text.split()]
                docs.append((len(docs), " ".join(["before"] * r.randint(0, 60) + copy[r.choice([0, 0, 1]):] + ["after"] * r.randint(0, 60))))
    w = items[9][1].split()
    docs.append((1000, " ".join([*w[:12], "x", w[13]])))  # 13 of 14, one of them past a substitution
    docs.append((1001, " ".join("x" if k % 5 == 4 else w_ for k, w_ in enumerate(w))))
    docs.append((1002, " ".join(w[:13] + [w_ if k % 4 else "x" for k, w_ in enumerate(w[13:])])))  # 13 equal ones, then 3 of 4
    docs.append((1003, " ".join(["x", *items[0][1].split()[1:]])))
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], FIELDS)
    got = {(x["doc_id"], x["item_id"]): (x["n_tokens"], x["n_same"]) for x in op.overlaps(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    expected = longest_overlaps(docs, items)
    assert got == expected and {(1000, 9), (1001, 9), (1002, 9), (1003, 0)} <= set(got)


def test_short_items_are_found_whole(spark):
    r = random.Random(11)
    items = [(n, " ".join(f"s{r.randint(0, 2)}" for _ in range(n))) for n in range(1, 8)] + [(9, "..."), (10, "S1, s2!"), (11, " ".join(f"s{k % 3}" for k in range(8)))]
    docs = [(d, " ".join(f"s{r.randint(0, 3)}" for _ in range(r.randint(0, 40)))) for d in range(120)]
    docs += [(500, "s1 " * 3000), (501, "s1-s2"), (502, "s1s2"), (None, items[6][1]), (503, None)]
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], FIELDS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): (x["doc_start"], x["item_start"], x["n_tokens"], x["n_same"]) for x in op.overlaps(frame, bench).collect() if x["item_id"] < 11}
    expected = {}
    for (d, text), (i, item) in itertools.product(docs, items[:-1]):
        a, b = tokens(text), tokens(item)
        at = next((k for k in range(len(a) - len(b) + 1) if b and a[k:k + len(b)] == b), None)
        if at is not None:
            expected[d, i] = (at, 0, len(b), len(b))
    assert got == expected and {(501, 10), (None, 7)} <= set(got) and not any(d == 502 for d, _ in got)
    clean = {r_["doc_id"] for r_ in op.drop_contaminated(frame, bench.where("item_id = 10")).collect()}
    assert clean == {d for d, _ in docs} - {d for d, i in expected if i == 10}
