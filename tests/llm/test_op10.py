import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from deckframe.llm import op10_minhash_join as op
from deckframe.llm.components import components

from corpus_rows import FIELDS, odd_rows, prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def lowest(nodes, edges):
    name = {n: n for n in nodes}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        name[b] = a
    return {n: top(n) for n in nodes}


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    held = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            held[x].append(d)
    both = Counter(p for ids in held.values() for p in combinations(ids, 2))
    edges = [p for p, n in both.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    label = lowest(sets, edges)
    return sorted((d, len(s), label[d], label[d] == d) for d, s in sets.items())


def got(docs):
    return sorted(tuple(r) for r in op.near_duplicates(docs).drop("doc_key").collect())


def edited(text, share, r):
    return " ".join(w if r.random() > share else f"w{r.randrange(10**6)}" for w in text.split())


def test_against_brute_force(spark):
    r = random.Random(7)
    rows = []
    for g in range(12):
        base = prose(r.choice([6, 30, 120, 400]), g)
        rows += [edited(base, r.choice([0, 0.01, 0.03, 0.06]), r) for _ in range(r.choice([1, 2, 5, 20]))]
    passage = prose(60, 99)
    rows += [prose(100, 200 + k) + " " + passage for k in range(40)]
    chain = prose(100, 77).split()
    rows += [" ".join(chain[8 * k:] + prose(8 * k, 300).split()) for k in range(6)]
    r.shuffle(rows)
    rows = list(enumerate(rows))
    assert got(spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], FIELDS).repartition(4)) == brute(rows)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in op.near_duplicates(odd).collect()]
    named = {d: (n, c, k) for d, n, c, k in rows if d is not None}
    expected = {d: (n, c, k) for d, n, c, k in brute([(d, t) for d, t, *_ in odd_rows() if d is not None])}
    assert named == expected and len(rows) == len(odd_rows())
    assert sorted(((n, c, k) for d, n, c, k in rows if d is None), key=str) == sorted([(116, 3, False), (46, 17, False), (0, None, True)], key=str)
    kept = op.keep_representatives(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and ids.count(11) == 1 and 12 not in ids and {3, 7, 8, 10, 13, 17} <= set(ids) and not {4, 5, 9} & set(ids)
    assert got(empty) == []


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 4000).astype(np.uint64)
    rates = []
    for k in range(60):
        one, two = np.unique(pool[:1000 + k]), np.unique(pool[140:1140])
        a, b = (np.frombuffer(op.signature(x), "<u4") for x in (one, two))
        rates.append((a == b).mean() - len(np.intersect1d(one, two)) / len(np.union1d(one, two)))
        pool = r.permutation(pool)
    assert abs(np.mean(rates)) < 0.03


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(50)] if seed else [(k, k + 1) for k in range(40)]
    found = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == lowest(nodes, [e for e in edges if e[0] != e[1]])


@pytest.mark.parametrize("order", [1, -1])
def test_equals_have_one_hub(spark, order):
    """Else what is known of a group's nodes and one hub is asked of another, and all pairs are formed."""
    rows = [(v, n, 9) for v in (1, 2) for n in (4, 5, 6)][::order]
    posted = spark.createDataFrame(rows, "value long, node long, weight long").coalesce(1)
    assert sorted(map(tuple, op._hubs(posted).collect())) == [(1, 6), (2, 6)]
