import random
from collections import defaultdict
from zlib import crc32

import pytest

from deckframe.llm import op07_minimax_shards as op

from corpus_rows import FIELDS, odd_rows


def smallest(units, shards):
    def need(c):
        n, s = 1, 0
        for u in units:
            if u > c:
                return shards + 1
            n, s = (n + 1, u) if s + u > c else (n, s + u)
        return n
    return next(c for c in range(max(units), sum(units) + 1) if need(c) <= shards)


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_the_smallest(spark, monkeypatch, seed):
    r = random.Random(seed)
    monkeypatch.setattr(op, "FAN", 3)
    ids = [r.randint(-2**62, 2**62) for _ in range(60)] if seed % 2 else r.sample(range(200), 60)
    sizes = {k: r.randint(1, 40) + (300 if r.random() < 0.05 else 0) for k in ids}
    shards = r.choice([2, 4, 8])
    units = spark.createDataFrame([(k, n) for k, n in sizes.items()], "unit long, size long")
    cuts = op.minimax_cuts(units, shards)
    assert len(cuts) <= shards - 1 and cuts == sorted(cuts)
    load = defaultdict(int)
    for k, n in sizes.items():
        load[sum(k >= c for c in cuts)] += n
    assert max(load.values()) == smallest([sizes[k] for k in sorted(sizes)], shards)


def test_odd_rows(odd, empty):
    rows = op.minimax_shards(odd, 4).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, crc32((t or "").encode())) for d, t, *_ in odd_rows()), key=str)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        shards[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in shards.values())
    assert set(slots) <= set(range(4)) and op.minimax_shards(empty).count() == 0


def test_a_group_with_a_third_of_all_rows(spark):
    docs = spark.createDataFrame([(k, "same text" if k % 3 == 0 else f"text {k:04d}", None, None, 0) for k in range(600)], FIELDS)
    rows = op.minimax_shards(docs, 3).collect()
    assert len({r["shard"] for r in rows if r["doc_id"] % 3 == 0}) == 1 and len({r["shard"] for r in rows}) == 3
