import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from deckframe.llm import op03_suffix_dedup as op
from deckframe.llm.suffix_sort import deep_shallow

from corpus_rows import FIELDS, odd_rows, prose


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs, length, split=op.SPLIT):
    return sorted(((r["doc_id"], r["n_bytes"], sum(x["high"] - x["low"] for x in r["removed"]), len(r["removed"]),
                    hashlib.sha256(r["kept_bytes"]).hexdigest()) for r in op.strip_repeats(docs, length, split=split).collect()), key=str)


def collection(seed):
    r = random.Random(seed)
    passages = [prose(r.randint(8, 40), 1000 + seed * 50 + k) for k in range(6)] + ["ab" * 60, "é" * 80]
    rows = []
    for d in range(40):
        parts = [r.choice(passages) if r.random() < 0.5 else prose(r.randint(1, 30), seed * 1000 + d * 10 + k) for k in range(r.randint(1, 5))]
        text = "".join(parts)
        if r.random() < 0.3:
            at = r.randrange(len(text))
            text = text[:at] + "#" + text[at + 1:]
        rows.append((d, text))
    return rows + [(40, rows[3][1]), (41, rows[3][1]), (41, rows[3][1])]


@pytest.mark.parametrize("seed,length,split", [(1, 60, op.SPLIT), (2, 100, op.SPLIT), (3, 64, 2)])
def test_against_brute_force(spark, monkeypatch, seed, length, split):
    monkeypatch.setattr(op, "SORT_BLOCKS", 25)
    rows = collection(seed)
    docs = spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], FIELDS).repartition(3)
    assert found(docs, length, split) == brute(rows, length)


def test_odd_rows(odd, empty):
    assert found(odd, 400) == brute([(d, t) for d, t, *_ in odd_rows()], 400)
    assert op.strip_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_deep_shallow_order(seed):
    r = random.Random(seed)
    alphabet = r.choice([b"ab", b"a", b"\0\1", bytes(range(256))])
    base = bytes(r.choice(alphabet) for _ in range(60))
    texts = [base[:r.randint(0, 60)] + bytes(r.choice(alphabet) for _ in range(r.randint(0, 20))) for _ in range(40)]
    groups = np.array([r.randint(0, 2) for _ in texts])
    order, shared = deep_shallow(texts, groups)
    assert [(groups[i], texts[i]) for i in order] == sorted((g, t) for g, t in zip(groups, texts))
    for k in range(1, len(order)):
        a, b = texts[order[k - 1]], texts[order[k]]
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        expected = -1 if groups[order[k]] != groups[order[k - 1]] else common
        assert shared[k] == expected or a == b and shared[k] >= common


def test_null_ids_do_not_share_spans(spark):
    """(null, "5|...") and (5, "...") are two documents with ranges of their own."""
    passage = "x y z " * 100
    rows = [(None, "5|" + passage), (5, passage)]
    assert found(spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], FIELDS), 400) == brute(rows, 400)
