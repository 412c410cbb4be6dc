import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from deckframe.llm import op02_cuckoo_dedup as op
from deckframe.llm.staging import staged

from corpus_rows import FIELDS, odd_rows


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def test_filter_with_deletions_and_growth():
    r = random.Random(5)
    index, live = op.CuckooIndex(4), defaultdict(int)
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for _ in range(20000):
        k = r.choice(keys)
        if r.random() < 0.6:
            index.insert(k, 1, 1)
            live[k] += 1
        else:
            assert index.delete(k, 1) == (live[k] == 1)
            live[k] = max(0, live[k] - 1)
    assert index.resized and dict((d, e[1]) for d, e in index.entries()) == {k: n for k, n in live.items() if n}
    again = op.CuckooIndex.load(index.frame(0))
    for k in keys:
        assert (again.find(k) is not None) == (live[k] > 0)


def test_equal_fingerprints_are_told_apart():
    index = op.CuckooIndex(4)
    one, two = b"\1" * 32, b"\1" * 10 + b"\2" * 22
    index.insert(one, 1, 1)
    assert index.find(two) is None
    index.insert(two, 2, 1)
    index.delete(one, 1)
    assert index.find(two) == [2, 1] and index.find(one) is None


def test_odd_rows(odd, empty):
    groups = defaultdict(list)
    for d, t, *_ in odd_rows():
        groups[digest(t)].append(d)
    expected = []
    for sha, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        expected += [(d, keep, len(ids), d == keep, sha) for d in ids]
    got = [tuple(r) for r in op.dedup_report(odd).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    kept = op.keep_documents(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(digest(r["text"]) for r in rows) == sorted(groups)
    assert op.dedup_report(empty).count() == 0 and op.keep_documents(empty).count() == 0


def test_index_follows_insertions_and_deletions(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARD_KEYS", 40)
    rows = [(k, f"text {k % 150}", None, None, 0) for k in range(400)]
    keys = staged(op.digests(spark.createDataFrame(rows, FIELDS)), "test")
    index = staged(op.build_index(keys), "test")
    assert index.agg({"shard": "max"}).first()[0] > 1
    gone, new = keys.where("doc_id % 150 < 20 OR doc_id < 90"), staged(op.digests(spark.createDataFrame([(900, "text 5", None, None, 0), (901, "new", None, None, 0)], FIELDS)), "test")
    live = staged(keys.where("NOT (doc_id % 150 < 20 OR doc_id < 90)").union(new), "test")
    after = op.update_index(index, new, gone, live).where("digest IS NOT NULL")
    expected = {bytes(r["digest"]): (r["f"], r["n"]) for r in live.groupBy("digest").agg(F.min("doc_id").alias("f"), F.count(F.lit(1)).alias("n")).collect()}
    assert {bytes(r["digest"]): (r["first_id"], r["copies"]) for r in after.collect()} == expected
