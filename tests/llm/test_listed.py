import re

import pytest
from pyspark.sql import functions as F

from deckframe.llm import listed
from deckframe.llm.op01_spaced_seeds import drop_contaminated
from deckframe.llm.op02_cuckoo_dedup import keep_documents
from deckframe.llm.op10_minhash_join import keep_representatives

from corpus_rows import prose

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def shuffled(df):
    """For each scan of texts in the plan: whether its rows go through a shuffle."""
    out, above = [], []
    for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() + df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = re.search(r"[A-Za-z]", line).start()
        above = [x for x in above if x[0] < depth]
        if "FileScan" in line and re.search(r"\btext#", line):
            out.append(any(re.search(r"(?<!Broadcast)Exchange (hash|range|Round|Single)", x) for _, x in above))
        above.append((depth, line))
    return out


@pytest.mark.parametrize("stage", ["exact", "near", "leaks"])
def test_texts_on_no_list_stay_where_they_are(spark, scratch, stage):
    rows = [(k, prose(40, k % 180)) for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")  # as with lists too long to broadcast
    try:
        if stage == "leaks":
            out, kept = drop_contaminated(docs, spark.createDataFrame([(1, prose(40, 7))], "item_id long, text string")), {*range(200)} - {7, 187}
        else:
            out, kept = (keep_documents if stage == "exact" else keep_representatives)(docs), {*range(180)}
        assert not all(shuffled(out))
        assert sorted(r["doc_id"] for r in out.collect()) == sorted(kept)
    finally:
        spark.conf.set(THRESHOLD, before)


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_parted(spark, scratch, monkeypatch, bits):
    """A full sieve lets more through, never less."""
    monkeypatch.setattr(listed, "BITS_MOST", bits)
    table = spark.createDataFrame([(k if k else None, "x", k) for k in range(300)], "id long, __id string, n long")
    ids = spark.createDataFrame([(k if k else None,) for k in (0, 5, 5, 77, 1000)], "i long")
    asked, rest = listed.parted(table, F.col("id"), ids)
    assert asked.columns == rest.columns == table.columns
    through = {r["n"] for r in asked.collect()}
    assert {0, 5, 77} <= through and through | {r["n"] for r in rest.collect()} == {*range(300)}
    assert asked.count() + rest.count() == 300 and len(through) < 100
