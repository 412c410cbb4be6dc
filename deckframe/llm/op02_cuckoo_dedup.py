"""Exact dedup on a cuckoo-filter index of live digests.

The index is a table of shards.  A shard holds a cuckoo filter (buckets of four
16-bit fingerprints) and beside it the stored keys, bucketed by the filter's
first hash: the whole digest, the number of live rows, and the smallest id.

* Insertion asks the filter first.  A miss stores the digest at once; a hit is
  verified against the digests of its bucket, so a shared fingerprint never
  merges different texts.
* Deletion lowers the live count, and at zero removes one fingerprint and the
  stored key.
* When a chain of evictions finds no room, the filter doubles its buckets and
  is filled again from the stored keys.

Shards are dealt by a hash of the digest and sized by a row count, so a task
holds one shard of about ``SHARD_KEYS`` digests at a time.  Before that, rows
of one digest are folded per salt of ``doc_id``: a text that a third of all
rows share reaches its shard as a few rows.  Only digests are shuffled, never
texts.

Null text counts as empty.  Whitespace runs count as one space; nothing is
trimmed.  Null ids rank last and keep null as ``keep_id`` only if every copy has
none.  Rows that repeat the kept id are all marked kept; ``keep_documents``
leaves one of them.  Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .listed import parted
from .staging import staged

SLOTS = 4
MAX_KICKS = 200
SHARD_KEYS = 100_000
SALTS = 16
WHITESPACE = "[\\x20\\x09-\\x0D]+"
INDEX_SCHEMA = "shard int, n_buckets int, filter binary, digest binary, first_id long, copies long"


class CuckooIndex:
    """One shard: the filter and, bucketed beside it, the stored keys."""

    def __init__(self, n_buckets: int = 256):
        self.n_buckets = n_buckets
        self.slots = [0] * (n_buckets * SLOTS)
        self.store: dict[int, dict[bytes, list]] = {}
        self.resized = 0

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        one = int.from_bytes(digest[:8], "little") & (self.n_buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.n_buckets - 1)

    def _holds(self, bucket: int, mark: int) -> bool:
        return mark in self.slots[bucket * SLOTS:bucket * SLOTS + SLOTS]

    def find(self, digest: bytes) -> list | None:
        """[smallest id, live rows] of a stored digest."""
        mark, one, two = self._place(digest)
        if not (self._holds(one, mark) or self._holds(two, mark)):
            return None
        return self.store.get(one, {}).get(digest)

    def insert(self, digest: bytes, first_id, copies: int) -> None:
        entry = self.find(digest)
        if entry is not None:
            entry[1] += copies
            if first_id is not None and (entry[0] is None or first_id < entry[0]):
                entry[0] = first_id
            return
        mark, one, _ = self._place(digest)
        self.store.setdefault(one, {})[digest] = [first_id, copies]
        if not self._add(mark, one):
            self._grow()

    def delete(self, digest: bytes, copies: int) -> bool:
        """Take ``copies`` rows away; True if the digest is no longer live."""
        entry = self.find(digest)
        if entry is None:
            return False
        entry[1] -= copies
        if entry[1] > 0:
            return False
        mark, one, two = self._place(digest)
        del self.store[one][digest]
        for bucket in (one, two):
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[i] == mark:
                    self.slots[i] = 0
                    return True
        return True

    def _add(self, mark: int, bucket: int) -> bool:
        for b in (bucket, self._other(bucket, mark)):
            for i in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.slots[i]:
                    self.slots[i] = mark
                    return True
        for kick in range(MAX_KICKS):
            i = bucket * SLOTS + kick % SLOTS
            mark, self.slots[i] = self.slots[i], mark
            bucket = self._other(bucket, mark)
            for j in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.slots[j]:
                    self.slots[j] = mark
                    return True
        return False

    def _grow(self) -> None:
        entries = list(self.entries())
        while True:
            self.resized += 1
            self.n_buckets *= 2
            self.slots = [0] * (self.n_buckets * SLOTS)
            self.store = {}
            for digest, entry in entries:
                self.store.setdefault(self._place(digest)[1], {})[digest] = entry
            if all(self._add(*self._place(d)[:2]) for d, _ in entries):
                return

    def entries(self) -> Iterator[tuple[bytes, list]]:
        for bucket in self.store.values():
            yield from bucket.items()

    def frame(self, shard: int) -> pd.DataFrame:
        """The shard as rows: one with the filter, one for each stored key."""
        blob = b"".join(s.to_bytes(2, "little") for s in self.slots)
        rows = [(shard, self.n_buckets, blob, None, None, None)]
        rows += [(shard, self.n_buckets, None, d, e[0], e[1]) for d, e in self.entries()]
        out = pd.DataFrame(rows, columns=["shard", "n_buckets", "filter", "digest", "first_id", "copies"])
        return out.astype({"first_id": "Int64", "copies": "Int64"})

    @classmethod
    def load(cls, rows: pd.DataFrame) -> CuckooIndex:
        head = rows[rows["filter"].notna()].iloc[0]
        out = cls(int(head["n_buckets"]))
        blob = bytes(head["filter"])
        out.slots = [int.from_bytes(blob[i:i + 2], "little") for i in range(0, len(blob), 2)]
        for d, first, n in rows.loc[rows["digest"].notna(), ["digest", "first_id", "copies"]].itertuples(index=False):
            d = bytes(d)
            out.store.setdefault(out._place(d)[1], {})[d] = [None if pd.isna(first) else int(first), int(n)]
        return out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of the whitespace-normalised text of every row."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITESPACE, " ")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def _fold(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, digest, first_id, copies): a few rows for each digest."""
    return (keys.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
            .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
            .withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")).drop("salt"))


def build_index(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """The index of ``keys`` (doc_id, digest); pass a staged table."""
    shards = max(1, -(-(keys.count() if rows is None else rows) // SHARD_KEYS))

    def insert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, shard = None, None
        for rows in batches:
            for d, first, n, s in rows[["digest", "first_id", "copies", "shard"]].itertuples(index=False):
                if s != shard:
                    if index is not None:
                        yield index.frame(shard)
                    index, shard = CuckooIndex(), s
                index.insert(bytes(d), None if pd.isna(first) else int(first), int(n))
        if index is not None:
            yield index.frame(shard)

    return (_fold(keys, shards).repartition("shard").sortWithinPartitions("shard", "first_id")
            .mapInPandas(insert, INDEX_SCHEMA))


def update_index(index: DataFrame, added: DataFrame | None, removed: DataFrame | None, live: DataFrame) -> DataFrame:
    """Insert and delete rows (doc_id, digest) of a staged index.

    ``live`` has all rows that remain; it gives deleted digests their new
    smallest id.  Deleting what isn't stored does nothing.
    """
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    none = live.limit(0).select("doc_id", "digest")
    events = (_fold(none if added is None else added, shards).withColumn("sign", F.lit(1))
              .unionByName(_fold(none if removed is None else removed, shards).withColumn("sign", F.lit(-1))))

    def apply(stored: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        shard = int((stored if len(stored) else changes)["shard"].iloc[0])
        state = CuckooIndex.load(stored) if len(stored) else CuckooIndex()
        for d, first, n, sign in changes.sort_values("sign", ascending=False)[["digest", "first_id", "copies", "sign"]].itertuples(index=False):
            if sign > 0:
                state.insert(bytes(d), None if pd.isna(first) else int(first), int(n))
            else:
                state.delete(bytes(d), int(n))
        return state.frame(shard)

    after = index.groupBy("shard").cogroup(events.groupBy("shard")).applyInPandas(apply, INDEX_SCHEMA)
    if removed is None:
        return after
    firsts = (live.join(removed.select("digest").distinct(), "digest", "left_semi")
              .groupBy("digest").agg(F.min("doc_id").alias("__first"), F.lit(True).alias("__seen")))
    return (after.join(firsts, "digest", "left")
            .withColumn("first_id", F.when(F.col("__seen"), F.col("__first")).otherwise(F.col("first_id")))
            .select("shard", "n_buckets", "filter", "digest", "first_id", "copies"))


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the row that stays for its text."""
    keys = staged(digests(docs, id_col, text_col), "digests")
    stored = build_index(keys).where("digest IS NOT NULL").select("digest", "first_id", "copies")
    return keys.join(stored, "digest").select(
        "doc_id", F.col("first_id").alias("keep_id"), F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("first_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without later copies, all columns unchanged.  Only texts whose id
    is listed, as one that goes or as repeated with its text, are digested again
    and meet the lists; only rows that repeat id and text are grouped."""
    report = staged(dedup_report(docs, id_col, text_col), "copies")
    named = report.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "kept")
    gone = staged(named.where("NOT kept").drop("kept").distinct(), "gone")
    repeated = staged(named.where("kept").groupBy("__id", "__sha").agg(F.count(F.lit(1)).alias("__n"))
                      .where("__n > 1").drop("__n"), "repeated")
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITESPACE, " ")
    own = F.col(id_col).cast("long")
    asked, rest = parted(docs, own, gone.select("__id").unionByName(repeated.select("__id")))
    same = own.eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha"))
    left = asked.withColumn("__own", F.sha2(text.cast("binary"), 256)).join(gone, same, "left_anti")
    if not repeated.isEmpty():
        once = left.join(repeated, same, "left_semi").dropDuplicates([id_col, "__own"])
        left = left.join(repeated, same, "left_anti").unionByName(once)
    return rest.unionByName(left.drop("__own"))


def op2_cuckoo_dedup(spark, sf_dir: str) -> DataFrame:
    """Copies over the whole ``documents`` table."""
    return dedup_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = """
WITH keyed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM keyed
JOIN (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM keyed GROUP BY text_sha256) USING (text_sha256)
"""
