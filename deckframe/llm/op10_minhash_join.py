"""MinHash near-dedup by an inverted join of signature coordinates.

A document is the set of its distinct ``SHINGLE``-word shingles.  Documents
with the same set are one node, named by their smallest id, so exact copies
cost nothing from here on.

1. Signature: for each of ``COORDINATES`` hash functions the smallest value.
2. Postings: a node stands under every (coordinate, value) pair.  A value that
   only one node has can't collide and is left out.
3. Skip: a pair is of interest if ``MATCHES`` coordinates collide at least, so
   nodes with fewer shared values drop out.
4. Prefix: of the r shared values of a node only the r - MATCHES + 1 rarest
   are posted; two nodes with MATCHES collisions still meet under one of them.
   Values of a passage that very many documents hold are the last in that order.
5. Collisions of the pairs that met are counted on whole signatures; pairs at
   or above MATCHES are confirmed on whole shingle sets.

With 64 coordinates, 30 matches and a similarity of 0.75 a pair of that very
similarity is missed with a chance of about 2e-7.

Not all pairs of a posting list are formed.  First all its nodes meet the hub,
the node whose values are the most common; links give components.  Then only nodes of different components under the same value
may meet, which is all that can still change a component.  Of these, a pair
goes on only if the similarity is within reach of what each node shares with the
hub and what it shares beside that with any other such node: a node with too
many words of its own meets nobody.  So no link between different components is
lost.

Null texts count as empty and are linked with nothing, as are empty ones.
Rows with null ids take the component of rows with the same set, else null.  Rows that
share an id are one node, that of the text with the smallest MD5.  Empty tables
give empty results; extra columns are ignored.  A task holds one text and its set.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .hashing import mix, powers, runs, shingles, utf8, words
from .listed import parted, without
from .staging import staged

SHINGLE = 5
COORDINATES = 64
MATCHES = 30
SIMILAR_PERCENT = 75
PARTS = 32
_SEEDS = mix(powers(0xA24BAED4963EE407, 2 * COORDINATES + 1)[1:] + np.uint64(1))
_FLIP, _TURN = _SEEDS[:COORDINATES], _SEEDS[COORDINATES:] | np.uint64(1)


def signature(members: np.ndarray) -> bytes:
    """The smallest value of each hash function, as 32-bit integers."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(members), 2048):
        least = np.minimum(least, ((members[i:i + 2048, None] ^ _FLIP) * _TURN).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    data, offsets = utf8(batch.column("text"))
    for a, b in runs(offsets):
        yield from shingles(words(data, offsets[a:b + 1]), SHINGLE)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, signs = [], [], []
        for members in _sets(batch):
            sizes.append(len(members))
            keys.append(blake2b(members.tobytes(), digest_size=16).digest())
            signs.append(signature(members) if len(members) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
            ["doc_id", "doc_key", "n_shingles", "set_key", "signature"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("doc_key"), text.alias("text"))


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_key, n_shingles, set_key, signature) of every row; doc_key
    is the MD5 of the text."""
    return _texts(docs, id_col, text_col).mapInArrow(
        _sign, "doc_id long, doc_key binary, n_shingles long, set_key binary, signature binary")


def _member_sets(texts: DataFrame) -> DataFrame:
    """(node, size, members) of each row: whole sets as sorted 64-bit integers."""
    def whole(batches):
        for batch in batches:
            sets = list(_sets(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                ["node", "size", "members"])

    return texts.select("doc_id", "text").mapInArrow(whole, "node long, size long, members binary")


def postings(nodes: DataFrame) -> DataFrame:
    """(value, node, weight): the rarest shared coordinate-value pairs of each
    node, and how common all its values are together."""
    def spread(batches):
        place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
        for batch in batches:
            signs = b"".join(batch.column("signature").to_pylist())
            values = np.frombuffer(signs, "<u4").reshape(-1, COORDINATES).astype(np.uint64)
            values = mix(values + place + np.uint64(1)).view(np.int64).ravel()
            ids = np.repeat(np.asarray(batch.column("node")), COORDINATES)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(ids)], ["value", "node"])

    posted = nodes.mapInArrow(spread, "value long, node long")
    shared = posted.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = posted.join(shared, "value")
    own = Window.partitionBy("node")
    rank = F.row_number().over(own.orderBy("n", "value"))
    return (met.withColumn("rank", rank).withColumn("r", F.count(F.lit(1)).over(own))
            .withColumn("weight", F.sum("n").over(own))
            .where(F.col("rank") <= F.col("r") - MATCHES + 1).select("value", "node", "weight"))


def _collisions(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of which MATCHES coordinates collide at least."""
    def count(batches):
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, COORDINATES)
                        for c in ("sign_a", "sign_b"))
            keep = pa.array((one == two).sum(axis=1) >= MATCHES)
            yield batch.select(["a", "b"]).filter(keep)

    side = lambda x: nodes.select(F.col("node").alias(x), F.col("signature").alias(f"sign_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sign_a", "sign_b").mapInArrow(count, "a long, b long")


def _compared(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b, both, linked, miss_a, miss_b): shingles that whole sets have in
    common, whether that is similar enough, and how many of the other's
    shingles each lacks, by ``PARTS`` parts of the hash range."""
    def compare(batches):
        for batch in batches:
            common, linked, lacks = [], [], ([], [])
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                one, two = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                held = np.isin(one, two, assume_unique=True)
                both = int(held.sum())
                common.append(both)
                linked.append(100 * both >= SIMILAR_PERCENT * (len(one) + len(two) - both))
                for out, rest in zip(lacks, (two[np.isin(two, one, assume_unique=True, invert=True)], one[~held])):
                    out.append(np.bincount((rest % np.uint64(PARTS)).astype(np.int64), minlength=PARTS))
            counts = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(linked, pa.bool_()), *(pa.array(x, counts) for x in lacks)],
                ["a", "b", "both", "linked", "miss_a", "miss_b"])

    side = lambda x: members.select(F.col("node").alias(x), F.col("members").alias(f"set_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(
        compare, "a long, b long, both long, linked boolean, miss_a array<int>, miss_b array<int>")


def _hubs(posted: DataFrame) -> DataFrame:
    """(value, hub): the node whose values are the most common, of equals the
    largest: what is known of nodes and their hub must hold wherever they meet."""
    return posted.groupBy("value").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))


def _stars(posted: DataFrame, hubs: DataFrame) -> DataFrame:
    """Under each value every node with the hub."""
    met = posted.join(hubs, "value")
    return met.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).where("a < b").distinct()


def _support(members: DataFrame) -> DataFrame:
    """(node, size, support): how many of a node's shingles any other node has."""
    def spread(batches):
        for batch in batches:
            sets = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column("members")]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            ids = np.repeat(np.asarray(batch.column("node")), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], ["shingle", "node"])

    spreaded = members.select("node", "members").mapInArrow(spread, "shingle long, node long")
    shared = spreaded.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    support = spreaded.join(shared, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("support"))
    return members.select("node", "size").join(support, "node")


def _across(posted: DataFrame, hubs: DataFrame, label: DataFrame, members: DataFrame, compared: DataFrame) -> DataFrame:
    """Under each value the pairs of nodes from different components that may
    be similar; nodes of the value's most common component don't meet each
    other.

    Two nodes have at most least(support, support) shingles in common.  Where
    both were compared with the value's hub, those outside the hub are at most
    the smaller number that either shares with any other node, and those inside
    are what neither lacks: of the hub's shingles at least as many are lacking
    as both lack, less what they may lack together in each part of the hashes.
    """
    named = staged(posted.join(label, "node", "left").select("value", "node", F.coalesce("component", "node").alias("component")), "named")
    parts = named.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (parts.groupBy("value").agg(F.max_by("component", "n").alias("main"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("value", "main"))
    rows = staged(named.join(mixed, "value").join(hubs, "value"), "mixed")
    support = _support(members.join(rows.select("node").distinct(), "node", "left_semi"))
    able = staged(support.where(100 * F.col("support") >= SIMILAR_PERCENT * F.col("size")), "support")
    hub_size = members.select(F.col("node").alias("hub"), F.col("size").alias("hub_size"))
    own = F.col("node") == F.col("hub")
    rows = (rows.join(able, "node").join(hub_size, "hub")
            .withColumn("a", F.least("node", "hub")).withColumn("b", F.greatest("node", "hub"))
            .join(compared.drop("linked"), ["a", "b"], "left")
            .withColumn("in_hub", F.when(own, F.col("size")).otherwise(F.col("both")))
            .withColumn("miss", F.when(own, F.array_repeat(F.lit(0), PARTS)).when(F.col("hub") == F.col("a"), F.col("miss_b")).otherwise(F.col("miss_a"))))
    # at most COORDINATES values of a node, so that a pair goes on under the first it shares only
    held = rows.groupBy("node").agg(F.collect_list("value").alias("held"))
    fields = ("node", "component", "size", "support", "in_hub", "miss", "held")
    rows = staged(rows.join(held, "node").select("value", "main", "hub_size", *fields), "able")
    outside = rows.where("component <> main").select("value", "hub_size", *(F.col(c).alias(f"x_{c}") for c in fields))
    other = rows.select("value", (F.col("component") == F.col("main")).alias("in_main"), *(F.col(c).alias(f"y_{c}") for c in fields))
    beside = "least(x_support - x_in_hub, y_support - y_in_hub)"
    together = "aggregate(zip_with(x_miss, y_miss, (p, q) -> least(p, q)), 0, (n, p) -> n + p)"
    reach = lambda most: f"100 * ({most}) >= {SIMILAR_PERCENT} * (x_size + y_size - ({most}))"
    unknown = "x_in_hub IS NULL OR y_in_hub IS NULL"
    met = outside.join(other, "value").where(
        "x_component <> y_component AND (in_main OR x_node < y_node)"
        f" AND {reach('least(x_support, y_support)')}"
        f" AND ({unknown} OR {reach(f'least(x_in_hub, y_in_hub) + {beside}')})"
        " AND value = array_min(array_intersect(x_held, y_held))"
        f" AND ({unknown} OR {reach(f'x_in_hub + y_in_hub - hub_size + {together} + {beside}')})")
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sign: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (a, b) between nodes, enough of them to connect every
    component, and the nodes' (node, component)."""
    sign = staged(signed(docs, id_col, text_col), "signed") if sign is None else sign
    filled = sign.where("n_shingles > 0 AND doc_id IS NOT NULL")
    named = filled.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    nodes = filled.join(named, "set_key").where("doc_id = node").groupBy("node").agg(F.min(F.struct("doc_key", "signature")).alias("first"))
    nodes = staged(nodes.select("node", "first.doc_key", "first.signature"), "nodes")
    posted = staged(postings(nodes).distinct(), "postings")
    hubs = staged(_hubs(posted), "hubs")
    nodes = staged(nodes.join(posted.select("node").distinct(), "node", "left_semi"), "asked")
    asked = nodes.select(F.col("node").alias("doc_id"), "doc_key")
    # repeated rows go while the texts are dealt for the join, so the larger sets need no shuffle of their own
    listed, _ = parted(docs, F.col(id_col).cast("long"), asked.select("doc_id"))
    once = _texts(listed, id_col, text_col).join(asked, ["doc_id", "doc_key"], "left_semi").dropDuplicates(["doc_id", "doc_key"])
    members = staged(_member_sets(once), "members")
    near = staged(_compared(_collisions(_stars(posted, hubs), nodes), members), "near")
    found = near.where("linked").select("a", "b")
    label = components(found)
    rest = _across(posted, hubs, label, members, near).join(near, ["a", "b"], "left_anti")
    late = staged(_compared(_collisions(rest, nodes), members).where("linked").select("a", "b"), "late")
    if not late.isEmpty():
        found = found.union(late)
        label = components(found)
    return found, label


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the smallest id that links lead to."""
    sign = staged(signed(docs, id_col, text_col), "signed")
    _, label = links(docs, id_col, text_col, sign)
    named = (sign.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key")
             .agg(F.min("doc_id").alias("node")))
    own = sign.select("doc_id", "doc_key", "n_shingles", "set_key").join(named, "set_key", "left").join(label, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node", "doc_id")).otherwise(F.col("doc_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "doc_key")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but the smallest id of each group, all columns
    unchanged.  Rows without an id of their own stay only if their group has none."""
    report = near_duplicates(docs, id_col, text_col)
    bad = staged(report.where("NOT kept").select(
        F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")).distinct(), "near-copies")
    return without(docs, bad, id_col, text_col)


def op10_minhash_join(spark, sf_dir: str) -> DataFrame:
    """Groups of near duplicates over the whole ``documents`` table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("doc_key")
