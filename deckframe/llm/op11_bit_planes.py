"""Centroid clustering on bit planes.

A vector of 64 integers is kept as one 64-bit word for each binary digit: bit i
of word p is digit p of component i, and the last word holds the signs (two's
complement).  The product of two vectors is then

    sum over p, q of  weight(p) * weight(q) * popcount(x_p AND c_q)

with weight(p) = 2**p, negative for the sign's word, and distances follow from
products.  All numbers are exact: 64-bit integers as long as they hold every
sum, Python's integers for wider vectors.

The planes are written once to the shared folder.  A round is one pass over
them: each task adds up its vectors for each cluster and place, so ``k * 64``
sums of a task meet in the shuffle however many vectors share a cluster, and
``k`` centroids come to the driver.  Nothing else does.

Vectors that are null, hold nulls, NaN, infinities or integers of 63 bits and
more, or haven't 64 components take no part and aren't returned.  Null ids take
part; they are hashed as an empty id.  Rows with equal ids or vectors are
different vectors; among equal hashes the smaller vector comes first.  Of equal
distances the smaller cluster number wins.  With fewer than ``k`` vectors there
are as many centroids as vectors; an empty table gives no rows.  A distance or
sum that no long can hold is null.  Extra columns are ignored.  Vectors have one
length, so there are no long ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .vectors import whole_numbers

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3:"
RUN = 4096  # vectors that are worked on at once
LONGEST = 2 ** 63 - 1


def planes_of(values: np.ndarray) -> np.ndarray:
    """(n, p) words of (n, 64) integers; p is the least number of digits with a sign."""
    digits = int((values ^ (values >> 63)).max(initial=0)).bit_length() + 1
    out = np.empty((len(values), digits), np.uint64)
    for p in range(digits):
        bits = np.packbits(((values >> p) & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, p] = bits.view("<u8")[:, 0]
    return out


def _weights(n: int) -> list[int]:
    return [1 << p for p in range(n - 1)] + [-(1 << (n - 1))]


def _kind(digits: int):
    """The type that holds sums of 64 products of so many digits together, and four of them."""
    return np.int64 if digits + 8 <= 62 else object


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) products of n vectors and k others, by weighted popcounts of ANDs."""
    kind = _kind(x.shape[1] + c.shape[1])
    out = np.zeros((len(x), len(c)), kind)
    for p, wp in enumerate(_weights(x.shape[1])):
        for q, wq in enumerate(_weights(c.shape[1])):
            out += np.bitwise_count(x[:, p, None] & c[None, :, q]).astype(kind) * (wp * wq)
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """The product of each vector with itself."""
    kind = _kind(2 * x.shape[1])
    out, weights = np.zeros(len(x), kind), _weights(x.shape[1])
    for p, wp in enumerate(weights):
        for q in range(p, len(weights)):
            out += np.bitwise_count(x[:, p] & x[:, q]).astype(kind) * (wp * weights[q] * (1 if p == q else 2))
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; ties go to the smaller number."""
    kind = _kind(x.shape[1] + centroids.shape[1] + 2)
    far = (squares(x).astype(kind)[:, None] - 2 * products(x, centroids).astype(kind)) + squares(centroids).astype(kind)[None, :]
    cluster = far.argmin(axis=1)
    return cluster, far[np.arange(len(x)), cluster]


def plane_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> list[list[int]]:
    """Per cluster the sums of its vectors' 64 components."""
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
    out = np.zeros((k, WIDTH), object)
    for p, w in enumerate(_weights(x.shape[1])):
        bits = np.unpackbits(np.ascontiguousarray(x[:, p]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += (member @ bits).astype(np.int64).astype(object) * w
    return out.tolist()


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, planes) in runs; signs are carried on where a batch has rows of different widths."""
    for batch in batches:
        for at in range(0, batch.num_rows, RUN):
            some = batch.slice(at, RUN)
            column = some.column("planes")
            lengths = column.value_lengths().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            flat = column.flatten().to_numpy().view(np.uint64)
            place = np.minimum(np.arange(lengths.max()), lengths[:, None] - 1)
            yield some.column("vec_id"), flat[starts[:, None] + place]


def packed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, planes) of the vectors that take part, in the shared folder."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, RUN):
                some = batch.slice(at, RUN)
                rows, values = whole_numbers(some.column("vector"), scale, WIDTH)
                if len(rows):
                    words = planes_of(values)
                    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * words.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [some.column("vec_id").take(pa.array(rows)),
                         pa.ListArray.from_arrays(offsets, pa.array(words.reshape(-1).view(np.int64)))], ["vec_id", "planes"])

    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    return staged(given.mapInArrow(pack, "vec_id long, planes array<long>"), "planes")


def first_centroids(table: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes of seed and id, in that order."""
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = table.select(hashed.alias("hash"), "planes").orderBy("hash", "planes").limit(k).collect()
    return [components(r["planes"]) for r in rows]


def components(planes: list[int]) -> list[int]:
    """The 64 integers of one vector's words."""
    return [sum(w * ((word >> i) & 1) for w, word in zip(_weights(len(planes)), planes)) for i in range(WIDTH)]


def refined(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; empty clusters keep theirs."""
    k, fixed = len(centroids), planes_of(np.array(centroids, np.int64))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), object)
        for _, x in _batches(batches):
            cluster, _ = nearest(x, fixed)
            counts += np.bincount(cluster, minlength=k)
            sums += np.array(plane_sums(x, cluster, k), object)
        some = [c for c in range(k) if counts[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, WIDTH), pa.int32()), pa.array(list(range(WIDTH)) * len(some), pa.int32()),
             pa.array(np.repeat(counts[some], WIDTH), pa.int64()),
             pa.array([Decimal(s) for c in some for s in sums[c]], pa.decimal128(38, 0))], ["cluster", "place", "n", "total"])

    sums = (table.mapInArrow(add, "cluster int, place int, n long, total decimal(38,0)")
            .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out = [list(c) for c in centroids]
    for r in sums:
        out[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def assigned(table: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    fixed = planes_of(np.array(centroids, np.int64).reshape(-1, WIDTH))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _batches(batches):
            cluster, far = nearest(x, fixed)
            far = far if far.dtype == np.int64 else [d if d <= LONGEST else None for d in far.tolist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(far, pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    return table.mapInArrow(assign, "vec_id long, cluster int, distance long")


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of the vectors, and the centroids."""
    table = packed(vectors, id_col, vector_col, scale)
    centroids = first_centroids(table, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = refined(table, centroids)
    return assigned(table, centroids), centroids


def op11_bit_planes(spark, sf_dir: str) -> DataFrame:
    """Clusters of all ``embeddings`` with their inertia."""
    found, centroids = clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = staged(found, "clusters")
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = [(r["cluster"], r["n"] == r["known"], r["total"]) for r in found.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count("distance").alias("known"), whole.alias("total")).collect()]
    total = sum(int(t) for _, _, t in own if t is not None) if all(known for _, known, _ in own) else None

    def fitting(x):
        return None if x is None or x > LONGEST else int(x)

    listed = [(c, fitting(t) if known else None, fitting(total), sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
              for c, known, t in own]
    summary = spark.createDataFrame(listed, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(summary), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds as a chain of tables."""
    steps = ["""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v
  FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 8))"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v, first(cluster ORDER BY d, cluster) AS cluster, min(d) AS distance
  FROM (SELECT k.vec_id, k.v, c.cluster,
               list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS d
        FROM kept k CROSS JOIN c{i} c)
  GROUP BY vec_id, v)""")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v
  FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
    FROM (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{i})
          GROUP BY cluster, i)
    GROUP BY cluster) m ON m.cluster = c.cluster)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = a.cluster"""


OP11_SQL = _sql()
