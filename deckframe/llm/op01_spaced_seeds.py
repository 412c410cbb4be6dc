"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of ASCII letters and digits and of non-ASCII characters, A-Z
read as a-z, so punctuation doesn't part a copy from its source.  A seed is the
hash of the tokens that a fixed mask selects from consecutive ones; tokens under
a 0 may differ.  The masks are chosen so that whatever step 4 accepts shares a
seed: in 8 tokens they leave room for any one substitution, in 10 for any two,
in 15 for any three, in 20 for four and in 25 for five.  A stretch of 13 tokens
or more that agrees to 80 % holds one of 13 to 25 that does (a longer one has a
half that does), and these fall under the cases above.

1. Seeds of all benchmark items make a table (seed, item, position) and a Bloom
   filter of ``BLOOM_BITS_MOST`` bits at most, which is broadcast.
2. Every document is seeded at every token.  Seeds that the filter lets through
   leave the task together with the tokens around them, as regions; these reach as far as the longest item.
3. These seeds are joined with the benchmark's.  A wrong answer of the filter
   finds no partner there.
4. Each (region, item, diagonal) is compared token by token.  A stretch counts
   as an overlap if it has ``OVERLAP`` tokens, or the whole item if that is
   shorter, and ``IDENTITY`` of them agree; the longest of these is reported, of
   equally long ones that with the most equal tokens.

Items of fewer than ``LEAST_ITEM`` tokens are found only where all their tokens
stand in a row: such an item is one seed, all of it, and documents are seeded
with runs of the lengths that occur.  Items without tokens are found nowhere.

Null texts count as empty.  Repeated rows and items are reported as one.  Rows
with null ids are told apart by their text.  Empty tables give empty results;
extra columns are ignored.  Long texts are worked whole, so a task holds one
text; a long item is compared only where it lies beside the document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import BASE, mix, runs, utf8, words
from .listed import without
from .staging import staged

# fixed values: 1 selects a token, 0 ignores it
MASKS = ("1111011", "10101111", "11011101", "1111000011", "110010111")
LEAST_ITEM = 8
SHORT = range(1, LEAST_ITEM)
OVERLAP = 13
IDENTITY = 0.8
MISMATCH = 3  # only the brute force of tests/llm scores with it
BLOOM_HASHES = 4
BLOOM_BITS_MOST = 1 << 26

TOKEN_BREAKS = np.ones(256, bool)
TOKEN_BREAKS[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False


def seeds(hashes: np.ndarray, bounds: np.ndarray, whole: Iterable[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask, then for each length of ``whole`` (runs without gaps), the
    positions of tokens at which it fits into a document, and the seeds there.
    ``bounds``: tokens before each document."""
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(hashes))  # tokens up to the end of the document
    for number, mask in [*enumerate(MASKS, 1), *((len(MASKS) + n, "1" * n) for n in whole)]:
        at = np.flatnonzero(left >= len(mask))
        seed = np.full(len(at), number, np.uint64)
        for k, chosen in enumerate(mask):
            if chosen == "1":
                seed = seed * np.uint64(BASE) + hashes[at + k]
        yield at, mix(seed)


def _bloom_places(seed: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(BLOOM_HASHES):
        yield (seed * np.uint64(2 * k + 0x9E3779B1) >> np.uint64(20)) & np.uint64(bits - 1)


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_key, at, n_item) of (item_key, text): the masks' seeds of an item
    of ``LEAST_ITEM`` tokens or more, the one seed of a shorter one."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in runs(offsets):
                found = words(data, offsets[a:b + 1], TOKEN_BREAKS)
                length = np.diff(found.bounds)
                for number, (at, seed) in enumerate(seeds(found.hashes, found.bounds, SHORT)):
                    asked = length >= LEAST_ITEM if number < len(MASKS) else length == SHORT[number - len(MASKS)]
                    item = np.searchsorted(found.bounds, at, "right") - 1
                    at, seed, item = at[asked[item]], seed[asked[item]], item[asked[item]]
                    rows = pa.array(a + item)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seed.view(np.int64)), batch.column("item_key").take(rows), pa.array(at - found.bounds[item]), pa.array(length[item])],
                        ["seed", "item_key", "at", "n_item"])

    return items.select("item_key", "text").mapInArrow(cut, "seed long, item_key binary, at long, n_item long")


def bloom(table: DataFrame) -> np.ndarray:
    """Filter of a staged seed table as bytes, made by a grouped bit-or: what
    comes back is the filter, of bounded size."""
    n = table.count()
    bits = 1 << 16
    while bits < 32 * n and bits < BLOOM_BITS_MOST:
        bits *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed = batch.column("seed").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(_bloom_places(seed, bits))).astype(np.int64))], ["bit"])

    rows = (table.select("seed").mapInArrow(places, "bit long")
            .groupBy(F.shiftright("bit", 5).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, int(bit & 31)))").alias("mask")).collect())
    words_ = np.zeros(bits // 32, np.uint32)
    for r in rows:
        words_[r["word"]] = r["mask"]
    return np.unpackbits(words_.view(np.uint8), bitorder="little").view(bool)


def token_hashes(table: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the token hashes of each text."""
    def cut(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            column = []
            for a, b in runs(offsets):
                found = words(data, offsets[a:b + 1], TOKEN_BREAKS)
                column += [found.hashes[i:j].tobytes() for i, j in zip(found.bounds[:-1], found.bounds[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(column, pa.binary())], [*keys, "tokens"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.select(*keys).schema)
    return table.select(*keys, "text").mapInArrow(cut, f"{fields}, tokens binary")


def _regions(texts: DataFrame, filter_: np.ndarray, reach: int, whole: list[int]) -> DataFrame:
    """Parts of documents in which the filter knows seeds, with ``reach`` tokens
    on both sides.  Of runs without gaps (lengths ``whole``) a document gives the
    first of its equal ones: it is the one that is reported."""
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(filter_, bitorder="little"))
    bits = len(filter_)

    def known(seed: np.ndarray, packed: np.ndarray) -> np.ndarray:
        spots = np.arange(len(seed))
        for place in _bloom_places(seed, bits):
            here = place[spots]
            spots = spots[(packed[here >> np.uint64(3)] >> (here & np.uint64(7)).astype(np.uint8)) & 1 > 0]
            if not len(spots):
                break
        return spots

    hit = pa.struct([("seed", pa.int64()), ("at", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in runs(offsets):
                found = words(data, offsets[a:b + 1], TOKEN_BREAKS)
                pairs = []
                for number, (at, seed) in enumerate(seeds(found.hashes, found.bounds, whole)):
                    spots = known(seed, packed)
                    at, seed = at[spots], seed[spots]
                    if number >= len(MASKS):
                        order = np.lexsort((at, seed, np.searchsorted(found.bounds, at, "right")))
                        at, seed = at[order], seed[order]
                        doc = np.searchsorted(found.bounds, at, "right")
                        first = np.append(True, (doc[1:] != doc[:-1]) | (seed[1:] != seed[:-1]))[:len(at)]
                        at, seed = at[first], seed[first]
                    pairs.append((at, seed))
                at = np.concatenate([x for x, _ in pairs])
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed = at[order], np.concatenate([x for _, x in pairs])[order].view(np.int64)
                doc = np.searchsorted(found.bounds, at, "right") - 1
                first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 2 * reach)))
                last = np.append(first[1:], len(at))
                rows, starts, tokens, hits = [], [], [], []
                for i, j in zip(first.tolist(), last.tolist()):
                    low = max(int(found.bounds[doc[i]]), int(at[i]) - reach)
                    high = min(int(found.bounds[doc[i] + 1]), int(at[j - 1]) + reach)
                    rows.append(a + int(doc[i]))
                    starts.append(low - int(found.bounds[doc[i]]))
                    tokens.append(found.hashes[low:high].tobytes())
                    hits.append([{"seed": s, "at": x - low} for s, x in zip(seed[i:j].tolist(), at[i:j].tolist())])
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("doc_key").take(take), pa.array(starts, pa.int64()),
                     pa.array(tokens, pa.binary()), pa.array(hits, pa.list_(hit))],
                    ["doc_id", "doc_key", "start", "tokens", "hits"])

    return texts.select("doc_id", "doc_key", "text").mapInArrow(
        cut, "doc_id long, doc_key binary, start long, tokens binary, hits array<struct<seed long, at long>>")


def longest_stretch(match: np.ndarray) -> tuple[int, int]:
    """Start and end of the longest stretch of which ``IDENTITY`` agree, of
    equally long ones that with the most matches; 0, 0 where there is none."""
    # in whole hundredths, so that a stretch at the limit sums up to 0
    score = np.concatenate([[0], np.cumsum(np.where(match, 100, 0) - round(100 * IDENTITY))])
    most = np.maximum.accumulate(score[::-1])[::-1]  # from each end on; never grows
    end = np.searchsorted(-most, -score, "right") - 1
    length = end - np.arange(len(score))
    best = np.flatnonzero(length == length.max())
    start = int(best[np.argmax((score[end] - score)[best])])
    return (start, int(end[start])) if length[start] else (0, 0)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The overlap on each diagonal, where there is one.  ``tokens`` begins
    where the item does, or where the region does if that is later."""
    for batch in batches:
        keep, rows = [], []
        for i, (d, t, diagonal, start) in enumerate(zip(*(batch.column(c) for c in ("tokens", "item_tokens", "diagonal", "start")))):
            doc, item = np.frombuffer(d.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
            shift = diagonal.as_py()
            low = max(0, -shift)
            match = doc == item[low:low + len(doc)]
            a, b = longest_stretch(match)
            if b - a >= min(OVERLAP, len(item)):
                keep.append(i)
                rows.append((start.as_py() + low + shift + a, low + a, b - a, int(match[a:b].sum())))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(keep, pa.int64())) for c in ("doc_id", "doc_key", "item_key")), *(pa.array(c, pa.int64()) for c in columns)],
            ["doc_id", "doc_key", "item_key", "doc_start", "item_start", "n_tokens", "n_same"])


def _keyed(table: DataFrame, id_col: str, text_col: str, id_name: str, key_name: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return table.select(F.col(id_col).cast("long").alias(id_name), F.unhex(F.md5(text.cast("binary"))).alias(key_name), text.alias("text"))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, doc_key, item_id, doc_start, item_start, n_tokens, n_same): the
    longest overlap of each document and item, of equally long ones that with
    the most equal tokens; positions count tokens, doc_key is the MD5 of the
    text."""
    texts = _keyed(docs, id_col, text_col, "doc_id", "doc_key")
    items = _keyed(benchmark, item_id_col, item_text_col, "item_id", "item_key")
    once = items.dropDuplicates(["item_key"])
    table = staged(item_seeds(once), "item-seeds")
    tokens = staged(token_hashes(once, ["item_key"]).withColumnRenamed("tokens", "item_tokens"), "item-tokens")
    n_item = F.length("item_tokens") / 8
    longest, whole = tokens.agg(F.max(n_item), F.collect_set(F.when((n_item > 0) & (n_item < LEAST_ITEM), n_item))).first()
    reach, whole = int(longest or 0), sorted(map(int, whole))  # at most LEAST_ITEM - 1 lengths
    regions = staged(_regions(texts, bloom(table), reach, whole).withColumn("region", F.monotonically_increasing_id()), "regions")
    hits = regions.select("region", F.inline("hits").alias("seed", "doc_at"))
    diagonals = hits.join(table, "seed").select("region", "item_key", "n_item", (F.col("doc_at") - F.col("at")).alias("diagonal")).distinct()
    # what lies beside the item only, 8 bytes a token, before it meets the items
    pairs = (diagonals.join(regions.drop("hits"), "region").withColumn(
        "tokens", F.expr("substring(tokens, int(8 * greatest(diagonal, 0)) + 1, int(8 * (n_item + least(diagonal, 0))))"))
        .join(tokens, "item_key"))
    found = pairs.select("doc_id", "doc_key", "item_key", "start", "tokens", "item_tokens", "diagonal").mapInArrow(
        _compare, "doc_id long, doc_key binary, item_key binary, doc_start long, item_start long, n_tokens long, n_same long")
    best = found.groupBy("doc_id", "doc_key", "item_key").agg(
        F.max(F.struct("n_tokens", "n_same", -F.col("doc_start"), -F.col("item_start"))).alias("best"))
    named = items.select("item_id", "item_key").distinct()
    return best.join(named, "item_key").select(
        "doc_id", "doc_key", "item_id", (-F.col("best.col3")).alias("doc_start"), (-F.col("best.col4")).alias("item_start"),
        "best.n_tokens", "best.n_same")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without documents that overlap with an item, all columns unchanged."""
    bad = staged(overlaps(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")).distinct(), "contaminated")
    return without(docs, bad, id_col, text_col)


def op1_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the longest overlap of each."""
    found = overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("doc_key")
