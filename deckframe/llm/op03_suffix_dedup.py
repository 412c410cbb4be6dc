"""Dedup of repeated byte strings by suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else in
the corpus is removed.  Sorting all suffixes of a corpus would move each byte
hundreds of times, so only suffixes that can matter are sorted, with exactly
the same result:

1. Blocks.  Each window of LENGTH bytes is named by its anchor: the position in
   it whose ``GRAM``-byte hash is smallest, leftmost among ties.  Equal windows
   have equal anchors at equal places.  Consecutive windows with one anchor
   make a block (about 190 windows); its key is the hash at the anchor.  No two
   windows of a block are equal.
2. Folding.  Blocks with the same key and the same bytes are counted by hash
   aggregation; all windows of a block that occurs twice are repeats.  So groups
   of copies, however large, leave one block each.
3. Sorting.  Of keys with several different blocks the bytes are fetched.  The
   text from the anchor on is suffix-sorted by the deep-shallow method, and so
   is the text before it, read backwards.  The common prefix lengths of both
   orders give classes: two windows that begin ``o`` bytes before their anchors
   are equal exactly if their blocks share o bytes before and LENGTH - o after.
4. Keys with more than ``SPLIT`` different blocks would not fit into a task;
   their windows are counted one by one by 128-bit hashes, again by aggregation.

Null texts count as empty; texts shorter than LENGTH lose nothing.  Repeated
rows are different places, so both lose what they share.  Rows with null ids
are treated as any other.  Empty tables give empty results; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import BASE, mix, runs, utf8
from .staging import staged
from .suffix_sort import deep_shallow

LENGTH = 400
GRAM = 32
SPLIT = 100_000
SORT_BLOCKS = 20_000


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes (a power of two) from each position on."""
    h = data.astype(np.uint64) + np.uint64(1)
    size, factor = 1, BASE
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    return mix(h)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    out, size = values, 1
    while 2 * size <= width:
        out, size = np.minimum(out[:-size], out[size:]), 2 * size
    return np.minimum(out[:len(values) - width + 1], out[width - size:]) if size < width else out


def blocks(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor and key of the blocks of a run of documents."""
    none = np.zeros(0, np.int64)
    room = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(room.sum())
    if not total:
        return none, none, none, none
    grams = gram_hashes(data)
    bits = np.uint64(max(20, int(len(data)).bit_length()))
    values = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    anchor = window_minimum(values, length - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    where = np.repeat(offsets[:-1] - np.append(0, np.cumsum(room)[:-1]), room) + np.arange(total)
    anchor = anchor[where].astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    count = np.diff(np.append(first, total))
    return where[first], count, anchor[first], grams[anchor[first]].view(np.int64)


def _cut(length: int):
    """Map side: the blocks of each document, without their bytes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            rows = np.arange(batch.num_rows)
            for a, b in runs(offsets):
                own = np.ascontiguousarray(data[offsets[a]:offsets[b]])
                at = offsets[a:b + 1] - offsets[a]
                start, count, anchor, key = blocks(own, at, length)
                if not len(start):
                    continue
                doc = np.searchsorted(at, start, "right") - 1
                view = memoryview(own)
                print_ = [blake2b(view[s:e], digest_size=16).digest()
                          for s, e in zip(start.tolist(), (start + count + length - 1).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_key").take(pa.array(rows[a:b][doc])), pa.array(start - at[doc]), pa.array(count),
                     pa.array(anchor - start), pa.array(key), pa.array(print_, pa.binary())],
                    ["row_key", "start", "n", "lead", "key", "print"])
    return cut


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the blocks listed for each document."""
    for batch in batches:
        for text, row, asked in zip(batch.column("text"), batch.column("row_key"), batch.column("asked")):
            raw = text.as_py().encode()
            asked = asked.as_py()
            piece = [raw[x["start"]:x["start"] + x["n"] + length - 1] for x in asked]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x["key"] for x in asked], pa.int64()), pa.array([row.as_py()] * len(asked), pa.binary()),
                 *(pa.array([x[c] for x in asked], pa.int64()) for c in ("start", "n", "lead")), pa.array(piece, pa.binary())],
                ["key", "row_key", "start", "n", "lead", "piece"])


def repeated_windows(keys: np.ndarray, lead: np.ndarray, n: np.ndarray, pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and window (its place in the block) of all windows that another
    block of the same key holds as well."""
    _, group = np.unique(keys, return_inverse=True)
    after, after_shared = deep_shallow([p[k:] for p, k in zip(pieces, lead.tolist())], group)
    before, before_shared = deep_shallow([p[:k][::-1] for p, k in zip(pieces, lead.tolist())], group)
    hit_block, hit_window = [], []
    right, left = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    last = lead - n + 1  # a block's windows begin lead, lead - 1, ..., last bytes before the anchor
    for o in range(int(last.min()), int(lead.max()) + 1):
        live = np.flatnonzero((last <= o) & (o <= lead))
        if len(live) < 2:
            continue
        right[after] = np.cumsum(after_shared < length - o)
        left[before] = np.cumsum(before_shared < o)
        both = right[live] * (len(keys) + 1) + left[live]
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        twice = order[np.append(same, False) | np.append(False, same)]
        hit_block.append(live[twice])
        hit_window.append(lead[live[twice]] - o)
    none = np.zeros(0, np.int64)
    return np.concatenate(hit_block or [none]), np.concatenate(hit_window or [none])


def _spans(block: np.ndarray, window: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows of a block as byte ranges of the block."""
    order = np.lexsort((window, block))
    block, window = block[order], window[order]
    first = np.ones(len(block), bool)
    first[1:] = (block[1:] != block[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(first)
    end = np.append(at[1:], len(block))[:len(at)] - 1
    return block[at], window[at], window[end] + length


def _sorted_spans(length: int):
    """Reduce side, rows sorted by key: sorts whole keys, some blocks at a time."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        number = lambda c: table.column(c).to_numpy()
        pieces = table.column("piece").to_pylist()
        block, window = repeated_windows(number("key"), number("lead"), number("n"), pieces, length)
        block, low, high = _spans(block, window, length)
        start = number("start")[block]
        return pa.RecordBatch.from_arrays(
            [table.column("row_key").combine_chunks().take(pa.array(block)), pa.array(start + low), pa.array(start + high)],
            ["row_key", "low", "high"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            if rows + batch.num_rows > SORT_BLOCKS:
                # everything before the first row of the batch's last key is whole
                whole = int(np.flatnonzero(keys != keys[-1]).max()) + 1 if keys[0] != keys[-1] else 0
                if whole or (held and held[-1].column("key")[-1].as_py() != keys[0]):
                    ready = held + ([batch.slice(0, whole)] if whole else [])
                    if ready:
                        yield solve(pa.Table.from_batches(ready))
                    held, rows, batch = [], 0, batch.slice(whole)
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))

    return walk


def _window_prints(length: int):
    """One row for each window of a block, by its hash."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start, n, piece in zip(*(batch.column(c).to_pylist() for c in ("row_key", "start", "n", "piece"))):
                prints = [blake2b(piece[k:k + length], digest_size=16).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * n, pa.binary()), pa.array(np.arange(start, start + n)), pa.array(prints, pa.binary())],
                    ["row_key", "low", "print"])

    return walk


def _with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a null id leaves the part before the bar empty, which no number does
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.lit("|"), text).cast("binary")))
    key = F.coalesce(key, F.lit(b""))  # never null, so that both joins on it share one shuffle of the texts
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), key.alias("row_key"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, split: int = SPLIT) -> DataFrame:
    """(row_key, low, high): byte ranges of ``texts`` (doc_id, text, row_key)
    that repeats cover; they may overlap."""
    cut = staged(texts.select("row_key", "text").mapInArrow(
        _cut(length), "row_key binary, start long, n long, lead long, key long, print binary"), "blocks")
    kinds = staged(cut.groupBy("key", "print").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("row_key", "start", "n", "lead")).alias("one")), "kinds")
    copied = (cut.join(kinds.where("copies > 1").select("key", "print"), ["key", "print"])
              .select("row_key", F.col("start").alias("low"), (F.col("start") + F.col("n") + length - 1).alias("high")))
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = (kinds.join(several, "key").groupBy(F.col("one.row_key").alias("row_key"))
              .agg(F.collect_list(F.struct("key", "one.start", "one.n", "one.lead", (F.col("kinds") > split).alias("many"))).alias("asked")))
    # repeated rows give a block twice, which is right: its windows are repeats
    fetched = texts.join(wanted, "row_key")
    fields = "key long, row_key binary, start long, n long, lead long, piece binary"
    fetch = lambda b: _pieces(b, length)
    few = fetched.withColumn("asked", F.expr("filter(asked, x -> NOT x.many)")).where("size(asked) > 0").mapInArrow(fetch, fields)
    sorted_ = (few.repartition("key").sortWithinPartitions("key")
               .mapInArrow(_sorted_spans(length), "row_key binary, low long, high long"))
    if several.where(F.col("kinds") > split).isEmpty():
        return copied.unionByName(sorted_)
    many = fetched.withColumn("asked", F.expr("filter(asked, x -> x.many)")).where("size(asked) > 0").mapInArrow(fetch, fields)
    prints = staged(many.mapInArrow(_window_prints(length), "row_key binary, low long, print binary"), "windows")
    twice = prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = prints.join(twice, "print").select("row_key", "low", (F.col("low") + length).alias("high"))
    return copied.unionByName(sorted_).unionByName(counted)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the ranges out of each text."""
    for batch in batches:
        kept, gone = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw, rest, merged = text.encode(), [], []
            for x in sorted((x["low"], x["high"]) for x in spans or ()):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            at = 0
            for low, high in merged:
                rest.append(raw[at:low])
                at = high
            rest.append(raw[at:])
            kept.append(b"".join(rest))
            gone.append([{"low": a, "high": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t.encode()) for t in batch.column("text").to_pylist()], pa.int64()),
             pa.array(gone, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "removed", "kept_bytes"])


def strip_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                  split: int = SPLIT) -> DataFrame:
    """(doc_id, n_bytes, removed ranges, kept_bytes) of every row.  The kept
    bytes need not be whole UTF-8 characters."""
    texts = _with_key(docs, id_col, text_col)
    ranges = (repeated_spans(texts, length, split).groupBy("row_key")
              .agg(F.collect_set(F.struct("low", "high")).alias("spans")))
    return texts.join(ranges, "row_key", "left").select("doc_id", "text", "spans").mapInArrow(
        _strip, "doc_id long, n_bytes long, removed array<struct<low long, high long>>, kept_bytes binary")


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What 400-byte repeats take from each row of ``documents``."""
    out = strip_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["high"] - x["low"])
    return out.select("doc_id", "n_bytes", size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept_bytes", 256).alias("kept_sha256"))
