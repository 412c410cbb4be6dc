"""Best-fit packing with exact-complement hashing.

Texts become token pieces of at most ``CAPACITY`` ids, and pieces are packed into
sequences of CAPACITY ids.  How to pack depends on nothing but how many pieces
there are of each length, so the plan is made from that histogram, which has at
most CAPACITY entries however large the corpus is:

1. Lengths are taken from the longest down.  The gap a piece leaves is looked
   up in an index of the sums of one, two and three available lengths, and the
   combination found is used as often as its lengths are available.
2. Lengths without an exact complement are packed by best fit, longest first,
   as many at a time as the counts allow.

The plan lists, for each length, which ranks go to which sequences and offsets.
Pieces are numbered inside their length by a distributed count and look up
their place; nothing but the histogram and the plan passes through the driver.

Null texts count as empty: they are one piece with the end id.  Rows with null
or repeated ids are packed as any other.  An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slots import dense_slots
from .staging import staged
from .tokens import encoder

CAPACITY = 2048
END_ID = 0


class SumIndex:
    """Which one, two or three available lengths make up a sum.

    Counts only fall, so for each sum the search for a pair goes on from where
    it last succeeded.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts.tolist()
        self.reach: dict[int, int] = {}

    def _have(self, *lengths: int) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in lengths)

    def _pair(self, total: int, held: tuple[int, ...]) -> tuple[int, ...] | None:
        a = self.reach.get(total, total - 1)
        settled = True
        while 2 * a >= total:
            if not self._have(a, total - a):
                if settled:
                    self.reach[total] = a - 1
            elif self._have(a, total - a, *held):
                return a, total - a
            else:
                settled = False
            a -= 1
        return None

    def complement(self, length: int, capacity: int) -> tuple[int, ...] | None:
        """Lengths that fill what ``length`` leaves, the fewest first."""
        gap = capacity - length
        if gap == 0:
            return ()
        if self._have(gap, length):
            return (gap,)
        if pair := self._pair(gap, (length,)):
            return pair
        for a in range(min(length, gap - 2), 0, -1):
            if 3 * a < gap:
                break
            if self._have(a, length) and (pair := self._pair(gap - a, (a, length))):
                return a, *pair
        return None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Use a combination as often as it is available."""
        times = min(self.counts[x] // lengths.count(x) for x in lengths)
        for x in lengths:
            self.counts[x] -= times
        return times


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence in order, number of such sequences)."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    index = SumIndex(counts)
    made: dict[tuple[int, ...], int] = defaultdict(int)
    rest = []
    for length in range(capacity, 0, -1):
        while index.counts[length]:
            fill = index.complement(length, capacity)
            if fill is None:
                rest.append((length, index.counts[length]))
                index.counts[length] = 0
            else:
                made[length, *fill] += index.take((length, *fill))
    for lengths, n in _best_fit(rest, capacity).items():
        made[lengths] += n
    return list(made.items())


def _best_fit(rest: list[tuple[int, int]], capacity: int) -> dict[tuple[int, ...], int]:
    """``rest``: (length, count), longest first."""
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by gap
    for length, n in rest:
        moved: dict[tuple[int, ...], int] = defaultdict(int)
        while n:
            gap = min((g for g, bins in open_.items() if g >= length and bins), default=None)
            if gap is None:
                each = capacity // length
                if n >= each:
                    moved[(length,) * each] += n // each
                if n % each:
                    moved[(length,) * (n % each)] += 1
                break
            lengths, bins = open_[gap].popitem()
            each = min(gap // length, n)
            used = min(bins, n // each)
            moved[lengths + (length,) * each] += used
            n -= used * each
            if bins > used:
                open_[gap][lengths] = bins - used
        for lengths, bins in moved.items():
            held = open_[capacity - sum(lengths)]
            held[lengths] = held.get(lengths, 0) + bins
    return {lengths: n for bins in open_.values() for lengths, n in bins.items()}


def places(made: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: the pieces of
    a length from that rank on go one to a sequence at that offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, n in made:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += n
            offset += x
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the token pieces of each
    row, in its order; ``ids`` are little-endian 32-bit integers."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at:at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(own) // 4, crc32(own), own if with_ids else None))
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (staged pieces) with ``sequence_id`` and ``offset``."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(plan(histogram, capacity))
    shift = np.int64(1) << np.int64(48)
    keys = table[:, 0] * shift + table[:, 1]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = np.searchsorted(keys, length * shift + rank, "right") - 1
            sequence = table[row, 2] + rank - table[row, 1]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(table[row, 3])],
                                             [*kept, "sequence_id", "offset"])

    ranked = dense_slots(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(settle, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the packed sequences themselves;
    ``packed`` must have ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
                    F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets")))


def op4_best_fit_pack(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` packed into sequences of 2048 ids."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pack(staged(cut.drop("ids"), "pieces"))
