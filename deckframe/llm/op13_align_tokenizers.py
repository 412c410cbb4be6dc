"""Alignment of two tokenizers' tokens over byte offsets, in Arrow.

``A`` encodes space + text with a byte-level BPE, ``B`` the text with a
sentencepiece model that puts the space in front itself.  Where the bytes of
both token lists are those of space + text, their ends are byte offsets of one
and the same string, and

* the ends of both are cumulative sums of token lengths, segmented by document
  by letting the sum run on over the documents of a run: document and offset are
  then one key, and documents end at the same keys in both lists;
* a full outer hash join of A's ends with B's ends has one row for each stretch
  of bytes that lies in one token of each: the linked pairs of tokens.  The
  tokens are found by filling in, from behind, the ids of the next end;
* rows where both sides have an end close a group;
* pairs of ids are grouped per document, then per run, and these partial counts
  of documents are merged by Spark.

Texts are cut at spaces between two other characters that are no white space.
The rules of both vocabularies (checked when they are loaded) never join tokens
over such a place, so pieces are encoded once and then found in a cache, and a
very long text is worked in stretches; with other rules whole texts are encoded.

Documents and counts are written to the shared folder once; the counts of pairs
meet the pairs of documents in a join on the pair, after they are summed up
within each document.

Null and empty texts, and those whose bytes aren't kept by a tokenizer (U+2581,
for instance) have no tokens: zeros and ''.  Every row is a document, also where
ids are null or repeated.  Ties for an id's highest count all count as best.  An
empty table gives no rows; extra columns are ignored.  Memory follows half a MB of
text, or the longest text and its different pairs.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import runs
from .staging import staged
from .tokens import _byte_letters

CACHE = 200_000  # pieces
LONGEST_KEPT = 64  # bytes of a piece in the cache
RUN_BYTES = 1 << 19
SPACE = "▁"
# fixed values: the rules of A under which tokens never go over a cut
_RULES = {"normalizer": None, "post_processor": None,
          "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
_CUT = re.compile(r"[^\s\x00-\x20](?= [^\s\x00-\x20])")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_LOADED: dict[tuple[str, str], Pair] = {}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the pieces seen so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        rules = json.loads(self.a.to_str())
        byte = {x: i for i, x in enumerate(_byte_letters())}
        self.bytes_a = {i: bytes(byte[x] for x in t) if all(x in byte for x in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_b = [self._bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        spec = model.ModelProto()
        with open(path_b, "rb") as f:
            spec.ParseFromString(f.read())
        # a cut is safe if A splits there by its rules and no piece of B has a space after another character
        self.cuts = ({k: rules[k] for k in _RULES} == _RULES and spec.normalizer_spec.name == "identity"
                     and not spec.normalizer_spec.remove_extra_whitespaces and spec.trainer_spec.model_type == 2
                     and not any(p.type in (4, 5) or SPACE in p.piece.lstrip(SPACE) for p in spec.pieces))
        self.names = [pa.array([str(i) for i in range(n)]) for n in (max(self.bytes_a) + 1, len(self.bytes_b))]
        self.sizes = [np.array([len(own.get(i, b"")) for i in range(max(own) + 1)], np.int64)
                      for own in (self.bytes_a, dict(enumerate(self.bytes_b)))]
        self.seen: dict[bytes, int] = {}
        self.ids = [_Lists(), _Lists()]
        self.kept = np.zeros(0, bool)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        found = _BYTE.fullmatch(piece)
        return bytes([int(found[1], 16)]) if found else piece.replace(SPACE, " ").encode()

    def _encode(self, pieces: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """(ids, numbers of ids) of A and B, and whether the bytes are kept, of pieces
        that may stand side by side: encoded as one text, in halves where that fails."""
        whole = b"".join(pieces)
        text = whole.decode()
        ids = [np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64), np.array(self.b.encode(text[1:]), np.int64)]
        bounds, counts = np.cumsum([len(p) for p in pieces]), []
        for k, of in ((0, self.bytes_a), (1, self.bytes_b)):
            ends = np.cumsum(self.sizes[k][ids[k]])
            at = np.searchsorted(ends, bounds)
            fits = len(ends) and ends[-1] == len(whole) and (ends[at] == bounds).all()
            if not fits or b"".join([of[i] for i in ids[k].tolist()]) != whole:
                break
            counts.append(np.diff(at + 1, prepend=0))
        else:
            return ids, counts, np.ones(len(pieces), bool)
        if len(pieces) == 1:
            return [np.zeros(0, np.int64)] * 2, [np.zeros(1, np.int64)] * 2, np.zeros(1, bool)
        first, second = self._encode(pieces[:len(pieces) // 2]), self._encode(pieces[len(pieces) // 2:])
        return ([np.concatenate(x) for x in zip(first[0], second[0])], [np.concatenate(x) for x in zip(first[1], second[1])],
                np.concatenate([first[2], second[2]]))

    def look_up(self, pieces: list[bytes], free: np.ndarray) -> tuple[np.ndarray, list[pa.ListArray]]:
        """(kept, ids of A and B as lists) of different pieces; ``free``: those that may
        stand between others.  Short ones are kept."""
        if len(self.kept) > CACHE:
            self.seen.clear()
            self.ids, self.kept = [_Lists(), _Lists()], np.zeros(0, bool)
        at = np.fromiter((self.seen.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        if len(new):
            order = np.concatenate([new[free[new]], new[~free[new]]])
            together = int(free[new].sum())
            parts = [self._encode([pieces[i] for i in order[:together].tolist()])] if together else []
            parts += [self._encode([pieces[i]]) for i in order[together:].tolist()]
            at[order] = len(self.kept) + np.arange(len(order))
            self.kept = np.concatenate([self.kept, *(p[2] for p in parts)])
            for k in (0, 1):
                self.ids[k].add(np.concatenate([p[0][k] for p in parts]), np.concatenate([p[1][k] for p in parts]))
            self.seen.update((pieces[i], x) for i, x in zip(order.tolist(), at[order].tolist()) if len(pieces[i]) <= LONGEST_KEPT)
        return self.kept[at], [own.take(at) for own in self.ids]


class _Lists:
    """Lists of ids on end, with their offsets."""

    def __init__(self):
        self.values, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
        self.values = np.concatenate([self.values, values.astype(np.int32)])

    def take(self, at: np.ndarray) -> pa.ListArray:
        lists = pa.LargeListArray.from_arrays(pa.array(self.offsets), pa.array(self.values))
        return lists.take(pa.array(at))


def pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


def _no_space(data: np.ndarray, at: np.ndarray, last: bool) -> np.ndarray:
    """True where the character that starts (``last``: ends) at ``at`` is surely no
    white space or control character.  Lead bytes of blocks with white space count as such."""
    spacious = np.zeros(256, bool)
    spacious[:0x21] = True
    spacious[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
    if not last:
        return ~spacious[data[at]]
    lead = at.copy()
    for _ in range(3):
        lead = np.where((data[lead] & 0xC0) == 0x80, np.maximum(lead - 1, 0), lead)
    return ~spacious[data[lead]]


def pieces_of(texts: list[str], cuts: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces, text of each piece, free) of space + text, cut where no token goes
    over; ``free`` pieces begin and end so that they could follow one another."""
    raw = [b" " + t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    begins = ends - [len(r) for r in raw]
    opens = np.zeros(len(data) + 1, bool)
    if cuts:
        spaces = np.flatnonzero(data[1:-1] == 0x20) + 1
        opens[spaces[_no_space(data, spaces - 1, True) & _no_space(data, spaces + 1, False)]] = True
    opens[begins] = True
    starts = np.flatnonzero(opens)
    offsets = np.concatenate([starts, ends[-1:]])
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    long = np.diff(offsets) > 1
    free = cuts & long & _no_space(data, np.minimum(starts + 1, len(data) - 1), False) & _no_space(data, offsets[1:] - 1, True)
    return pieces, np.searchsorted(begins, starts, "right") - 1, free


def stretches(texts: list[str], cuts: bool, limit: int = RUN_BYTES) -> Iterator[tuple[list[int], list[str]]]:
    """(documents, texts) in runs of about ``limit`` characters; a longer text comes in
    stretches, each without the space that it starts with."""
    docs, own, size = [], [], 0
    for i, text in enumerate(texts):
        if cuts and len(text) > limit:
            at = 0
            while len(text) - at > limit:
                found = _CUT.search(text, at + limit)
                if found is None:
                    break
                yield [i], [text[at:found.end()]]
                at = found.end() + 1
            text = text[at:]
        docs.append(i)
        own.append(text)
        size += len(text)
        if size >= limit:
            yield docs, own
            docs, own, size = [], [], 0
    if docs:
        yield docs, own


def _joined(names: pa.Array, closes: np.ndarray) -> pa.Array:
    """Names joined by commas, up to each one that closes a group."""
    offsets = np.concatenate([[0], np.flatnonzero(closes) + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names), ",")


def aligned(texts: list[str], tokenizers: Pair) -> tuple[dict[str, np.ndarray | pa.Array], pa.Table]:
    """Of each text n_a, n_b, n_groups, n_links, kept and the groups' text; and a table
    (doc, pair, links) of its different pairs, A's id in the upper 32 bits."""
    n = len(texts)
    pieces, of, free = pieces_of(texts, tokenizers.cuts)
    coded = pieces.dictionary_encode()
    code = coded.indices.to_numpy()
    once = np.zeros(len(coded.dictionary), bool)
    once[code] = free
    kept, ids = tokenizers.look_up(coded.dictionary.to_pylist(), once)
    lost = np.bincount(of, ~kept[code], minlength=n) > 0
    used = ~lost[of]
    code, of = pa.array(code[used]), of[used]
    tables, counts, flats = [], [], []
    for k, side in enumerate("ab"):
        lists = ids[k].take(code)
        flat = lists.flatten()
        doc = of[pc.list_parent_indices(lists).to_numpy()]
        tables.append(pa.table({"end": pc.cumulative_sum(pa.array(tokenizers.sizes[k][flat.to_numpy()])), side: flat}))
        counts.append(np.bincount(doc, minlength=n))
        flats.append(flat)
    links = tables[0].join(tables[1], "end", join_type="full outer", use_threads=False).sort_by("end")
    ends_in = [links[c].combine_chunks().is_valid().to_numpy(zero_copy_only=False) for c in "ab"]
    closes = ends_in[0] & ends_in[1]
    a, b = (pc.fill_null_backward(links[c].combine_chunks()).to_numpy().astype(np.int64) for c in "ab")
    ends = links["end"].combine_chunks().to_numpy()
    own_ends = tables[0]["end"].combine_chunks().to_numpy()
    last = np.concatenate([[0], own_ends])[np.cumsum(counts[0])]  # a document without tokens ends where the one before does
    n_links = np.diff(np.searchsorted(ends, last, "right"), prepend=0)
    doc = np.repeat(np.arange(n), n_links)
    groups = pc.binary_join_element_wise(*(_joined(tokenizers.names[k].take(flats[k]), closes[ends_in[k]]) for k in (0, 1)), "|")
    n_groups = np.bincount(doc[closes], minlength=n)
    offsets = np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)
    shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), groups), ";")
    pairs = pa.table({"doc": doc, "pair": (a << 32) | b}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return ({"n_a": counts[0], "n_b": counts[1], "n_groups": n_groups, "n_links": n_links, "kept": ~lost, "shown": shown},
            pairs.rename_columns(["doc", "pair", "links"]))


FIELDS = ("n_a", "n_b", "n_groups", "n_links")
_SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, links array<long>, docs array<long>")


def _documents(texts: list[str], tokenizers: Pair, run_bytes: int) -> tuple[dict, pa.Table]:
    """Of each text the counts and the hash of its groups; and (doc, pair, links) in the order of the texts."""
    n = len(texts)
    totals, kept = {f: np.zeros(n, np.int64) for f in FIELDS}, np.ones(n, bool)
    hashes, found = [None] * n, []
    for at, some in stretches(texts, tokenizers.cuts, run_bytes):
        own, pairs = aligned(some, tokenizers)
        for f in FIELDS:
            totals[f][at] += own[f]
        kept[at] &= own["kept"]
        for i, shown in zip(at, own["shown"].cast(pa.binary()).to_pylist()):
            if hashes[i] is None:
                hashes[i] = sha256(shown)
            else:
                hashes[i].update(b";" + shown)
        found.append(pairs.set_column(0, "doc", pa.array(np.array(at)[pairs["doc"].to_numpy()])))
    pairs = pa.concat_tables(found)
    if len(found) > 1:  # stretches of one document may share pairs
        pairs = pairs.group_by(["doc", "pair"], use_threads=False).aggregate([("links", "sum")]).rename_columns(["doc", "pair", "links"])
    empty = ~kept | (totals["n_a"] == 0)
    return ({f: np.where(empty, 0, x) for f, x in totals.items()} | {"groups_sha256": ["" if e else h.hexdigest() for e, h in zip(empty, hashes)]},
            pairs.filter(pa.array(kept).take(pairs["doc"])).sort_by("doc"))


class _Partial:
    """Counts of documents by pair, given out whenever there are many pairs."""

    MANY = 1 << 19

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, pairs: pa.Table) -> Iterator[pa.RecordBatch]:
        self.held.append(pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")]))
        self.size += self.held[-1].num_rows
        if self.size > 2 * self.MANY:
            self.held = [pa.concat_tables(self.held).group_by("pair", use_threads=False).aggregate([("count_all", "sum")])
                         .rename_columns(["pair", "count_all"])]
            self.size = self.held[0].num_rows
            if self.size > self.MANY:
                yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            merged = pa.concat_tables(self.held).group_by("pair", use_threads=False).aggregate([("count_all", "sum")])
            ends = pa.array([0, merged.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64())] * 6 + [pa.nulls(1, pa.string()), pa.ListArray.from_arrays(ends, merged["pair"].combine_chunks()),
                 pa.nulls(1, pa.list_(pa.int64())), pa.ListArray.from_arrays(ends, merged["count_all_sum"].combine_chunks())], NAMES)
        self.held, self.size = [], 0


def _alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, run_bytes: int) -> DataFrame:
    """A row for each document with its different pairs and their links, and a row for
    each part of the work (``row`` null) with the partial counts: in how many documents a pair is."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, number = pair(path_a, path_b), TaskContext.get().partitionId() << 36
        partial = _Partial()
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
            for first, last in runs(np.concatenate([[0], sizes]), run_bytes):
                own, pairs = _documents(batch.column("text")[first:last].to_pylist(), tokenizers, run_bytes)
                n = last - first
                offsets = pa.array(np.searchsorted(pairs["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number + np.arange(n)), batch.column("doc_id")[first:last], *(pa.array(own[f]) for f in FIELDS),
                     pa.array(own["groups_sha256"]), pa.ListArray.from_arrays(offsets, pairs["pair"].combine_chunks()),
                     pa.ListArray.from_arrays(offsets, pairs["links"].combine_chunks()), pa.nulls(n, pa.list_(pa.int64()))], NAMES)
                number += n
                yield from partial.add(pairs)
                pa.default_memory_pool().release_unused()
        yield from partial.rows()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return staged(texts.mapInArrow(align, _SCHEMA), "aligned")


NAMES = [f.split()[0] for f in _SCHEMA.split(", ")]


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair, and whether no pair of the same A id is in more."""
    merged = (found.filter(F.col("row").isNull()).select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n")))
    same_a = Window.partitionBy(F.shiftright("pair", 32))  # at most as many rows as B has ids
    return staged(merged.withColumn("best", F.col("n") == F.max("n").over(same_a)), "pairs")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          run_bytes: int = RUN_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    found = _alignments(docs, path_a, path_b, id_col, text_col, run_bytes)
    rows = found.filter(F.col("row").isNotNull())
    held = rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", "x.pairs", "x.links")
    # pairs may be as many as both vocabularies' products: never a broadcast
    sums = (held.join(pair_counts(found).hint("merge"), F.col("pairs") == F.col("pair")).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("links") * F.col("n")).alias("count_sum")))
    return rows.join(sums, "row", "left").select(
        "doc_id", *FIELDS, F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def op13_align_tokenizers(spark, sf_dir: str) -> DataFrame:
    """The byte-level BPE against the sentencepiece model over all ``documents``."""
    import public_tokenizers

    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))
