import random
from itertools import combinations_with_replacement
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from deckframe.llm import op04_best_fit_pack as op
from deckframe.llm import tokens
from deckframe.llm.staging import staged

from corpus_rows import odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def encode(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(20))
def test_plan_uses_every_piece_once(seed):
    r = random.Random(seed)
    capacity = r.choice([8, 30, 200])
    histogram = {r.randint(1, capacity): r.randint(1, 60) for _ in range(r.randint(1, capacity))}
    made = op.plan(histogram, capacity)
    used = {}
    for lengths, n in made:
        assert sum(lengths) <= capacity and n > 0
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == histogram
    total = sum(k * n for k, n in histogram.items())
    assert sum(n for _, n in made) <= 1.23 * -(-total // capacity) + sum(n for k, n in histogram.items() if 2 * k > capacity)


def test_complements_are_found_whenever_there_are_any():
    r = random.Random(1)
    for _ in range(200):
        counts = np.zeros(31, np.int64)
        for _ in range(6):
            counts[r.randint(1, 20)] += r.randint(1, 3)
        index = op.SumIndex(counts)
        length = max(np.flatnonzero(counts))
        gap = 30 - length
        def fits(c):
            own = [*c, length]
            return sum(c) == gap and all(counts[x] >= own.count(x) for x in own)
        possible = any(fits(c) for n in (1, 2, 3) for c in combinations_with_replacement(range(1, length + 1), n))
        got = index.complement(int(length), 30)
        assert (got is not None) == possible and (got is None or fits(got))


def test_packed_documents(odd, empty):
    cut = staged(op.pieces(odd, PATH, capacity=256), "test")
    rows = op.pack(cut, 256).collect()
    expected = []
    for d, t, *_ in odd_rows():
        ids = encode(t) + [0]
        expected += [(d, k, at, len(ids[at:at + 256]), crc32(np.array(ids[at:at + 256], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 256))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == sorted(expected, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for own in sequences.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    built = {r["sequence_id"]: bytes(r["ids"]) for r in op.sequences(op.pack(cut, 256)).collect()}
    assert sorted(built.values()) == sorted(b"".join(x for *_, x in sorted(own)) for own in sequences.values())
    none = staged(op.pieces(empty, PATH), "test")
    assert op.pack(none).count() == 0


def test_cached_ids_equal_the_library(monkeypatch):
    r = random.Random(0)
    texts = ["it's don't I'LL 'd ''s !!'s x's's", "İstanbul ŉ ǅ", "á b c \x1c d²³ ½ µ ªº", "<|endoftext|> hi", "", "   ", "日本語 テキスト",
             "Ελλάς ΣΑΣ", "ß ẞ ÿ Ÿ ŉ ſ", "x" * 500, "9876 a1b2 _-_"]
    texts += ["".join(r.choice("abS'tldmvr 0é!ÀŸſ<|>\n_") for _ in range(r.randint(0, 20))) for _ in range(3000)]
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 1500)
    own = tokens.Encoder(PATH)
    whole = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for text, a, b in zip(texts, own.encode(texts), whole):
        assert np.frombuffer(a, "<u4").tolist() == b.ids, text
