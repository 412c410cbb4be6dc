from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from deckframe.llm import op06_arrow_tokens as op
from deckframe.llm.staging import fresh_path

from corpus_rows import odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_round_trip(spark, odd, empty):
    tokenizer = Tokenizer.from_file(PATH)
    at, expected = 0, []
    for d, t, *_ in sorted(odd_rows(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((d, at, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    manifest = op.write_tokens(odd, fresh_path(spark, "test"), PATH, 3, length=64)
    assert sorted((tuple(r) for r in op.read_tokens(manifest).collect()), key=lambda x: x[1]) == expected
    assert op.read_tokens(op.write_tokens(empty, fresh_path(spark, "test"), PATH, 3)).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_random_access_without_copies(tmp_path, wide):
    ids = np.arange(64 * 300 + 17, dtype="<u4") * (5 if wide else 1)
    with open(tmp_path / "x.arrow", "wb") as f:
        out = op.TokenWriter(f, 64, wide)
        for part in np.array_split(ids, 37):
            out.add(part.tobytes())
        out.close()
    before = pa.total_allocated_bytes()
    file = op.TokenFile(op.open_source(str(tmp_path / "x.arrow")))
    assert (file.sequence(299) == ids[64 * 299:64 * 300]).all() and file.mask(300).true_count == 17
    assert (file.sequence(7) == ids[64 * 7:64 * 8]).all() and (file.span(100, 1000) == ids[100:1100]).all()
    assert pa.total_allocated_bytes() - before < 4096  # rows are views of the mapped file
