"""Rows for the tests of the corpus operators."""

import random

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHING = ("size", "kept", "rank", "node", "key", "seed", "value", "row_key", "component", "signature", "shard", "label",
            "tokens", "digest", "unit", "language", "host", "doc_key", "spans", "ids", "place")
WORDS = ("the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were "
         "all her she there would their we him been has when who will no more if out so up said what its about than into them can only "
         "other time new some could these two may first then do any like my now over such our man me even most made after also did many").split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", "er", "ing", "ly"]) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and white texts, repeats, ties, a long text."""
    base = prose(120, 1)
    words = base.split()
    words[60] = "changed"
    near = " ".join(words)
    return [
        (5, base, "en", "src0", 1), (3, base, "en", "src0", None), (9, base.replace(" ", "  \t"), "en", None, 2), (4, near, None, "src1", 3),
        (None, base, "en", "src0", 4), (None, prose(50, 2), None, None, None), (None, None, None, None, None), (7, None, "en", "src0", 0),
        (8, "", "en", "src0", 0), (10, "  \n ", "de", "src2", 3), (11, "one two", "en", "src0", 7), (12, "one two", "en", "src0", 7),
        (12, "one two", "en", "src0", 7), (13, "Größe und Maß über alles, naïve café ñandú", "de", "src3", 9),
        (14, prose(6000, 3), "en", "src0", 1), (15, "日本語のテキスト 日本語", "xx", "src4", 5), (16, "### 123 %%%", "en", "src0", 5),
        (17, prose(50, 2), "en", "src0", 2), (18, "x" * 3000, "en", "src5", 3000), (20, "<|endoftext|> it's 42", "en", "src0", 1),
    ]
