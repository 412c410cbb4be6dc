"""Token ids of whole texts by the ``tokenizers`` library, with a word cache.

Encoding a whole text spends most of its time on words seen before.  Where it
is certain that the vocabulary file's rules treat each piece of a text on its
own, pieces are looked up in a cache and only new ones are encoded:

* the rules fold white space, lower-case, split into letter runs, single digits
  and runs of anything else, and merge inside such a piece;
* for texts of ASCII and the letters below, composition (NFC) changes nothing
  and lower-casing is letter by letter, so the same pieces are found here.

A new piece goes straight to the library's merge model.  Any other text, one
that may hold a special token's string, and every text where the vocabulary
file has other rules, is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

CACHE_PIECES = 600_000
CACHE_WORDS = 300_000
LONGEST_WORD = 64
# fixed values: characters of texts that may go piece by piece
_OTHER = re.compile("[^\t-\r -~À-ÖØ-öø-įı-ňŊ-ž]|<\\|")
_PIECE = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")
# fixed values: the rules under which texts may go piece by piece
_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
_LOADED: dict[str, Encoder] = {}


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        rules = json.loads(self.tokenizer.to_str())
        self.by_piece = {k: rules[k] for k in _RULES} == _RULES and rules["model"]["type"] == "BPE"
        self.letters = _byte_letters()
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Keep the ids of new pieces."""
        if len(self.pieces) + len(pieces) > CACHE_PIECES:
            self.pieces.clear()
        merge, letters = self.tokenizer.model.tokenize, self.letters
        for piece in pieces:
            text = piece.decode() if piece.isalnum() else "".join([letters[b] for b in piece])
            self.pieces[piece] = array("I", [t.id for t in merge(text)]).tobytes()

    def _new_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that aren't kept yet; short ones are kept from now on."""
        split = {w: _PIECE.findall(w) for w in words}
        unknown = {p for own in split.values() for p in own if p not in self.pieces}
        if unknown:
            self._learn(list(unknown))
            lost = {p for own in split.values() for p in own if p not in self.pieces}
            if lost:  # the pieces were cleared meanwhile
                self._learn(list(lost))
        found = {w: b"".join([self.pieces[p] for p in own]) for w, own in split.items()}
        if len(self.words) + len(found) > CACHE_WORDS:
            self.words.clear()
        self.words.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_WORD)
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for i in range(0, len(texts), 16):
            some = texts[i:i + 16]
            plain = [None if not self.by_piece or _OTHER.search(t) else t.lower().encode().split() for t in some]
            new = {w for words in plain if words for w in words if w not in self.words}
            fresh = self._new_words(list(new)) if new else {}
            for text, words in zip(some, plain):
                if words is None:
                    yield np.array(self._whole([text])[0], "<u4").tobytes()
                    continue
                ids = list(map(self.words.get, words))
                if None in ids:  # long words, and those cleared meanwhile
                    lost = [w for w, x in zip(words, ids) if x is None and w not in fresh]
                    if lost:
                        fresh.update(self._new_words(lost))
                    ids = [fresh[w] if x is None else x for w, x in zip(words, ids)]
                yield b"".join(ids)


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary in a worker, so that its cache lives on
    from task to task."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
