"""Personal data by offset-preserving deobfuscation.

The plain kinds (e-mail, IP address, card, phone) are found in the source text,
leftmost and non-overlapping for each kind.  Then a transducer rewrites the text
and remembers for each character it emits the source characters it stands for:

* look-alike letters, full-width and mathematical forms, and all decimal digits
  become ASCII; zero-width characters vanish;
* spelled digits beside digits or other spelled ones become digits, "plus"
  before them a plus sign, and bare "dot" between them a dot;
* "(at)", "[dot]", "[.]" and the like become @ and dot;
* bare "at" and "dot" do so in "name dot name at host dot host", also with some
  of them as plain signs, before any top-level domain.  As both are ordinary
  words, names, hosts and domains that are ``ORDINARY`` words don't count, nor
  do web addresses ("site at www.host.com", "at host.com/page").

The same detectors run over the rewritten text, and what they find is mapped
back to source positions.  They run twice, once with only long runs of spelled
digits rewritten, as a number may end before an ordinary "one".  A span inside a
plain one of its kind, or a wider disguised one, adds nothing, nor does a phone
number that has only one spelled digit more than a plain one.  Texts without any
sign of a disguise are not rewritten.

Positions count code points, ends are exclusive.  Time and memory grow with the
length of a text, also for a text that is one run of digits, number words, signs
or spaces.  Null texts count as empty and
have no spans.  Each row is treated by itself, so repeated rows, equal ids and
null ids need no rule.  Extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind string, low long, high long, disguised boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("disguised", pa.bool_())]))

_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# from the first digit of a run on, as a match that fails there fails at its other
# digits too; nothing is given back, as a digit can't be the dot that follows
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
# runs of digits with one sign between them; single digits are too short anyway
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# fixed values: letters that look like an ASCII letter, with that letter
LOOKALIKES = dict(zip("АВЕКМНОРСТХаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ", "ABEKMHOPCTXaeopcyxijsdhqwABEZHIKMNOPTYXovp"))
# fixed values: digits by name
SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
# fixed values: words that are no name, host or domain beside a bare "at" or "dot"
ORDINARY = frozenset((
    "a about after all am an and any are as at available be been before but by call can come could did do does done dot each every find for found from "
    "get go had has have he her here him his how i if in into is it its just know like look looked looking looks make me meet more my new no not now of "
    "off on online only or our out over page see she site so some still than that the their them then there these they this those to too up us very "
    "was we website were what when where which while who will with would you your").split())
LEAST_SPELLED = 7

_DECIMALS = "".join(c for c in map(chr, range(128, 0x110000)) if c.isdecimal())
_FORMS = re.compile("[" + _DECIMALS + " ­​-‍⁠﻿Ͱ-ԯ٠-٩۰-۹०-९"
                    "℀-⅏！-～\U0001d400-\U0001d7ff]")
_NAMES = "|".join(SPELLED)
_BRACKETED_DOT = r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*"
_LONG_RUN = re.compile(rf"\b(?:plus[\s-]+)?(?:{_NAMES})(?:[\s,-]+(?:{_NAMES})){{{LEAST_SPELLED - 1},}}\b", re.IGNORECASE)
_UNIT = rf"(?:(?:{_NAMES})\b|[0-9]+\b)"
_RUN = re.compile(rf"\b(?:plus[\s-]+)?{_UNIT}(?:(?:\s+dot\s+|{_BRACKETED_DOT}|[\s,().-]+){_UNIT})+", re.IGNORECASE)
_PARTS = re.compile(rf"(?P<plus>plus[\s-]+)|(?P<name>{_NAMES})|(?P<digits>[0-9]+)|(?P<gap>[^0-9]+?(?=(?:{_NAMES})\b|[0-9]))", re.IGNORECASE)
_MARKS = re.compile(r"[\[({<]\s*+(?:(?P<at>at|@)|(?P<dot>dot|\.))\s*+[\])}>]\s*+", re.IGNORECASE)
_ADDRESS = re.compile(
    r"(?<![\w.%+-])(?P<local>[\w%+-]+(?:(?:\s+dot\s+|\.)[\w%+-]+){0,31})(?P<at>\s+at\s+|@)(?P<host>[\w-]+(?:(?:\s+dot\s+|\.)[\w-]+){1,126})",
    re.IGNORECASE)
_BARE = re.compile(r"(?P<at>\s+at\s+)|(?P<dot>\s+dot\s+)", re.IGNORECASE)
_LABEL = re.compile(r"(?P<dot>\s+dot\s+|\.)?(?P<label>[\w-]+)", re.IGNORECASE)
_DOMAIN = re.compile(r"[^\W\d_]{2,63}|xn--[\w-]+", re.IGNORECASE)
_BARE_DOT = re.compile(r"\sdot\s")
_BARE_AT = re.compile(r"\sat\s+[\w-]+\.\w")
_SPELLED_NEAR = re.compile(rf"\b(?:{_NAMES})[\s,().-]+(?:[0-9]|(?:{_NAMES})\b)|[0-9][\s,().-]+(?:{_NAMES})\b|\bplus[\s-]+[0-9]")
_BRACKET = re.compile(r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from each @ outwards: a match has
    exactly one, and begins with all the characters before it that may."""
    free, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > free and text[low - 1] in _LOCAL_CHARS:
            low -= 1
        host = _HOST.match(text, at + 1) if low < at else None
        if host:
            yield low, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def detect(text: str) -> list[tuple[str, int, int]]:
    """Plain spans, by start and then kind."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(p) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=_place)


def _place(span: tuple) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


def _plain_form(c: str) -> str:
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if unicodedata.category(c) == "Cf":
        return ""
    digit = unicodedata.digit(c, None) if c.isdigit() else None
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", c)
    return form if form.isascii() else c


class _Transducer:
    """A text under rewriting, and for each of its characters where the source
    characters it stands for begin and end."""

    def __init__(self, text: str):
        self.text, self.lows, self.highs = text, range(len(text)), range(1, len(text) + 1)
        if not text.isascii() and _FORMS.search(text):
            self.replace([(i, i + 1, _plain_form(c)) for i, c in enumerate(text) if _FORMS.match(c)])

    def replace(self, changes: list[tuple[int, int, str]]) -> None:
        """Put a string in the place of each range; ranges in order, not empty."""
        out, lows, highs, at = [], [], [], 0
        for a, b, new in [*changes, (len(self.text), len(self.text), "")]:
            out += (self.text[at:a], new)
            lows += self.lows[at:a]
            highs += self.highs[at:a]
            if new:
                lows += [self.lows[a]] * len(new)
                highs += [self.highs[b - 1]] * len(new)
            at = b
        self.text, self.lows, self.highs = "".join(out), lows, highs


def _numbers(text: str, runs: re.Pattern) -> list[tuple[int, int, str]]:
    """Changes that make digits of the spelled ones in ``runs``."""
    out = []
    for run in runs.finditer(text):
        parts = list(_PARTS.finditer(text, run.start(), run.end()))
        for k, m in enumerate(parts):
            if m.lastgroup == "plus":
                out.append((*m.span(), "+"))
            elif m.lastgroup == "name":
                out.append((*m.span(), SPELLED[m.group().lower()]))
            elif m.lastgroup == "gap":
                sides = [x.lastgroup for x in parts[k - 1:k + 2:2]]
                if "dot" in m.group().lower() or "." in m.group() and "name" in sides:
                    out.append((*m.span(), "."))
                elif "name" in sides:
                    out.append((*m.span(), " " if "digits" in sides else ""))
    return out


def _bracketed(text: str) -> list[tuple[int, int, str]]:
    """Changes that make signs of "at" and "dot" in brackets and the spaces around them."""
    out, free = [], 0
    for m in _MARKS.finditer(text):
        low = m.start()
        while low > free and text[low - 1].isspace():
            low -= 1
        out.append((low, m.end(), "@" if m.lastgroup == "at" else "."))
        free = m.end()
    return out


def _address(m: re.Match) -> int | None:
    """Where the address that begins with a match of ``_ADDRESS`` ends, if it
    is a disguised one."""
    labels = list(_LABEL.finditer(m.string, *m.span("host")))
    while len(labels) > 1:
        last = labels[-1].group("label").lower()
        if _DOMAIN.fullmatch(last) and (len(last) == 2 or last not in ORDINARY):
            break
        labels.pop()
    if len(labels) < 2 or all(x.group("label").lower() in ORDINARY for x in labels[:-1]):
        return None
    end, bare_dot = labels[-1].end(), any(len(x.group("dot") or "") > 1 for x in labels)
    if m.group("at") != "@":
        if m.group("local").lower() in ORDINARY:
            return None
        web = labels[0].group("label").lower() == "www" or m.string[end:end + 1] in ("/", "(") or "\n" in m.group("at")
        return None if web and not bare_dot else end
    return end if bare_dot or re.search(r"\s", m.group("local")) else None


def _addresses(text: str) -> list[tuple[int, int, str]]:
    """Changes that make signs of bare "at" and "dot" in e-mail addresses."""
    out, at = [], 0
    while m := _ADDRESS.search(text, at):
        end = _address(m)
        if end is None:
            at = re.compile(r"[\w%+-]+").match(text, m.start()).end()
            continue
        out += [(*x.span(), "@" if x.lastgroup == "at" else ".") for x in _BARE.finditer(text, m.start(), end)]
        at = end
    return out


def rewrite(text: str, runs: re.Pattern = _RUN) -> tuple[str, list[int], list[int]]:
    """The text without disguises, and for each of its characters where the
    source characters it stands for begin and end."""
    made = _Transducer(text)
    made.replace(_numbers(made.text, runs))
    made.replace(_bracketed(made.text))
    made.replace(_addresses(made.text))
    return made.text, made.lows, made.highs


def disguised(text: str) -> bool:
    """Whether rewriting could change anything."""
    if not text.isascii() and _FORMS.search(text):
        return True
    low = text.lower()
    if "dot" in low and _BARE_DOT.search(low) or any(c in low for c in "[({<") and _BRACKET.search(low):
        return True
    if "at" in low and _BARE_AT.search(low):
        return True
    return any(name in low for name in (*SPELLED, "plus")) and bool(_SPELLED_NEAR.search(low))


def _only_a_word_more(text: str, low: int, high: int, plain: list[tuple[str, int, int]]) -> bool:
    """Whether a span is one of the plain ones, which are in order, and one
    spelled digit."""
    for _, a, b in plain[bisect_left(plain, low, key=lambda x: x[1]):]:
        if a >= high:
            break
        if b <= high and (text[low:a] + text[b:high]).strip(" ,().-\t\n\r").lower() in SPELLED:
            return True
    return False


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans by start and kind; True for those that a disguise hid."""
    base = detect(text)
    hidden = set()
    if disguised(text):
        seen = {text}
        for runs in (_LONG_RUN, _RUN):
            plain, lows, highs = rewrite(text, runs)
            if plain not in seen:
                seen.add(plain)
                hidden |= {(kind, lows[a], highs[b - 1]) for kind, a, b in detect(plain)}
    out, reach = [], dict.fromkeys(KINDS, 0)
    phones = [x for x in base if x[0] == "phone"]
    for kind, low, high, hid in sorted([*((*x, False) for x in base), *((*x, True) for x in hidden)], key=lambda x: (x[1], -x[2], x[3])):
        if hid and (high <= reach[kind] or kind == "phone" and _only_a_word_more(text, low, high, phones)):
            continue
        reach[kind] = max(reach[kind], high)
        out.append((kind, low, high, hid))
    return sorted(out, key=_place)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[dict(zip(("kind", "low", "high", "disguised"), s)) for s in find(t)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _SPAN_TYPE)], ["doc_id", "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(_scan, f"doc_id long, spans {SPANS}"))


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind in brackets;
    overlapping spans become one, named by the first."""
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(text_col).to_pylist():
                out, at = [], 0
                for kind, low, high, _ in find(text) if text else ():
                    if low >= at:
                        out += [text[at:low], f"[{kind.upper()}]"]
                    at = max(at, high)
                texts.append(None if text is None else "".join(out) + text[at:])
            i = batch.schema.get_field_index(text_col)
            yield batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))

    return docs.mapInArrow(mask, docs.schema)


def op8_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in the whole ``documents`` table."""
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: ~s["disguised"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["low"], s["high"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["disguised"])).cast("long").alias("n_disguised"))
