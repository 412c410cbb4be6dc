import hashlib
import random
import re
import time

from deckframe.llm import op08_pii as op

from corpus_rows import FIELDS, odd_rows

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = sum(d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and doubled % 10 == 0
    return True


def brute(text):
    out = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if valid(k, m.group())]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def test_plain_kinds_against_their_patterns():
    r = random.Random(3)
    parts = ["4111111111111111", "+1 (555) 010-9999", "10.0.0.1", "300.1.1.1.1", "a.b@c-d.e", "@", ".", " ", "-", "+", "x", "7", "4111 1111-1111 1111", "é", "\n"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert op.detect(text) == brute(text), text


def test_long_runs_take_linear_time():
    n = 400_000
    for text, spans in ((n * "1", 0), (n // 4 * "one ", 0), (n // 2 * "1.", None), (n // 2 * "1 ", 0), (n // 2 * "1-", 0), (n * " " + "(at)", 0),
                        ("a (at)" + n * " " + "b", 0), (n // 2 * "( ", 0), ("[dot]" + n // 2 * " (", 0), (n * "a" + "@", 0), (n // 2 * "a@", 0),
                        ("+1" + n * "(", 0), (n // 4 * "dot ", 0), ("x dot y" + n * "z", 0), (n // 5 * "a at ", 0), (n // 6 * "a dot ", 0),
                        ("one" + n * " ", 0), ("one two" + n * ",", 0), (n // 2 * "é٣", 0)):
        began = time.process_time()
        found = op.find(text)
        assert time.process_time() - began < 15, text[:12]   # a quadratic search takes hours
        assert spans is None or len(found) == spans, (text[:12], found[:3])


def test_brackets_take_the_spaces_around_them():
    r = random.Random(4)
    old = re.compile(r"(?P<at>\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*)|(?P<dot>\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*)", re.IGNORECASE)
    for _ in range(20000):
        text = "".join(r.choice(["(", ")", "[", ">", " ", "\u2003", "\n", "at", "AT", "@", "dot", ".", "x"]) for _ in range(r.randint(0, 14)))
        assert op._bracketed(text) == [(*m.span(), "@" if m.lastgroup == "at" else ".") for m in old.finditer(text)], text


def hidden(text):
    return [(k, text[a:b]) for k, a, b, d in op.find(text) if d]


def test_disguises_map_back_to_the_source():
    assert hidden("mail bob (at) host [dot] com now") == [("email", "bob (at) host [dot] com")]
    assert hidden("to bob.x at mail dot example dot com.") == [("email", "bob.x at mail dot example dot com")]
    assert hidden("ｂob＠host.com") == [("email", "ｂob＠host.com")]
    assert hidden("bоb@host.com")[0] == ("email", "bоb@host.com")
    assert hidden("plus one two three four five six seven eight nine zero one") == [("phone", "plus one two three four five six seven eight nine zero one")]
    assert hidden("192[.]168[.]1[.]1") == [("ip", "192[.]168[.]1[.]1")]
    assert hidden("four" + " one" * 15) == [("card", "four" + " one" * 15)]
    assert hidden("x​@​host.com") == [("email", "x​@​host.com")]
    assert hidden("look at this dot and that, one or two at a time") == []
    assert op.find("a@b.com") == [("email", 0, 7, False)]


def test_odd_rows(spark, odd, empty):
    got = {(r["doc_id"], tuple((s["kind"], s["low"], s["high"]) for s in r["spans"] if not s["disguised"])) for r in op.find_pii(odd).collect()}
    assert got == {(d, tuple(brute(t or ""))) for d, t, *_ in odd_rows()}
    assert op.find_pii(empty).count() == 0
    masked = op.mask_pii(spark.createDataFrame([(1, "hi a@b.com and 10.0.0.1", "en", None, 0), (2, None, None, None, 0)], FIELDS))
    assert [r["text"] for r in masked.orderBy("doc_id").collect()] == ["hi [EMAIL] and [IP]", None]


def test_query_columns(spark, tmp_path):
    text = "a@b.com 10.0.0.1 +1 (555) 010-9999 bob (at) host [dot] com"
    spark.createDataFrame([(1, text, None, None, 0)], FIELDS).write.parquet(str(tmp_path / "documents.parquet"))
    row = op.op8_pii(spark, str(tmp_path)).first()
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
    assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and row["spans"] == base + f",email:{text.index('bob')}:{len(text)}"
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"], row["n_disguised"]) == (1, 1, 0, 1, 1)


def test_bare_words_in_addresses_and_partly_spelled_numbers():
    for kind, text in [
            ("email", "john dot doe at example dot com"), ("email", "jane at example dot ch"), ("email", "jane at example dot at"),
            ("email", "jane at example dot museum"), ("email", "jane@example dot com"), ("email", "jane at example.com"), ("email", "jane dot roe@example.it"),
            ("email", "jane dot roe (at) mail dot example [dot] be"), ("email", "jane at example dot one"), ("ip", "192 dot 168 dot 10 dot 1"),
            ("ip", "one nine two dot one six eight dot one dot one"), ("ip", "10 [dot] 0 dot zero.1"), ("phone", "+1 555 five five five 0123"),
            ("phone", "plus 1 (five five five) 010-9999"), ("card", "4111 1111 one one one one, 1111"),
            ("card", "৪১১১ ১১১১ ১১১১ ১১১১"), ("ip", "๑๐.๐.๐.๑")]:
        for around in ("{}", "write to {}, please", "so: {}\n\nNext."):
            assert hidden(around.format(text)) == [(kind, text)], text
    for text in ("look at the dot in the middle", "see us at example.com", "the site at www.example.com", "we met at noon.The next day", "error\n\tat java.lang.String",
                 "version one dot two dot three", "one two three, four 5", "one at a time dot and so on", "256 dot 1 dot 1 dot 1", "at 300 dot 400", "a read at host.com/page"):
        assert op.find(text) == [], text
    assert hidden("call +1 555 010 9999 one more time, or 10.0.0.1 two times") == []
    assert hidden("192 dot 168 dot 10 dot 1 two hosts") == [("ip", "192 dot 168 dot 10 dot 1")]
    assert hidden("４１１１ １１１１ １１１１ １１１１ one day") == [("card", "４１１１ １１１１ １１１１ １１１１")]
