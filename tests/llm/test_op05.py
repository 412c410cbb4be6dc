import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb

from deckframe.llm import op05_template_lines as op

from corpus_rows import FIELDS, odd_rows, prose


def expected(con_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", con_rows)
    return con.execute(op.OP5_SQL).fetchall()


def got(docs):
    return [(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept_text"].encode()).hexdigest())
            for r in op.drop_recurring_lines(docs).collect()]


def test_templates(spark):
    rows = []
    for k in range(30):
        lines = [prose(9, k), f"user {k} logged in from host{k} at 10:{k}", "Copyright all rights reserved worldwide", f"share this page with {prose(1, k)} today please now",
                 "ab cd", "", "Copyright all rights reserved worldwide"]
        if k >= 12:
            lines = [x for x in lines if not x.startswith("user")]
        rows.append((k, "\n".join(lines)))
    docs = spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], FIELDS)
    out = sorted(got(docs))
    assert out == sorted(expected(rows))
    assert [n for _, _, n, _ in out] == [5] * 12 + [4] * 18
    kept = {r["doc_id"]: r["kept_text"] for r in op.drop_recurring_lines(docs).collect()}
    assert kept[3] == prose(9, 3) + "\n" and kept[20] == prose(9, 20) + "\n"


def brute_force(rows):
    """Dropped places of each row, the rules of the module's docstring line by line."""
    lines = [[re.findall("[^ \\t\\n\\x0b\\x0c\\r]+", line) for line in (text or "").split("\n")] for _, text in rows]
    mask = lambda tokens: tuple(op.ANY if re.search("[0-9]", t) else t for t in tokens)
    leaf = lambda tokens: (len(tokens), mask(tokens)[:op.LEAD])
    document = {n: (d, t) if d is not None else t for n, (d, t) in enumerate(rows)}
    held = {(document[n], mask(tokens)) for n, own in enumerate(lines) for tokens in own if tokens}
    fixed = Counter((leaf(m), at, t) for _, m in held for at, t in enumerate(m) if t != op.ANY)
    def template(tokens):
        made = tuple(t if fixed[leaf(tokens), at, t] >= op.MIN_DOCS else op.ANY for at, t in enumerate(mask(tokens)))
        constant = sum(t != op.ANY for t in made)
        known = constant + sum(t == op.ANY for t in mask(tokens))
        return (leaf(tokens), made) if constant >= op.CONSTANT * len(made) and known >= op.KNOWN * len(made) else None
    templates, words = defaultdict(set), defaultdict(set)
    for n, own in enumerate(lines):
        for tokens in filter(None, own):
            templates[template(tokens)].add(document[n])
            words[tuple(tokens)].add(document[n])
    drop = lambda tokens: bool(tokens) and (
        template(tokens) is not None and len(templates[template(tokens)]) >= op.MIN_DOCS
        or len(tokens) >= op.LONG and len(words[tuple(tokens)]) >= op.LONG_DOCS)
    return sorted((d, "\n".join(line for line, tokens in zip((t or "").split("\n"), own) if not drop(tokens)))
                  for (d, t), own in zip(rows, lines))


def test_short_lines_and_long_equal_ones(spark):
    r = random.Random(5)
    pool = ["Les.", "Page 12", "And ornd.", "7", "12 34", "\x0b", " ", "a b", "c d e", *(prose(n, n) for n in (7, 8, 9, 60)), "on 3 May 2001 we said 4 things to 5 people"]
    rows = []
    for d in range(40):
        own = [prose(12, 1000 + d), *(r.sample(pool, 6)), f"Page {d}", f"see {prose(1, d)}"]
        own += [prose(8, 300 + d // 2), prose(8, 400 + d // 3) + " ", "\t" + prose(7, 500 + d // 3)]  # in 2, 3 and 3 documents
        r.shuffle(own)
        rows.append((d, "\n".join(own)))
    docs = spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], FIELDS)
    kept = sorted((x["doc_id"], x["kept_text"]) for x in op.drop_recurring_lines(docs).collect())
    assert kept == brute_force(rows)
    assert sorted(got(docs)) == sorted(expected(rows))
    whole = "\n".join(t for _, t in kept)
    for gone in ("Les.", "Page", "And ornd.", prose(60, 60), prose(8, 400)):
        assert gone not in whole
    for stays in ("\n7\n", "12 34", prose(8, 300), prose(7, 500), prose(12, 1003)):
        assert stays in whole


def test_odd_rows(odd, empty):
    # lines of the long text recur nowhere; repeated rows count once
    assert sorted(got(odd), key=str) == sorted(expected([(d, t) for d, t, *_ in odd_rows()]), key=str)
    assert op.drop_recurring_lines(empty).count() == 0


def test_null_ids_are_documents_of_their_own(spark):
    line = "one two three four"
    rows = [(None, f"{k}|{line}\n{prose(5, k)}") for k in range(5)] + [(k, f"{line}\n{prose(5, k)}") for k in range(5)]
    docs = spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], FIELDS)
    assert sorted(got(docs), key=str) == sorted(expected(rows), key=str)
    assert op._keyed(docs, "doc_id", "text").select("doc_key").distinct().count() == len(rows)


def test_lines_are_split_once_for_each_text(spark):
    docs = spark.createDataFrame([(d, "\n".join([*(f"id {i} was seen here" for i in range(3000)), prose(6, d), prose(7, 50 + d)])) for d in range(12)], "doc_id long, text string")
    out = op.drop_recurring_lines(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "get(split(" not in plan and "array_contains" not in plan, plan
    one = out.select("kept_text")._jdf.queryExecution().optimizedPlan().toString()
    assert "get(split(" not in one, one
    got = {(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()}
    assert got == {(d, 3002, 3000, prose(6, d) + "\n" + prose(7, 50 + d)) for d in range(12)}
