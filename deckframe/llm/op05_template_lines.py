"""Line dedup by a log-template tree, in DataFrame operations only.

1. A line is parsed down a tree of fixed depth: its number of tokens, then its
   first ``LEAD`` tokens, or all it has if they are fewer.  Tokens with a digit
   are variable fields from the start.  A leaf is what agrees on all of these.
2. Leaves that occur in fewer than ``MIN_DOCS`` documents hold nothing that
   recurs; their lines go no further.
3. In the other leaves a token that stands at its place in at least MIN_DOCS
   lines of documents is constant, any other a variable field.  A line's
   template is its tokens with the variable ones generalised.
4. A template recurs if MIN_DOCS documents hold it, at least ``CONSTANT`` of its
   tokens are constant, and with the fields known from the start these are at
   least ``KNOWN`` of them.  All lines with a recurring template are dropped.
5. A line of ``LONG`` tokens or more is a template without fields as well, digits
   and all: such a one recurs if ``LONG_DOCS`` documents hold it word for word, as
   a line of that length is hardly written twice by chance.

Lines end at newlines and tokens at ASCII white space; lines without tokens
stay.  Kept lines are joined by newlines again.
Null texts count as empty: one empty line.  A line that a document repeats counts
once for that document.  Rows that repeat id and text are one document for these
counts, and each loses its lines.  Null ids are told apart by their text.  Empty
tables give empty results; extra columns are ignored.

The first pass keeps only leaves and places, not lines; texts are read again
for the documents that have lines in busy leaves.  All counts are grouped
aggregations over (key, document) first, so a line that a third of all documents
hold is spread over the documents; tokens are counted once for each different
line, weighted by its documents.  Time grows with the lines of a document, also
where all of them recur; a text and its lines must fit into a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

LEAD = 3
MIN_DOCS = 10
CONSTANT = 0.5
KNOWN = 0.75
LONG = 8
LONG_DOCS = 3
ANY = "<*>"
SPACES = "[\\x20\\x09-\\x0D]+"
_MARK = "\u001f"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a null id leaves the part before the bar empty, which no number does
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.lit("|"), text).cast("binary")))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(key, F.lit(b"")).alias("doc_key"))


def _documents(rows: DataFrame, *by: str, least: int = MIN_DOCS) -> DataFrame:
    """``by`` of at least ``least`` documents."""
    return (rows.select(*by, "doc_key").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") >= least).drop("__n"))


def _masked(tokens):
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), ANY).otherwise(t))


def _parsed(lines: DataFrame) -> DataFrame:
    """Adds ``tokens`` and ``leaf`` to lines that have tokens."""
    trimmed = F.btrim("line", F.lit(" \t\n\x0b\x0c\r"))
    return (lines.where(trimmed != "").withColumn("tokens", F.split(trimmed, SPACES))
            .withColumn("leaf", F.concat_ws(_MARK, F.size("tokens"), _masked(F.slice("tokens", 1, LEAD)))))


def recurring_lines(texts: DataFrame) -> DataFrame:
    """(doc_key, gone): places of the lines to drop, for each document that has any."""
    every = texts.select("doc_key", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    words = F.when(F.size("tokens") >= LONG, F.unhex(F.md5(F.array_join("tokens", " ").cast("binary"))))
    leaves = staged(_parsed(every).select("doc_key", "place", "leaf", words.alias("words")), "leaves")
    long = leaves.where("words IS NOT NULL")
    same = long.join(_documents(long, "words", least=LONG_DOCS), "words").select("doc_key", "place")
    asked = (leaves.join(_documents(leaves, "leaf"), "leaf").groupBy("doc_key")
             .agg(F.collect_set("place").alias("places")))
    # the asked lines are taken by their place, so a document costs its lines and these places
    again = (texts.join(asked, "doc_key").select("doc_key", "places", F.split("text", "\n").alias("lines"))
             .select("doc_key", F.inline(F.transform("places", lambda p: F.struct(p.alias("place"), F.get("lines", p).alias("line"))))))
    held = staged(_parsed(again).select("doc_key", "place", "leaf", F.array_join(_masked("tokens"), _MARK).alias("line")), "lines")
    once = held.select("leaf", "line", "doc_key").distinct()
    different = staged(once.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n")), "different")
    tokens = different.select("*", F.posexplode(F.split("line", _MARK)).alias("at", "token"))
    constant = (tokens.where(F.col("token") != ANY).groupBy("leaf", "at", "token").agg(F.sum("n").alias("lines"))
                .where(F.col("lines") >= MIN_DOCS).select("leaf", "at", "token", F.lit(True).alias("fixed")))
    known = tokens.join(constant, ["leaf", "at", "token"], "left")
    template = known.groupBy("leaf", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.when(F.col("fixed"), F.col("token")).otherwise(ANY).alias("token")))),
                                 lambda x: x["token"]), _MARK).alias("template"),
        F.avg(F.coalesce("fixed", F.lit(False)).cast("int")).alias("constant"),
        F.avg((F.coalesce("fixed", F.lit(False)) | (F.col("token") == ANY)).cast("int")).alias("known"))
    template = staged(template.where((F.col("constant") >= CONSTANT) & (F.col("known") >= KNOWN)).drop("constant", "known"), "templates")
    recurs = _documents(held.join(template, ["leaf", "line"]), "leaf", "template")
    gone = template.join(recurs, ["leaf", "template"]).select("leaf", "line")
    return held.join(gone, ["leaf", "line"]).select("doc_key", "place").union(same).groupBy("doc_key").agg(F.collect_set("place").alias("gone"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every row."""
    texts = _keyed(docs, id_col, text_col)
    # "lines" is used more than once below, so the optimizer leaves the split where it is
    marked = texts.join(recurring_lines(texts), "doc_key", "left").select(
        "doc_id", F.split("text", "\n").alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")   # by a hash set
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    return marked.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept_text"))


def op5_template_lines(spark, sf_dir: str) -> DataFrame:
    """What recurring templates take from each row of ``documents``."""
    out = drop_recurring_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT row_no, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
parsed AS (
    SELECT row_no, place, line,
           list_transform(list_filter(regexp_split_to_array(line, '{SPACES}'), lambda t: t <> ''),
                          lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{ANY}' ELSE t END) AS tokens
    FROM lines),
leaves AS (
    SELECT row_no, place, tokens, len(tokens)::VARCHAR || chr(31) || array_to_string(tokens[1:{LEAD}], chr(31)) AS leaf
    FROM parsed WHERE len(tokens) > 0),
worded AS (
    SELECT row_no, place, trim(regexp_replace(line, '{SPACES}', ' ', 'g')) AS said FROM parsed WHERE len(tokens) >= {LONG}),
said_again AS (SELECT said FROM worded GROUP BY said HAVING count(DISTINCT row_no) >= {LONG_DOCS}),
busy AS (SELECT leaf FROM leaves GROUP BY leaf HAVING count(DISTINCT row_no) >= {MIN_DOCS}),
held AS (SELECT * FROM leaves WHERE leaf IN (SELECT leaf FROM busy)),
spread AS (SELECT row_no, place, leaf, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot FROM held),
constants AS (
    SELECT leaf, spot, token
    FROM (SELECT leaf, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot FROM (SELECT DISTINCT row_no, leaf, tokens FROM held))
    WHERE token <> '{ANY}' GROUP BY leaf, spot, token HAVING count(*) >= {MIN_DOCS}),
templates AS (
    SELECT row_no, place, leaf, avg((c.token IS NOT NULL)::INT) AS constant, avg((c.token IS NOT NULL OR s.token = '{ANY}')::INT) AS known,
           string_agg(coalesce(c.token, '{ANY}'), chr(31) ORDER BY spot) AS template
    FROM spread s LEFT JOIN constants c USING (leaf, spot, token) GROUP BY row_no, place, leaf),
recurring AS (
    SELECT leaf, template FROM templates WHERE constant >= {CONSTANT} AND known >= {KNOWN}
    GROUP BY leaf, template HAVING count(DISTINCT row_no) >= {MIN_DOCS}),
gone AS (
    SELECT row_no, place FROM templates JOIN recurring USING (leaf, template) WHERE constant >= {CONSTANT} AND known >= {KNOWN}
    UNION SELECT row_no, place FROM worded WHERE said IN (SELECT said FROM said_again))
SELECT doc_id, count(*) AS n_lines, count(g.place) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE g.place IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN gone g USING (row_no, place)
GROUP BY row_no, doc_id
"""
