"""Language identification by Bayesian evidence fusion.

The posterior of each language sums up, as logarithms:

* text: counts of hashed byte trigrams against each language's distribution,
  weighted by ``TEXT_WEIGHT`` as neighbouring trigrams aren't independent;
* markup: P(declared language | language);
* address: P(suffix | language);
* host: P(language | host), smoothed towards the host's domain, which is
  smoothed towards the whole table.

The languages are ``LANGUAGES`` and every other label of ``LEAST_ROWS`` rows or
more: with fewer the trigrams of a language are hardly known, and its
distribution is too near that of ``und``.  Labels and declared languages count
by their first part, in lower case ("en-US" and "en_GB" are "en"), and only if
that is a code of two to eight letters that names one language.  A row that
declares a language with fewer rows (a code of ``TWO_LETTERS`` or of three
letters) is in that language where none of the others explains its text: it
gets that code instead of ``und``, and stays.

The trigram model is counted over all rows with such a label.  The other tables are
counted over all rows by grouped aggregation, with the language that the text
alone suggests; a row's own share counts only through the smoothing.  An extra
class ``und`` stands for text in no known language: each trigram is equally
likely.  A row is kept unless ``und`` has the best posterior or the text has no
letter at all.  Of equal posteriors the first in alphabetical order wins, ``und``
last.  ``probability`` is that of the best class, also where a rare code stands
for ``und``.

Missing evidence (null or empty) contributes nothing.  Null texts count as
empty.  Rows are scored one by one, so repeated rows, equal ids and null ids need
no rule.  With no labelled rows all is ``und``.  Empty tables give empty
results; extra columns pass through ``identify`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import runs, utf8
from .staging import staged

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
NO_LANGUAGE = (UNKNOWN, "mis", "mul", "zxx")  # codes of no single language
LEAST_ROWS = 20
# fixed values: the two-letter language codes
TWO_LETTERS = tuple("""
aa ab ae af ak am an ar as av ay az ba be bg bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz
ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii
ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi
mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw
sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk
ur uz ve vi vo wa wo xh yi yo za zh zu
""".split())
BUCKETS = 1 << 12
TEXT_WEIGHT = 0.3
UNKNOWN_PRIOR = 0.001
HOST_WEIGHT = 20.0
DOMAIN_WEIGHT = 100.0
SMOOTHING = 1.0
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[ord("A"):ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_WORDLIKE = _LETTER.copy()
_WORDLIKE[[0x20, *range(0x09, 0x0E)]] = True


def trigram_buckets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that begins at each byte of a run of documents;
    BUCKETS where it crosses the end of a document or holds anything but
    letters, parts of letters and white space."""
    c, fits = _FOLD[data], _WORDLIKE[data]
    out = np.full(len(c), BUCKETS, np.int64)
    if len(c) > 2:
        code = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
        out[:-2] = np.where(fits[:-2] & fits[1:-1] & fits[2:], (code * np.uint32(0x9E3779B1)) >> np.uint32(20), BUCKETS)
    for back in (1, 2):
        at = offsets[1:] - back
        out[at[at >= offsets[:-1]]] = BUCKETS
    return out


def text_model(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Log probability of each bucket (rows) in each language (columns) and
    in ``und``; the last row, for no trigram, is nought.  ``rows``: (label, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS + 1), np.int64)
        place = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            label = np.array([place.get(x, -1) for x in batch.column("label").to_pylist()], np.int64)
            data, offsets = utf8(batch.column("text"))
            for a, b in runs(offsets):
                at = offsets[a:b + 1] - offsets[a]
                bucket = trigram_buckets(data[offsets[a]:offsets[b]], at)
                who = np.repeat(label[a:b], np.diff(at))
                known = who >= 0
                total += np.bincount(who[known] * (BUCKETS + 1) + bucket[known], minlength=total.size).reshape(total.shape)
        language, bucket = np.nonzero(total[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(language), pa.array(bucket), pa.array(total[language, bucket])], ["language", "bucket", "n"])

    sums = (rows.select("label", "text").mapInArrow(count, "language long, bucket long, n long")
            .groupBy("language", "bucket").agg(F.sum("n").alias("n")).collect())  # at most languages x BUCKETS rows
    table = np.full((BUCKETS + 1, len(languages) + 1), 0.5)
    seen = np.zeros(len(languages) + 1, bool)
    for r in sums:
        table[r["bucket"], r["language"]] += r["n"]
        seen[r["language"]] = True
    table[BUCKETS] = 0
    model = np.log(table / table.sum(axis=0), where=table > 0, out=np.zeros_like(table))
    model[:BUCKETS, ~seen] = -np.inf  # languages without a labelled row
    model[:BUCKETS, -1] = -np.log(BUCKETS)
    return model


def _score(rows: DataFrame, model: np.ndarray, languages: tuple[str, ...]) -> DataFrame:
    """Adds ``text_score``: the log likelihoods, and ``n_letters``, the bytes of letters."""
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    kept = [f for f in rows.schema if f.name != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            parts, counts = [], []
            for a, b in runs(offsets):
                at = offsets[a:b + 1] - offsets[a]
                bucket = trigram_buckets(data[offsets[a]:offsets[b]], at)
                bounds = np.append(at[:-1], len(bucket))
                letters = _LETTER[data[offsets[a]:offsets[b]]]
                counts.append(np.diff(np.append(0, np.cumsum(letters))[at]))
                sums = np.zeros((b - a, len(table)))
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    for k, logs in enumerate(table):
                        sums[full, k] = np.add.reduceat(logs[bucket], bounds[full])
                parts.append(sums)
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(table)), pa.array(flat))
            n = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), lists, n], [*(f.name for f in kept), "text_score", "n_letters"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(score, f"{fields}, text_score array<double>, n_letters long")


def _code(column):
    """The first part of a language tag, in lower case."""
    return F.regexp_extract(F.lower(F.trim(column)), "^[^-_]*", 0)


def _best(scores: str, classes: tuple[str, ...]):
    return F.element_at(F.array(*map(F.lit, classes)), F.array_position(scores, F.array_max(scores)).cast("int"))


def _given_language(scored: DataFrame, column: str, classes: tuple[str, ...]) -> DataFrame:
    """(column, log P(column | language)): smoothed over the values seen."""
    pairs = scored.where(F.col(column).isNotNull()).groupBy(column, "by_text").agg(F.count(F.lit(1)).alias("n"))
    # named unlike any language
    wide = pairs.withColumnRenamed(column, "__value").groupBy("__value").pivot("by_text", list(classes)).agg(F.sum("n")).na.fill(0, list(classes))
    total = wide.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in classes), F.count(F.lit(1)).alias("__values")).first()
    share = [F.log((F.col(c) + SMOOTHING) / (total[c] + SMOOTHING * total["__values"])) for c in classes]
    return wide.select(F.col("__value").alias(column), F.array(*share).alias(f"{column}_score"))


def _host_prior(scored: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    """(host, log P(language | host)), smoothed by domain and by all rows."""
    count = lambda *by: (scored.where("host IS NOT NULL").groupBy(*by).agg(
        *(F.sum((F.col("by_text") == c).cast("long")).alias(f"{by[-1]}_{c}" if by else f"all_{c}") for c in classes),
        F.count(F.lit(1)).alias(f"{by[-1]}_n" if by else "all_n")))
    total = count().first()
    overall = lambda c: ((total[f"all_{c}"] or 0) + SMOOTHING) / (total["all_n"] + SMOOTHING * len(classes))
    domain = lambda c: (F.col(f"domain_{c}") + DOMAIN_WEIGHT * overall(c)) / (F.col("domain_n") + DOMAIN_WEIGHT)
    host = lambda c: (F.col(f"host_{c}") + HOST_WEIGHT * domain(c)) / (F.col("host_n") + HOST_WEIGHT)
    return (count("domain", "host").join(count("domain"), "domain")
            .select("domain", "host", F.array(*(F.log(host(c)) for c in classes)).alias("host_score")))


def identify(rows: DataFrame, model: np.ndarray, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Adds ``language``, ``probability`` and ``kept`` to ``rows`` (text,
    declared, suffix, host, others), without the text."""
    classes = (*languages, UNKNOWN)
    empty = lambda c: F.when(F.trim(c) != "", F.lower(F.trim(c)))
    rows = (rows.withColumn("declared", _code(empty("declared"))).withColumn("suffix", empty("suffix"))
            .withColumn("host", empty("host"))
            .withColumn("domain", F.when(F.col("host").isNotNull(), F.substring_index("host", ".", -2))))
    scored = _score(rows, model, languages).withColumn(
        "text_score", F.transform("text_score", lambda x: x * TEXT_WEIGHT))
    scored = staged(scored.withColumn("by_text", F.when(F.col("n_letters") == 0, UNKNOWN).otherwise(_best("text_score", classes))), "scored")
    nothing = F.array(*[F.lit(0.0)] * len(classes))
    prior = F.array(*[F.lit(float(np.log((1 - UNKNOWN_PRIOR) / len(languages))))] * len(languages), F.lit(float(np.log(UNKNOWN_PRIOR))))
    # stored first: small tables are then broadcast, and rows of a host that very
    # many rows share can be split in the join
    declared, suffix = (staged(_given_language(scored, c, classes), f"given-{c}") for c in ("declared", "suffix"))
    hosts = staged(_host_prior(scored, classes), "hosts")
    joined = (scored.join(declared, "declared", "left").join(suffix, "suffix", "left")
              .join(hosts, ["domain", "host"], "left"))
    posterior = F.col("text_score")
    for part in (prior, F.coalesce("declared_score", nothing), F.coalesce("suffix_score", nothing), F.coalesce("host_score", nothing)):
        posterior = F.zip_with(posterior, part, lambda a, b: a + b)
    joined = joined.withColumn("posterior", posterior)
    norm = F.aggregate(F.transform("posterior", lambda x: F.exp(x - F.array_max("posterior"))), F.lit(0.0), lambda a, x: a + x)
    best = _best("posterior", classes)
    rare = ((F.col("declared").isin(*TWO_LETTERS) | F.col("declared").rlike("^[a-z]{3}$")) & ~F.col("declared").isin(*languages, *NO_LANGUAGE))
    language = F.when(F.col("n_letters") == 0, UNKNOWN).when((best == UNKNOWN) & rare, F.col("declared")).otherwise(best)
    return (joined.withColumn("language", language).withColumn("probability", 1 / norm)
            .withColumn("kept", F.col("language") != UNKNOWN)
            .drop("text_score", "n_letters", "by_text", "declared_score", "suffix_score", "host_score", "posterior", "domain"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence of ``documents``: the column ``lang`` as declared language and
    ``source`` as host; there is no address."""
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"),
                       F.coalesce("text", F.lit("")).alias("text"), F.col("lang").alias("declared"),
                       F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of ``pages``: the visible text, the ``lang`` attribute, and
    host and suffix of the address."""
    html = F.coalesce("html", F.lit(""))
    visible = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z]+;|&#x?[0-9a-f]+;", " ")
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return pages.select(F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
                        visible.alias("text"), F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1).alias("declared"),
                        F.when(host.contains("."), F.substring_index(host, ".", -1)).alias("suffix"), host.alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``documents`` without rows in no known language, all columns unchanged."""
    languages = languages_of(docs)
    model = text_model(_labelled(docs), languages)
    evidence = document_evidence(docs).withColumn("doc_key", F.unhex(F.md5(F.col("text").cast("binary"))))
    # stored first: its size is then known, and a short list spares the texts a shuffle
    bad = staged(identify(evidence, model, languages).where("NOT kept").select(
        F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")).distinct(), "rejected")
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left_anti")


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.where("lang IS NOT NULL AND text IS NOT NULL").select(_code("lang").alias("label"), "text")


def languages_of(docs: DataFrame) -> tuple[str, ...]:
    """``LANGUAGES`` and the other labels with rows enough, in order."""
    label = F.col("label")
    counts = (docs.where("lang IS NOT NULL").groupBy(_code("lang").alias("label")).agg(F.count(F.lit(1)).alias("n"))
              .where(label.rlike("^[a-z]{2,8}$") & ~label.isin(*NO_LANGUAGE) & (F.col("n") >= LEAST_ROWS)))
    return tuple(sorted({*LANGUAGES, *(r["label"] for r in counts.collect())}))


def op9_language_fusion(spark, sf_dir: str) -> DataFrame:
    """Languages of all rows of ``documents`` and ``pages``."""
    docs, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "pages"))
    languages = languages_of(docs)
    model = text_model(_labelled(docs), languages)
    return identify(document_evidence(docs).unionByName(page_evidence(pages)), model, languages)
