"""Queries of the training-data operators: name -> fn(spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import divergence, itq, lines, lm, packing, phrases, pieces, pii, quality_model, rules, secrets, simhash, toxicity
from murmur.llm.common import fold, kept_by_worker, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, at most 2 bits apart."""
    g = simhash.simhash_groups(table(spark, sf_dir, "documents"), width=3, max_bits=2)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def packed(docs: DataFrame, words: int = 1_000_000) -> DataFrame:
    """Windows of 2048 ids of the word vocabulary, with the digest of each piece. A worker remembers ``words`` words."""
    path = public_tokenizers.path("word_bpe_49k.json")
    p = packing.pack(docs, lambda: kept_by_worker(("packing", path, words), lambda: packing.word_encoder(path, words)), size=2048, end_id=1)
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens."""
    return packed(table(spark, sf_dir, "documents"))


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the quality rules on all documents; cutoffs per language from the labels."""
    return rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted-interpolation scores of all documents; a fifth of them, by id, is not learned from, another fifth gives the events
    for the weights."""
    out = lm.lm_scores(table(spark, sf_dir, "documents"), train=fold(F.col("doc_id")) != 1, retained=fold(F.col("doc_id")) != 0)
    return out.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; a fifth of them, by id, is not learned from."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), learn=fold(F.col("doc_id")) != 0)
    out = quality_model.quality_scores(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces with a tenth of the merges dropped, and whether decoding gives the text back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.encode_pieces(table(spark, sf_dir, "documents"), path, rate=0.1, seed=1, variants=4)
    return out.select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), "lossless")


@register
def op8_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings at a cosine of 0.9 or more."""
    return itq.vector_links(table(spark, sf_dir, "embeddings"), threshold=0.9)


@register
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without runs of lines of 50 words or more that occur earlier."""
    out, info = lines.dedup_lines(table(spark, sf_dir, "documents"), min_words=50)
    return out.select("doc_id", F.col(f"{info}.n_lines").alias("n_lines"), F.col(f"{info}.n_deleted").alias("n_deleted"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


ORACLE["op9_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM split),
placed AS (
  SELECT doc_id, i, line, w, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM counted WHERE w > 0),
found AS (
  SELECT doc_id, min(i) OVER f AS i, max(i) OVER f AS j, sum(w) OVER f AS n, list(line) OVER f AS run
  FROM (SELECT *, e - w AS s FROM placed)
  WINDOW f AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, min(i) OVER f, max(i) OVER f, sum(w) OVER f, list(line) OVER f
  FROM placed
  WINDOW f AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
firsts AS (
  SELECT doc_id, i, j, min({'d': doc_id, 'i': i}) OVER (PARTITION BY array_to_string(run, chr(10))) AS low FROM found WHERE n >= 50),
later AS (SELECT DISTINCT doc_id, i, j FROM firsts WHERE doc_id > low.d OR doc_id = low.d AND i > low.i),
numbered AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS o FROM placed),
hit AS (
  SELECT DISTINCT p.doc_id, p.i, p.o FROM numbered p JOIN later l ON p.doc_id = l.doc_id AND p.i BETWEEN l.i AND l.j),
islands AS (
  SELECT doc_id, min(i) AS i, max(i) AS j
  FROM (SELECT *, o - row_number() OVER (PARTITION BY doc_id ORDER BY o) AS g FROM hit) GROUP BY doc_id, g),
gone AS (SELECT DISTINCT s.doc_id, s.i FROM split s JOIN islands l ON s.doc_id = l.doc_id AND s.i BETWEEN l.i AND l.j),
kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) AS text, count(*) AS n
  FROM split s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(k.n, 0) END AS n_deleted,
       sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@register
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: base patterns and linked weak parts."""
    return secrets.digest(secrets.secret_spans(table(spark, sf_dir, "documents")))


@register
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base patterns and candidates accepted by boosted trees."""
    return pii.digest(pii.pii_spans(table(spark, sf_dir, "documents")))


@register
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of 2 to 5 words in all documents, the first 2000 of each language."""
    return phrases.phrases(table(spark, sf_dir, "documents"), min_count=100, max_words=5, top=2000, swallow=100)


ORACLE["op11_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda w: w <> '') AS w FROM pieces),
sized AS (SELECT lang, m, w FROM split, range(1, 6) AS t(m) WHERE len(w) >= m),
placed AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM sized),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM placed GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= 100),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r, n,
         ((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
  JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM cand s JOIN cand x ON x.lang = s.lang AND x.m > s.m AND 100 * x.a >= 100 * s.a
  WHERE contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' '))
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score
FROM best b ANTI JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY row_number() OVER w <= 2000
"""


@register
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; a third of them, by id, is not learned from."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=fold(F.col("doc_id"), 3) != 1)
    out = toxicity.toxicity_scores(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and their most typical terms, over all documents."""
    return divergence.divergence_report(table(spark, sf_dir, "documents"), min_docs=30, top=50)


ORACLE["op13_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
found AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
grp AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT f.lang, f.source, f.term, count(*) AS n FROM found f JOIN kept k ON f.lang = k.lang AND f.term = k.term GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gtot AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS t FROM grp g LEFT JOIN cnt c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
ltot AS (SELECT lang, sum(t)::HUGEINT AS t FROM gtot GROUP BY lang),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.t + 5 * s.v))::BIGINT AS p
  FROM gtot g JOIN kept k ON g.lang = k.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT l.lang, k.term, (1 + (1000000000::HUGEINT * (sum(c.n) + 5)) // (any_value(l.t) + 5 * any_value(s.v)))::BIGINT AS q
  FROM ltot l JOIN kept k ON l.lang = k.lang JOIN sizes s ON s.lang = l.lang JOIN cnt c ON c.lang = k.lang AND c.term = k.term GROUP BY ALL),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
typical AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
every AS (SELECT * FROM pairs UNION ALL SELECT * FROM typical)
SELECT lang, source, part, item, value, (row_number() OVER w)::INTEGER AS rank
FROM every
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))
QUALIFY part = 'pair' OR row_number() OVER w <= 50
"""
