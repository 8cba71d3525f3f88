"""One query per operator over its whole table, with its SQL equivalent where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, written
from ..sources.tables import read_table
from . import cotraining, kmtree, lexical, mixing, packing, pii, planes, ring, rollups, simhash, spotsigs, urls, whitening
from .base import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_mix_sources", r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT source, source_size, ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight,
         (source_size * 2)::DOUBLE AS cap FROM totals),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank,
         ((SELECT sum(source_size) FROM totals)::DOUBLE * 1.5
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
opened AS (SELECT min(rank) AS rank, arg_min(level, rank) AS level FROM levels WHERE level * weight < cap),
targets AS (
  SELECT l.source, l.source_size, CASE WHEN l.rank >= o.rank THEN l.weight * o.level ELSE l.cap END AS target,
         ('0x' || substr(md5('mix-1/' || coalesce('=' || l.source, '')), 1, 5))::INTEGER::DOUBLE / 1048576 AS start
  FROM levels l, opened o),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.start,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         (row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS LAST) - 1)::DOUBLE AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (least(floor(start + rate * (before + 1)) - floor(start + rate * before), ceil(rate)) * size)::BIGINT AS taken
FROM ranked""")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_simhash_near_duplicates")
def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS], F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cotraining.prepare(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    scores = cotraining.score_rows(rows, cotraining.train_rows(rows))
    return scores.withColumn("kept", F.col("score") >= cotraining.REJECT_BELOW)


@query("op5_token_rollups", r"""
WITH counted AS (
  SELECT doc_id, source, lang, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words,
         coalesce(len(regexp_extract_all(text, '\p{L}+|\p{N}|[^\x09-\x0D\x20\p{L}\p{N}]')), 0) AS pieces,
         row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id NULLS LAST, source NULLS FIRST, lang NULLS FIRST) AS copy FROM documents)
SELECT source, lang, v.tokenizer_version, count(*) AS docs,
       sum(CASE WHEN v.tokenizer_version = 'words-1' THEN words ELSE pieces END)::DECIMAL(38, 0) AS tokens
FROM counted, (VALUES ('words-1'), ('pieces-2')) v(tokenizer_version)
WHERE copy = 1 GROUP BY ALL""")
def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents, withdraw exact copies, recount under a newer tokenizer; each batch is sent twice."""
    text = F.coalesce("text", F.lit(""))
    docs = written(read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"), F.length(text).alias("c")).alias("same"),
        *[rollups.token_count(F.col("text"), v).alias(v.replace("-", "_")) for v in rollups.PATTERNS]), "counted")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang")
    kept = docs.groupBy("same").agg(F.min_by(F.struct("source", "lang", "words_1", "pieces_1", "pieces_2"), order).alias("k")).select("k.*")
    both = lambda rows, sign: rollups.changes(rows, "words-1", sign, F.col("words_1")).union(
        rollups.changes(rows, "pieces-1", sign, F.col("pieces_1")))
    store = rollups.Rollup(spark, scratch_path(spark, "rollup"))
    batches = [
        ("load", both(docs, 1)),
        ("withdraw copies", both(docs, -1).union(both(kept, 1))),
        ("recount", rollups.revised(kept, "pieces-1", "pieces-2", F.col("pieces_1"), F.col("pieces_2"))),
    ]
    for batch, delta in batches:
        store.commit(batch, delta)
        store.commit(batch, delta)
    return store.totals()


def _url_sql() -> str:
    """The verdicts by regular expressions, with the terms and rules written out."""
    return r"""
WITH urls AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages),
rest AS (SELECT page_id, url, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM urls),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS url FROM rest),
counted AS (
  SELECT *,
    len(list_filter(['adult', 'casino', 'escort', 'hentai', 'jackpot', 'porn', 'sex', 'viagra', 'warez', 'xxx'],
        lambda t: regexp_matches(url, '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')))::INTEGER AS n_strict,
    len(list_filter(['bet', 'bonus', 'cheap', 'click', 'crack', 'deal', 'download', 'free', 'loan', 'pills', 'poker', 'promo',
         'replica', 'slots', 'torrent', 'win'], lambda t: regexp_matches(url, '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')))::INTEGER AS n_soft
  FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM counted)
SELECT page_id, host, path, rule, n_strict, n_soft,
  CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


@query("op6_url_filter", _url_sql())
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"))


@query("op7_spotsigs", r"""WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS place FROM documents),
edits AS (
  SELECT t.doc_id, t.n, t.text, f.text AS after, substr(t.text, 1, t.n - t.n // 3) || substr(f.text, 1, t.n // 3) AS edited
  FROM texts t JOIN texts f ON f.place = t.place % (SELECT count(*) FROM texts) + 1),
each AS (SELECT text AS t FROM edits UNION SELECT edited FROM edits),
padded AS (SELECT t, ' ' || regexp_replace(lower(t), '[^\p{L}\p{N}]+', '  ', 'g') || ' ' AS p FROM each),
chained AS (
  SELECT t, trim(regexp_replace(p, ' +', ' ', 'g')) AS whole,
         list_filter(list_transform(string_split(regexp_replace(p,
           ' (a|an|and|are|as|at|au|auf|avec|con|dans|das|de|del|dem|den|der|des|die|du|ein|eine|el|en|' ||
           'est|et|for|from|für|im|in|is|ist|it|la|las|le|les|los|mit|nicht|of|on|or|par|para|por|pour|' ||
           'que|qui|se|sich|sur|that|the|this|to|un|una|und|une|von|was|with|y|zu) ', chr(1) || '\1 ', 'g'), chr(1))[2:],
           lambda s: array_to_string(string_split(trim(regexp_replace(s, ' +', ' ', 'g')), ' ')[1:4], ' ')), lambda s: contains(s, ' ')) AS chains
  FROM padded),
signed AS (
  SELECT t, list_sort(list_distinct(list_transform(
    CASE WHEN len(chains) > 0 THEN chains WHEN whole <> '' THEN [whole] ELSE [] END, lambda s: substr(md5(s), 1, 8)))) AS sigs FROM chained)
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, array_to_string(a.sigs, '') AS fingerprint,
       array_to_string(b.sigs, '') AS edited_fingerprint,
       CASE WHEN len(a.sigs) = 0 AND len(b.sigs) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a.sigs, b.sigs))::DOUBLE
         / (len(a.sigs) + len(b.sigs) - len(list_intersect(a.sigs, b.sigs))) END AS near_edited,
       CASE WHEN len(a.sigs) = 0 AND len(c.sigs) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a.sigs, c.sigs))::DOUBLE
         / (len(a.sigs) + len(c.sigs) - len(list_intersect(a.sigs, c.sigs))) END AS near_next
FROM edits e JOIN signed a ON a.t = e.text JOIN signed b ON b.t = e.edited JOIN signed c ON c.t = e.after""")
def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_edits(read_table(spark, sf_dir, "documents"))


@query("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours found, and the recall that calibration has measured for the number of leaves visited."""
    found, measured = kmtree.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumn("calibrated_recall", F.lit(measured["recall"]))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary())


@query("op10_token_planes")
def op10_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "planes")
    planes.write_ids(read_table(spark, sf_dir, "documents"), path, vocabulary())
    return planes.read_digests(spark, path)


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query("op12_ring_shards")
def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.place(read_table(spark, sf_dir, "documents"))


@query("op13_lexical_search", r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT doc_id, len(terms) AS n, terms FROM texts WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS length FROM sizes),
counts AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sizes) GROUP BY ALL),
wanted AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT documents FROM total) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * documents) // length))))::BIGINT AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term), total GROUP BY ALL HAVING score > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
