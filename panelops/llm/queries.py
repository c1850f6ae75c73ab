"""Queries of the corpus operators over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.llm import bitplanes, ecoc_language, gnat, html_region, importance, jaccard_orders, kdtree, log_bilinear, markov_secrets, patience, soft_mix, suffix_automaton, url_lists
from panelops.llm.common import read
from panelops.staging import scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Shares of all tokens that the domains are to have.
MIX_WEIGHTS = {"high": 0.87, "low": 0.13, "toxic": 0.0}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


@query("op2_bitplanes")
def op2_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    bitplanes.write_ids(read(spark, sf_dir, "documents"), path, TOKENIZER)
    return bitplanes.read_documents(spark, path)


#: Lower-cases A-Z only.
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP7_WORDS = f"""coalesce(regexp_extract_all({ASCII_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"""


@query("op7_suffix_automaton", f"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {OP7_WORDS} AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS passage
    FROM (SELECT *, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
          FROM items WHERE len(words) > 0)
), docs AS (
    SELECT row_number() OVER () AS row, doc_id, {OP7_WORDS} AS words FROM documents
), places AS (
    SELECT row, i, size, array_to_string(words[i:i + size - 1], ' ') AS passage
    FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), hits AS (
    SELECT row, i, p.size, item FROM places p JOIN windows w ON p.size = w.size AND p.passage = w.passage
), words AS (
    SELECT row, count(DISTINCT pos) AS n FROM (SELECT row, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY row
), found AS (
    SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT row, item FROM hits WHERE item IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(docs.words) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(found.names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (row) LEFT JOIN found USING (row)
""")
def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_automaton.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op10_ecoc_language")
def op10_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ecoc_language.predict(read(spark, sf_dir, "documents"))


@query("op8_jaccard_orders", f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all({ASCII_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS words
    FROM documents
), sets AS (
    SELECT row, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)]) END AS shingles
    FROM docs
), tokens AS (
    SELECT row, len(shingles) AS n, unnest(shingles) AS token FROM sets
), links AS (
    SELECT a.row AS a, b.row AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.row <> b.row
    GROUP BY a.row, b.row, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
    SELECT row AS a, row AS b FROM docs
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT sets.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT reach.a AS row, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.row = reach.b GROUP BY reach.a) c USING (row)
""")
def op8_jaccard_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_orders.join(read(spark, sf_dir, "documents"))


@query("op6_soft_mix")
def op6_soft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = soft_mix.domains_of(read(spark, sf_dir, "labels"))
    return soft_mix.mix(read(spark, sf_dir, "documents"), labelled, MIX_WEIGHTS)


@query("op3_kdtree", """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score, c.r AS other
    FROM rows q JOIN rows c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
""")
def op3_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op1_html_region")
def op1_html_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.pages_text(read(spark, sf_dir, "pages"))


@query("op9_markov_secrets")
def op9_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov_secrets.scan(read(spark, sf_dir, "documents"))


def md5_number(text: str, at: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {at}, 4) AS INTEGER)"


@query("op4_url_lists", f"""
WITH pages_at AS (
    SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + {md5_number("url", 1)} % 366 AS fetched,
           rtrim(lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')), '.') AS host
    FROM pages
), labelled AS (
    SELECT DISTINCT host, string_split(host, '.') AS labels FROM pages_at WHERE host <> ''
), tails AS (
    SELECT host, array_to_string(labels[i:], '.') AS pattern, len(labels) - i + 1 AS size
    FROM (SELECT *, unnest(range(1, greatest(len(labels) - 1, 1) + 1)) AS i FROM labelled)
), patterns AS (
    SELECT DISTINCT pattern FROM tails WHERE size >= 3 OR pattern = host
), drawn AS (
    SELECT pattern, ['adult', 'malware', 'spam'][{md5_number("pattern", 9)} % 3 + 1] AS list,
           DATE '2023-10-01' + {md5_number("pattern", 13)} % 366 AS start,
           30 + {md5_number("pattern", 17)} % 120 AS gone, 180 + {md5_number("pattern", 21)} % 60 AS back, {md5_number("pattern", 25)} % 2 = 0 AS again
    FROM patterns WHERE {md5_number("pattern", 5)} % 2 = 0
), held AS (
    SELECT list, pattern, start AS since, start + gone AS until FROM drawn
    UNION ALL SELECT list, pattern, start + back, NULL FROM drawn WHERE again
), found AS (
    SELECT r, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
    FROM pages_at JOIN tails USING (host) JOIN held USING (pattern)
    WHERE since <= fetched AND (until IS NULL OR fetched < until) GROUP BY r
)
SELECT page_id, url, host, fetched, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked FROM pages_at LEFT JOIN found USING (r)
""")
def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_lists.evaluate(url_lists.dated_captures(pages), url_lists.derived_lists(pages))


@query("op5_patience")
def op5_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patience.scan(read(spark, sf_dir, "documents"))


#: CRC-32 by the reflected polynomial EDB88320, byte by byte over the hexadecimal form of a text.
CRC_TABLE = """SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc
    FROM (SELECT unnest(range(256)) AS b)"""
CRC = """xor(4294967295, list_reduce(
        [CAST('0x' || code[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(len(code) // 2)],
        lambda c, b: xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)))"""


@query("op13_importance", f"""
WITH table_of AS MATERIALIZED (
    {CRC_TABLE}
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {OP7_WORDS} AS words FROM documents
), items AS (
    SELECT {OP7_WORDS} AS words FROM benchmark
), doc_runs AS (
    SELECT r, array_to_string(words[i:i + n - 1], ' ') AS run
    FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, (SELECT unnest([1, 2, 3]) AS n))
), item_runs AS (
    SELECT array_to_string(words[i:i + n - 1], ' ') AS run
    FROM (SELECT words, n, unnest(range(1, len(words) - n + 2)) AS i FROM items, (SELECT unnest([1, 2, 3]) AS n))
), coded AS MATERIALIZED (
    SELECT run, {CRC} % 10000 AS bucket
    FROM (SELECT run, hex(encode(run)) AS code FROM (SELECT run FROM doc_runs UNION SELECT run FROM item_runs)), table_of
), s AS (
    SELECT bucket, count(*) AS s FROM doc_runs JOIN coded USING (run) GROUP BY 1
), t AS (
    SELECT bucket, count(*) AS t FROM item_runs JOIN coded USING (run) GROUP BY 1
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM doc_runs) + 10000) AS DOUBLE)
        / CAST((s + 1) * ((SELECT count(*) FROM item_runs) + 10000) AS DOUBLE))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket)
), sums AS (
    SELECT r, count(*) AS n, sum(gain) AS weight FROM doc_runs JOIN coded USING (run) JOIN gains USING (bucket) GROUP BY r
), scored AS (
    SELECT r, doc_id, len(words) AS n_words, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST('0x' || sha256('42:' || CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) AS h
    FROM docs LEFT JOIN sums USING (r)
), placed AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
    SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC NULLS LAST, doc_id, weight, n_features) END AS place
    FROM placed
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 5 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN place END AS rank FROM ranked
""")
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op11_gnat", """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, o.r AS other, o.vec_id, a.label = o.label AS same,
           CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
    FROM rows a JOIN rows o ON a.r <> o.r AND len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) AS place
    FROM scores WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id, n.other) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor = n.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
""")
def op11_gnat(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return gnat.hard_negatives(read(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


@query("op12_log_bilinear")
def op12_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score(read(spark, sf_dir, "documents"))
