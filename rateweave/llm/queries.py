"""The subpackage's registered queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.llm import (
    containment_search,
    language_id,
    merkle_fixity,
    oph_fingerprint,
    pii_surrogates,
    prefix_trie,
    quality_ftrl,
    sentencepiece_codec,
    simhash_ball,
    token_alignment,
    token_archive,
    toxicity_ftrl,
    url_cascade,
)


#: The key of the registered query's stand-ins, which everybody may know: the tables are synthetic.
PII_KEY = b"synthetic tables only"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs, decoded=True).drop("text")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_surrogates.surrogates(docs, PII_KEY, count_col="n_entities")


def op3_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' WARC files against a replica with a flipped byte in some records and some files cut short."""
    page, per_file = F.col("page_id"), merkle_fixity.RECORDS_PER_FILE
    damaged = page % 97 == 5
    lost = (F.floor(page / per_file) % 5 == 3) & (page % per_file >= 990)
    ours, theirs = merkle_fixity.archived(_table(spark, sf_dir, "pages"), damaged, lost)
    return merkle_fixity.audit(ours, theirs)


def op4_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_ball.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    rows = docs.select("doc_id", language_id.held_out().alias("held_out"), "text")
    return language_id.identify(rows, model).drop("text")


def op6_oph_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph_fingerprint.fingerprint_pairs(_table(spark, sf_dir, "documents"))


def op7_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment_search.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _judged(rows: DataFrame) -> DataFrame:
    return rows.drop("text").withColumn("predicted", (rows["score"] >= 0.5).cast("int"))


def op8_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_ftrl.train(docs, _table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", quality_ftrl.held_out().alias("held_out"), "text")
    return _judged(quality_ftrl.score(rows, model))


def op9_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity_ftrl.train(docs, _table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", toxicity_ftrl.held_out().alias("held_out"), "text")
    return _judged(toxicity_ftrl.score(rows, model))


def op10_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_cascade.judged(pages, url_cascade.default_list(spark)).drop("url")


def op11_rans_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_archive.archived(docs, public_tokenizers.path(token_archive.TOKENIZER))


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.aligned(docs, a, b)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_pii_surrogates,
        op3_merkle_fixity,
        op4_simhash_ball,
        op5_language_id,
        op6_oph_fingerprint,
        op7_containment_search,
        op8_quality_ftrl,
        op9_toxicity_ftrl,
        op10_url_cascade,
        op11_rans_archive,
        op12_burst_trie,
        op13_token_alignment,
    )
}

# Distinct shingles are sets of strings, so equal to the operator's; two shingle
# sizes never mix (a text under five words has one shingle, all its words).
_SHINGLES = """
SELECT {id}, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s
FROM (SELECT {id}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS w FROM {table})"""

_RECORD = """'WARC/{version}' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
  || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>'
  || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR || chr(13) || chr(10)
  || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"""

_RULE_CASES = "\n".join(
    f"    WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}={said}'"
    for said, h, p in sorted(url_cascade.RULES, key=lambda r: -len(r[1] + r[2]))
)
_LISTED = [f"{n}.{s}" for n in url_cascade.LISTED_NAMES for s in url_cascade.LISTED_SUFFIXES]

# CRC-32 of a text of ASCII characters, bit by bit: a character, then eight shifts.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1),
    lambda i: [ascii(({0})[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""

ORACLES: dict[str, str] = {
    "op3_merkle_fixity": f"""
WITH records AS (
  SELECT page_id, page_id // 1000 AS number, {_RECORD.format(version="1.0")} AS a, {_RECORD.format(version="1.1")} AS b,
         (page_id // 1000) % 5 = 3 AND page_id % 1000 >= 990 AS lost
  FROM pages),
placed AS (
  SELECT *, strlen(a)::BIGINT AS length, coalesce(sum(strlen(a)) OVER (
      PARTITION BY number ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM records)
SELECT 'pages-' || CASE WHEN length(number::VARCHAR) < 6 THEN lpad(number::VARCHAR, 6, '0') ELSE number::VARCHAR END || '.warc' AS file, "offset",
       CASE WHEN lost THEN 'missing' ELSE 'corrupt' END AS status, length, sha256(a) AS hash,
       CASE WHEN NOT lost THEN length END AS other_length, CASE WHEN NOT lost THEN sha256(b) END AS other_hash
FROM placed WHERE lost OR page_id % 97 = 5""",
    "op10_url_cascade": f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
judged AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path
  FROM parts),
ruled AS (
  SELECT *, CASE
{_RULE_CASES}
    END AS found
  FROM judged)
SELECT page_id, host, path, split_part(found, '=', 1) AS rule,
       coalesce(split_part(found, '=', 2),
                CASE WHEN list_has_any(list_transform(range(1, len(string_split(host, '.')) + 1),
                                                      lambda i: array_to_string(string_split(host, '.')[i:], '.')),
                                       {_LISTED!r}) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled""",
    "op12_burst_trie": f"""
WITH t AS (
  SELECT conv_id, turn, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY turn NULLS FIRST, said) AS turns FROM t GROUP BY conv_id),
hashed AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, ({_CRC32.format("conv_id::VARCHAR")} % 6)::BIGINT AS h FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.base),
prefixes AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT turns[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth) AS ends
  FROM prefixes GROUP BY p, depth),
children AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
weighed AS (
  SELECT a.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(a.p[depth].t) END AS saved
  FROM nodes a LEFT JOIN children c USING (p, depth)),
above AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM weighed),
subtrees AS (
  SELECT p[1:up] AS p, up AS depth, sum(saved)::BIGINT AS saved_tokens, (count(*) FILTER (WHERE n_children = 0))::BIGINT AS n_leaves
  FROM above GROUP BY ALL)
SELECT w.conv_id, w.depth, parent.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(w.ends, '')) AS ends_sha256
FROM weighed w JOIN subtrees s USING (p, depth)
LEFT JOIN nodes parent ON parent.depth = w.depth - 1 AND parent.p = w.p[1:w.depth - 1]""",
    "op7_containment_search": f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES.format(id="item_id", table="(SELECT DISTINCT item_id, text FROM benchmark)")}),
held AS (
  SELECT doc_id, item_id, count(*) AS shared
  FROM (SELECT doc_id, unnest(s) AS g FROM d) JOIN (SELECT item_id, unnest(s) AS g FROM b) USING (g)
  GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, len(s) AS item_shingles, shared / len(s) AS containment
FROM held JOIN b USING (item_id)
WHERE shared >= 0.8 * len(s)""",
}
