"""The training-data queries and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe_segment,
    fuse_exact,
    html_wrapper,
    kk_packing,
    line_cuckoo,
    quality_crf,
    quality_llr,
    rlbwt,
    simhash_ring,
    token_align,
    turn_repair,
    unigram_trie,
    url_alias,
)
from ledgerlens.llm.common import documents


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_text(pages(spark, sf_dir))


def op2_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    judged = quality_llr.fit_judge(docs, quality_llr.labels_of(spark, sf_dir))
    return judged.select("row.doc_id", *[c for c in judged.columns if c != "row"])


def op3_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_ring.group(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_url_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_alias.judge(pages(spark, sf_dir), url_alias.rule_table(spark, url_alias.RULES))


def op5_bpe_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_segment.code(documents(spark, sf_dir))


def op6_unigram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return unigram_trie.count_tokens(docs, scores=unigram_trie.fit(docs))


def op7_rlbwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlbwt.digest(rlbwt.cut(documents(spark, sf_dir)), with_text=True)


def op8_fuse_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse_exact.group(documents(spark, sf_dir))


def op9_line_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_cuckoo.digest(line_cuckoo.dedup(documents(spark, sf_dir)))


def op10_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kk_packing.pack(documents(spark, sf_dir))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.aligned(documents(spark, sf_dir))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turn_repair.audit(conversations, turn_repair.damage(conversations))


def op13_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality_crf.score(docs, quality_crf.fit(docs, quality_crf.labels_of(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_wrapper,
        op2_quality_llr,
        op3_simhash_ring,
        op4_url_alias,
        op5_bpe_segment,
        op6_unigram_trie,
        op7_rlbwt,
        op8_fuse_exact,
        op9_line_cuckoo,
        op10_kk_packing,
        op11_token_align,
        op12_turn_repair,
        op13_quality_crf,
    )
}

_NODE = r"""nullif(translate({h}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')
  || regexp_replace({p}, '/+$', '') || {q}"""


def _parts(url: str) -> dict[str, str]:
    return {
        "h": f"regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1)",
        "p": f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)",
        "q": f"regexp_extract({url}, '(?s)^.*?://[^?#]*(\\?[^#]*)', 1)",
    }


def _dotless(url: str) -> str:
    """DuckDB: the url with the dot segments of its path resolved."""
    path = _parts(url)["p"]
    return rf"""CASE WHEN regexp_matches({path}, '/\.\.?(/|$)') THEN
      regexp_extract({url}, '(?s)^(.*?://[^/?#]*)', 1)
      || list_reduce(list_prepend('', string_split({path}, '/')[2:]), lambda done, s:
           CASE s WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || s END)
      || CASE WHEN regexp_matches({path}, '/\.\.?$') THEN '/' ELSE '' END
      || regexp_extract({url}, '(?s)^.*?://[^?#]*([?#].*)$', 1) ELSE {url} END"""


def _decoded(text: str) -> str:
    """DuckDB: text with its character references decoded, the ampersand's last."""
    numbered = rf"""list_reduce(list_prepend({text}, list_distinct(regexp_extract_all({text},
      '&#(?:[xX][0-9a-fA-F]{{1,6}}|[0-9]{{1,7}});'))), lambda done, r: replace(done, r, chr(
        CASE WHEN regexp_matches(r, '[xX]') THEN CAST('0x' || regexp_extract(r, '[xX]([0-9a-fA-F]+)', 1) AS INTEGER)
             ELSE CAST(regexp_extract(r, '([0-9]+)', 1) AS INTEGER) END)))"""
    for name, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")):
        numbered = f"replace({numbered}, '{name}', '{plain}')"
    return numbered


ORACLE_SQL = {
    "op4_url_alias": rf"""
WITH RECURSIVE rules(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (
  SELECT page_id, coalesce(url, '') AS url, row_number() OVER () AS rid,
         translate({_parts("coalesce(url, '')")["h"]}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         {_parts("coalesce(url, '')")["p"]} AS path,
         {_NODE.format(**_parts("dotless"))} AS node
  FROM (SELECT page_id, url, {_dotless("coalesce(url, '')")} AS dotless FROM pages) d),
links AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')
                  || regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')) AS tag
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
raw_targets AS (
  SELECT url, coalesce(nullif(regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1), ''),
                       nullif(regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1), '')) AS link
  FROM links),
targets AS (SELECT url, {_decoded("link")} AS link FROM raw_targets WHERE link IS NOT NULL),
resolved AS (
  SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
              WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
              WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || link
              WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link
              WHEN starts_with(link, '?') THEN regexp_extract(url, '(?s)^(.*?://[^?#]*)', 1) || link
              WHEN starts_with(link, '#') THEN regexp_extract(url, '(?s)^([^#]*)', 1) || link
              ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
                || coalesce(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*/)', 1), ''), '/') || link END AS target
  FROM targets),
absolute AS (
  SELECT {_dotless("url")} AS url, {_dotless("target")} AS target FROM resolved WHERE target IS NOT NULL),
ends AS (SELECT url FROM absolute UNION SELECT target FROM absolute),
known AS (
  SELECT node, host, path FROM p
  UNION SELECT {_NODE.format(**_parts("url"))},
    translate({_parts("url")["h"]}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_parts("url")["p"]} FROM ends),
fits AS (
  SELECT k.*, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY k.node, k.host, k.path ORDER BY length(r.rule_host || r.rule_path) DESC) AS nth
  FROM known k JOIN rules r
    ON (k.host = r.rule_host OR ends_with(k.host, '.' || r.rule_host)) AND starts_with(k.path, r.rule_path)),
best AS (SELECT * FROM fits WHERE nth = 1),
edges AS (
  SELECT {_NODE.format(**_parts("url"))} AS u, {_NODE.format(**_parts("target"))} AS v FROM absolute),
both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach AS (
  SELECT node AS a, node AS b FROM known WHERE node IS NOT NULL
  UNION SELECT r.a, e.v FROM reach r JOIN both_ways e ON r.b = e.u),
inherited AS (
  SELECT r.a AS node, min(best.verdict) AS verdict FROM reach r JOIN best ON best.node = r.b GROUP BY r.a)
SELECT p.page_id, p.host, p.path, o.rule,
       coalesce(o.verdict, CASE WHEN i.node IN (SELECT u FROM both_ways) THEN i.verdict END, 'allow') AS verdict
FROM p
LEFT JOIN (SELECT DISTINCT host, path, rule, verdict FROM best) o ON o.host = p.host AND o.path = p.path
LEFT JOIN inherited i ON i.node = p.node""",
    "op8_fuse_exact": r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, g.keep_id, g.group_size,
       n.doc_id IS NOT DISTINCT FROM g.keep_id
         AND row_number() OVER (PARTITION BY n.doc_id, n.text_sha256) = 1 AS kept,
       n.text_sha256
FROM n JOIN g ON g.text_sha256 = n.text_sha256""",
    "op9_line_cuckoo": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (
  SELECT rid, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common ON common.key = k.key
GROUP BY k.rid, k.doc_id""",
}
