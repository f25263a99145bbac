"""The queries of this folder, and SQL for those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import (
    decontaminate, html_extract, language_id, packing, pii, secret_scan, simhash, spotsigs, substring_dedup, subword_lm,
    token_alignment, warc, whitening,
)
from tributary.llm.common import table


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"))


def op5_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_lm.report(table(spark, sf_dir, "documents"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_secret_scan": op2_secret_scan,
    "op3_simhash": op3_simhash,
    "op4_language_id": op4_language_id,
    "op5_subword_lm": op5_subword_lm,
    "op6_pack": op6_pack,
    "op7_html_extract": op7_html_extract,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_pii": op11_pii,
    "op12_whitening": op12_whitening,
    "op13_token_alignment": op13_token_alignment,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_WINDOW = 50

_SUBSTRING_SQL = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i + 1:i + {_WINDOW}], ' ')) AS body
  FROM (SELECT doc_id, ws, unnest(range(len(ws) - {_WINDOW - 1})) AS i FROM words WHERE len(ws) >= {_WINDOW})
),
owners AS (SELECT body, min(doc_id) AS owner FROM windows GROUP BY body),
gone AS (
  SELECT DISTINCT doc_id, i + o AS i FROM windows JOIN owners USING (body), range({_WINDOW}) r(o) WHERE owner < doc_id
),
single AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM words),
kept AS (
  SELECT s.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY s.i) FILTER (g.i IS NULL) AS kept
  FROM single s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i GROUP BY s.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id"""


def _decontaminate_sql(settings: decontaminate.Settings) -> str:
    span, flank = settings.span, settings.flank
    seeds = ", ".join(
        f"concat_ws(' ', {number}, " + ", ".join(f"ws[pos + {i + 1}]" for i, bit in enumerate(mask) if bit == "1") + ")"
        for number, mask in enumerate(settings.masks)
    )
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"

    def placed(table: str) -> str:
        return f"""SELECT id, ws, pos, unnest([{seeds}]) AS seed FROM (
    SELECT id, ws, unnest(range(len(ws) - {span - 1})) AS pos FROM {table} WHERE len(ws) >= {span})"""

    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {words} AS ws FROM documents),
tests AS (SELECT item_id AS id, {words} AS ws FROM benchmark WHERE item_id IS NOT NULL),
d AS ({placed("docs")}),
b AS ({placed("tests")}),
hits AS (
  SELECT DISTINCT d.id, b.id AS item, d.pos, b.pos AS item_pos, d.ws, b.ws AS item_ws,
    least({flank}, d.pos, b.pos) AS l, least({span + flank}, len(d.ws) - d.pos, len(b.ws) - b.pos) AS r
  FROM d JOIN b ON d.seed = b.seed
),
compared AS (
  SELECT id, item, pos, item_pos, l, r, CAST(count(*) FILTER (ws[pos + k + 1] = item_ws[item_pos + k + 1]) AS DOUBLE) / (l + r) AS share,
    bool_and(ws[pos + k + 1] = item_ws[item_pos + k + 1]) FILTER (k BETWEEN 0 AND {span - 1}) AS same
  FROM (SELECT *, unnest(range(-l, r)) AS k FROM hits) GROUP BY id, item, pos, item_pos, l, r
),
spans AS (
  SELECT id, item,
    coalesce(min(pos - l) FILTER (share >= {settings.agree}), min(pos) FILTER (same)) AS s,
    coalesce(max(pos + r) FILTER (share >= {settings.agree}), max(pos + {span}) FILTER (same)) AS e,
    coalesce(max(share) FILTER (share >= {settings.agree}), 1.0) AS share
  FROM compared WHERE same OR share >= {settings.agree} GROUP BY id, item, pos - item_pos
  UNION ALL
  SELECT p.id, t.id, pos, pos + len(t.ws), 1.0::DOUBLE
  FROM (SELECT id, ws, unnest(range(len(ws))) AS pos FROM docs) p
  JOIN (SELECT * FROM tests WHERE len(ws) BETWEEN 1 AND {span - 1}) t ON p.ws[pos + 1] = t.ws[1] AND p.ws[pos + 1:pos + len(t.ws)] = t.ws
),
found AS (
  SELECT id, count(DISTINCT item) AS n_items, max(share) AS agree
  FROM spans GROUP BY id
),
items AS (SELECT id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM spans) GROUP BY id),
places AS (
  SELECT id, string_agg(concat_ws(':', item, s, e), ',' ORDER BY s, e, item) AS "overlaps"
  FROM (SELECT DISTINCT id, item, s, e FROM spans) GROUP BY id
)
SELECT doc_id, found.id IS NOT NULL AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items, '') AS items, coalesce("overlaps", '') AS "overlaps", coalesce(agree, 0.0::DOUBLE) AS agree
FROM docs LEFT JOIN found ON found.id = docs.id LEFT JOIN items ON items.id = docs.id LEFT JOIN places ON places.id = docs.id"""


ORACLE_SQL: dict[str, str] = {
    "op9_substring_dedup": _SUBSTRING_SQL,
    "op10_decontaminate": _decontaminate_sql(decontaminate.Settings()),
}
