"""The operators of this subpackage as registered queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.bpe_codec import encode_decode
from stocktake.llm.decontaminate import leaks
from stocktake.llm.language_model import score_texts
from stocktake.llm.line_dedup import deduped
from stocktake.llm.pii import pseudonymised
from stocktake.llm.prefix_trie import prefix_trie, rebuilt, turns
from stocktake.llm import quality_rules
from stocktake.llm.quality_rules import METRICS, judged
from stocktake.llm.simhash_dedup import near_duplicates
from stocktake.llm.source_audit import audit
from stocktake.llm.substring_dedup import dedup_substrings
from stocktake.llm.suffix_dedup import dedup_bytes
from stocktake.llm.toxicity import fold, score, train
from stocktake.llm.warc import FIRST_SECOND, capture_index

#: Of the pseudonyms in the registered query; real data need a secret one.
KEY = "registered query"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = judged(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return verdicts.select("doc_id", *(F.col(f"quality.{c}") for c in [*METRICS, "base_failed", "kept", "n_lost_chars"]))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id")) == 0
    model = train(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages", "best_start", "best_length")


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY).select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduped(_table(spark, sf_dir, "documents"))


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = capture_index(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations share up to five first turns with the first of their hundred."""
    borrowed = F.crc32(F.col("conv").cast("string")) % 6
    return prefix_trie(rebuilt(turns(_table(spark, sf_dir, "conversations")), 100, borrowed, 5))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(_table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_texts(_table(spark, sf_dir, "documents"), held_out)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_pii_pseudonyms": op7_pii_pseudonyms,
    "op8_line_dedup": op8_line_dedup,
    "op9_warc_index": op9_warc_index,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_audit": op12_source_audit,
    "op13_lm_scoring": op13_lm_scoring,
}

# -- SQL, for those operators whose rows it can express ----------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS s FROM w),
keyed AS (SELECT doc_id, s, array_to_string(ws[s:s + 49], ' ') AS k FROM windows),
least_of AS (SELECT k, min(doc_id) AS first_doc FROM keyed GROUP BY k),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(50)) AS p FROM keyed JOIN least_of USING (k) WHERE first_doc < doc_id),
places AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
marked AS (SELECT places.doc_id, word, p, gone.p IS NOT NULL AS off,
    lag(gone.p IS NOT NULL, 1, false) OVER (PARTITION BY places.doc_id ORDER BY p) AS off_before
  FROM places LEFT JOIN gone USING (doc_id, p)),
kept AS (SELECT doc_id, count(*) FILTER (off) AS n_removed, count(*) FILTER (off AND NOT off_before) AS n_spans,
    string_agg(word, ' ' ORDER BY p) FILTER (NOT off) AS rest FROM marked GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op2_suffix_dedup": """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, h, unnest(generate_series(1, length(h) // 2 - 49)) AS s FROM b),
keyed AS (SELECT doc_id, s, substr(h, 2 * s - 1, 100) AS k FROM windows),
least_of AS (SELECT k, min(doc_id) AS first_doc FROM keyed GROUP BY k),
hits AS (SELECT doc_id, s FROM keyed JOIN least_of USING (k) WHERE first_doc < doc_id),
starts AS (SELECT doc_id, s, coalesce(s > 50 + lag(s) OVER (PARTITION BY doc_id ORDER BY s), true) AS fresh FROM hits),
numbered AS (SELECT doc_id, s, sum(fresh::int) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM starts),
spans AS (SELECT doc_id, span, min(s) AS a, max(s) + 50 AS z FROM numbered GROUP BY doc_id, span),
around AS (SELECT doc_id, span, a, z, lag(z, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
cut AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS tail,
    string_agg(substr(h, 2 * before - 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM around JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * tail - 1), h))) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)""",
    "op5_quality_rules": rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS s, ws FROM w),
keyed AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, ws[s], ws[s + 1], ws[s + 2]) AS n FROM windows),
inside AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, s + unnest([0, 1, 2]) AS p FROM keyed WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM w),
judged AS (SELECT *, len(regexp_extract_all(line, '[^ 	-
]+')) AS words, lower(trim(line, ' ')) AS low,
    len(regexp_extract_all(line, '[#*$%&<>]+|!!+')) AS marks, len(regexp_extract_all(line, '(^|[ 	])[|›»·•>]([ 	
]|$)')) AS bars FROM lines),
failing AS (SELECT doc_id, line, i, words > 0 AS filled, words > 0 AND (
      marks > words * {quality_rules.MARKS_PER_WORD}::double OR NOT regexp_matches(line, '[\p{{L}}\p{{N}}]')
      OR (bars >= {quality_rules.MIN_SEPARATORS} AND bars > words * {quality_rules.SEPARATORS_PER_WORD}::double)
      OR (words <= {quality_rules.MENU_LINE_WORDS} AND regexp_matches(low, '{quality_rules.MENU}'))
      OR regexp_matches(low, '{quality_rules.BOILERPLATE}')) AS fails FROM judged),
kept AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT fails), '') AS clean,
    count(*) FILTER (filled) - count(DISTINCT line) FILTER (filled) AS n_dup_lines FROM failing GROUP BY doc_id),
base AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words,
    length(text) - length(clean) AS n_lost_chars, length(text) AS chars
  FROM w LEFT JOIN inside USING (doc_id) JOIN kept USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words)
    AND 100 * n_lost_chars <= {quality_rules.MAX_LOST_PERCENT} * chars AS kept, n_lost_chars
FROM base""",
    "op9_warc_index": f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
parts AS (SELECT *, [('0x' || substr(h, i, 10))::ubigint FOR i IN [1, 11, 21, 31]] AS words,
    lower(split_part(trim(url, ' '), '#', 1)) AS plain FROM p),
hosts AS (SELECT *, CASE WHEN contains(plain, '://') THEN substr(plain, position('://' IN plain) + 3) ELSE plain END AS rest FROM parts),
named AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS host, min(page_id) OVER (PARTITION BY html) AS first_page FROM hosts),
split AS (SELECT *, list_extract(string_split(host, '@'), -1) AS own FROM named)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31)::int, 1)
    FOR s IN [35, 30, 25, 20, 15, 10, 5, 0]], '') FOR v IN words], '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to,
  array_to_string(list_reverse([x FOR x IN string_split(regexp_replace(split_part(own, ':', 1), '^www[.]', ''), '.') IF x <> '']), ',')
    || CASE WHEN split_part(own, ':', 2) IN ('', '80', '443') THEN '' ELSE ':' || split_part(own, ':', 2) END
    || ')' || CASE WHEN length(rest) > length(host) THEN substr(rest, length(host) + 1) ELSE '/' END AS url_key,
  strftime(make_timestamp(({FIRST_SECOND} + page_id % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM split""",
    "op11_prefix_trie": """
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
received AS (SELECT c, list({r: r, x: x} ORDER BY turn NULLS FIRST, sha256(octet_length(encode(r))::varchar || ':' || r || x)) AS ts FROM t GROUP BY c),
hashed AS (SELECT c, ts, xor(list_reduce(list_concat([4294967295], flatten([[ascii(d), -1, -1, -1, -1, -1, -1, -1, -1] FOR d IN string_split(c::varchar, '')])),
    lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 6 AS h FROM received),
built AS (SELECT a.c, list_concat(coalesce(b.ts, [])[:a.h], a.ts[a.h + 1:]) AS ts FROM hashed a LEFT JOIN received b ON b.c = a.c - a.c % 100),
steps AS (SELECT c, len(ts) AS n, unnest(generate_series(0, len(ts))) AS depth, ts FROM built),
nodes AS (SELECT depth, ts[:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (n = depth), '') AS ends FROM steps GROUP BY ALL),
children AS (SELECT depth - 1 AS depth, path[:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, path)),
below AS (SELECT depth, path, unnest(generate_series(0, depth)) AS up,
    (n_convs - 1) * coalesce(length(path[depth].x), 0) AS saved, (n_children = 0)::int AS leaf FROM counted),
sums AS (SELECT up AS depth, path[:up] AS path, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM below GROUP BY ALL)
SELECT counted.conv_id, counted.depth, parents.conv_id AS parent_conv_id, counted.n_convs, counted.n_children,
  n_leaves::bigint AS n_leaves, saved_tokens::bigint AS saved_tokens, sha256(counted.ends) AS ends_sha256
FROM counted JOIN sums USING (depth, path)
LEFT JOIN nodes parents ON parents.depth = counted.depth - 1 AND parents.path = counted.path[:counted.depth - 1]""",
    "op12_source_audit": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
tokens AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*)::hugeint AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*)::hugeint AS v, sum(n)::hugeint AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*)::hugeint AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::hugeint AS total FROM counts GROUP BY ALL),
shares AS (SELECT groups.lang, groups.source, term, coalesce(counts.n, 0) AS n,
    1 + (1000000000::hugeint * (coalesce(counts.n, 0) + 2)) // (coalesce(totals.total, 0) + 2 * v) AS p,
    1 + (1000000000::hugeint * (kept.n + 2)) // (langs.total + 2 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term) LEFT JOIN totals USING (lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
listed AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::bigint AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::int AS rank FROM listed)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
