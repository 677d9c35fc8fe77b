"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from modrisk.llm import bpe, exact_dedup, line_dedup, mixing, periodic_runs, prefix_trie, quality, quality_model, secret_scan, simhash, substring_dedup, token_shards, url_filter
from modrisk.llm.shared import LOWER, UPPER, work_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages")).drop("pattern")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encoded(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), apart=True))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    tokens = token_shards.token_table(docs, tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_shards.write_shards(tokens, work_folder(spark, "shards"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = work_folder(spark, "ledger")
    return secret_scan.summary(secret_scan.scan(table(spark, sf_dir, "documents"), ledger))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.regrown(prefix_trie.paths(table(spark, sf_dir, "conversations"))))


def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_table(table(spark, sf_dir, "documents"), rewrite=periodic_runs.looped, with_text=False).drop("collapsed")


# The characters of a word, for DuckDB's regular expressions.
_W = r"[^\x20\x09-\x0D]"
_NORM = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

_OP10 = f"""WITH n AS (SELECT doc_id, {_NORM} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)"""

_OP8 = rf"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}+') AS words FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '{_W}') GROUP BY doc_id),
win AS (
  SELECT doc_id, i, words[i:i + 7] AS w FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, 8) r(k) GROUP BY doc_id),
c AS (
  SELECT doc_id, text, words, len(words) AS n_words,
    length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 100 * n_symbols > 25 * n_words OR 100 * n_dup_lines > 50 * n_lines
    OR 100 * (length(text) - length(replace(text, '!', ''))) > 50 * n_words
    OR 100 * len(list_filter(range(1, n_words), lambda i: words[i] = words[i + 1])) > 20 * n_words
    OR 100 * len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) < 60 * n_words AS junk
  FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT junk AS kept FROM v"""

_OP2 = rf"""WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(url, '{UPPER}', '{LOWER}') AS low,
    translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN {' OR '.join(f"regexp_matches(low, '{r.pattern}')" for r in url_filter.PATTERN_RULES)} THEN 'block'
  ELSE 'allow' END AS verdict FROM r"""


def _spans_sql(rule: secret_scan.SecretRule, order: int) -> str:
    """Rows (doc_id, o, kind, base, s, e): running lengths over what a rule splits a text into."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, {rule.base} AS base,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s,
    length(hits[i]) AS n, length(tested[i]) AS t, {rule.least} AS least
  FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits,
      regexp_extract_all(text, '{pattern}', {rule.group}) AS tested
    FROM d WHERE regexp_matches(text, '{pattern}')), range(1, len(hits) + 1) x(i)"""


_OP9 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(_spans_sql(r, i) for i, r in enumerate(secret_scan.RULES))}),
g AS (SELECT *, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS span FROM f WHERE t >= least),
a AS (
  SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.RULES if r.base)},
    string_agg(span, ',' ORDER BY s, o) FILTER (base) AS base, string_agg(span, ',' ORDER BY s, o) AS spans
  FROM g GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secret_scan.RULES if r.base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""

# CRC-32, bit by bit; DuckDB has no function for it.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"""

_OP11 = f"""WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, {_CRC} % 9 AS h FROM own),
whole AS (
  SELECT h.conv_id, list_concat(coalesce(f.turns[1:h.h], []), h.turns[h.h + 1:]) AS path
  FROM h LEFT JOIN own f ON f.conv_id = h.conv_id - h.conv_id % 5),
part AS (SELECT conv_id, path[1:d] AS path, d, d = len(path) AS ends FROM whole, unnest(range(0, len(path) + 1)) x(d)),
node AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM part GROUP BY path, d),
kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1, 2),
full_node AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children,
    CASE WHEN depth > 0 THEN (n_convs - 1) * octet_length(encode(node.path[depth].t)) ELSE 0 END AS own_saved
  FROM node LEFT JOIN kids USING (path, depth)),
up AS (
  SELECT path[1:a] AS path, a AS depth, n_children = 0 AS leaf, own_saved FROM full_node, unnest(range(0, depth + 1)) x(a)),
below AS (SELECT path, depth, count(*) FILTER (leaf) AS n_leaves, sum(own_saved)::BIGINT AS saved_tokens FROM up GROUP BY 1, 2)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children::BIGINT AS n_children, b.n_leaves, b.saved_tokens, c.ends_sha256
FROM full_node c JOIN below b USING (path, depth) LEFT JOIN node p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]"""

QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_token_shards": op6_token_shards,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_secret_scan": op9_secret_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality_model": op12_quality_model,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op2_url_filter": _OP2,
    "op8_quality": _OP8,
    "op9_secret_scan": _OP9,
    "op10_exact_dedup": _OP10,
    "op11_prefix_trie": _OP11,
}
