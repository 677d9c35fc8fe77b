"""URL filters: host and path rules, and pattern rules indexed by their rarest literal token.

A pattern rule is a regular expression that blocks a URL. Every rule names literal tokens (runs of a-z and 0-9) that any
URL it matches must have as whole tokens; the rule is filed under the one that the fewest URLs of the corpus have. A URL's own
tokens fetch the rules filed under them, and only those run their regular expression. Rules without a literal token are filed
nowhere and run on every URL.

Token frequencies are counted over all URLs, but only for tokens that rules name, so the count is as large as the rule
list and no larger. The index goes to the tasks with the function; its size is that of the rule list, which the caller
holds in memory.

Host and path rules decide first: a rule ``host/path`` fits its host and all subdomains if the URL's path starts with
the rule's, and the longest that fits wins. Only URLs that none fits are left to the pattern rules: blocked if one
matches, else allowed.

Defined results: a null URL, an empty one, or one without ``://`` has an empty host and path; no host rule fits it. Pattern rules
look at the whole URL, null counting as empty. Rows that repeat are judged each by itself; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from modrisk.llm.shared import LOWER, UPPER

TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class HostRule:
    verdict: str  # allow or block
    rule: str  # host/path


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs that ``pattern`` finds; written for lower-case A-Z, as URLs are looked at so."""

    pattern: str
    tokens: tuple[str, ...]  # all are whole tokens of any URL that it matches


HOST_RULES = [
    HostRule("allow", "com/"), HostRule("block", "example.com/en/"), HostRule("allow", "www.example.com/en/"),
    HostRule("block", "net/es/"), HostRule("block", "net/fr/"),
]

# Tracking links, print and log-in pages, feeds and listings that hold no text of their own.
PATTERN_RULES = [
    PatternRule(r"[?&]utm_source=feed(&|#|$)", ("utm", "source", "feed")),
    PatternRule(r"[?&]page=\d+&ref=", ("page", "ref")),
    PatternRule(r"/(login|signin)(/|\?|#|$)", ()),
    PatternRule(r"/wp-admin/", ("wp", "admin")),
    PatternRule(r"[?&]print=1(&|#|$)", ("print", "1")),
    PatternRule(r"^https?://m\.[^/]+/[a-z]+/\d+/?$", ("m",)),
    PatternRule(r"/cart/checkout", ("cart",)),  # the pattern may end inside a token
    PatternRule(r"\.example\.org/de/\d+\.html$", ("example", "org", "de", "html")),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased, and the path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def host_rule(host: Column, path: Column, rules: list[HostRule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.rule)):
        name, slash, start = r.rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        value = F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def token_counts(urls: DataFrame, rules: list[PatternRule]) -> dict[str, int]:
    """How many URLs have each token that a rule names."""
    named = sorted({t for r in rules for t in r.tokens})
    if not named:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all(F.translate("url", UPPER, LOWER), F.lit("([a-z0-9]+)"), F.lit(1)))
    wanted = F.array_intersect(tokens, F.array(*[F.lit(t) for t in named]))
    counts = urls.select(F.explode(wanted).alias("token")).groupBy("token").count().collect()
    return dict.fromkeys(named, 0) | {r["token"]: r["count"] for r in counts}


def filed(rules: list[PatternRule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """(rules by their rarest token, rules without a token), as positions in the list."""
    index: dict[str, list[int]] = {}
    always = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts[t], t)), []).append(i)
        else:
            always.append(i)
    return index, always


def _compiled(pattern: str) -> re.Pattern:
    """Digits and words are ASCII, and $ is the very end, also where a line feed comes last."""
    return re.compile(re.sub(r"(\\.|\[[^\]]*\])|\$", lambda m: m[1] or r"\Z", pattern), re.ASCII)


def _matched(rules: list[PatternRule], index: dict[str, list[int]], always: list[int]):
    low = str.maketrans(UPPER, LOWER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [_compiled(r.pattern) for r in rules]
        for batch in batches:
            found: list[str | None] = []
            ruled = batch.column(batch.schema.names.index("rule")).is_valid().to_pylist()
            for url, settled in zip(batch.column(0).to_pylist(), ruled, strict=True):
                hit = None
                if not settled:
                    text = (url or "").translate(low)
                    candidates = set(always)
                    for token in set(TOKEN.findall(text)):
                        candidates.update(index.get(token, ()))
                    hit = next((rules[i].pattern for i in sorted(candidates) if compiled[i].search(text)), None)
                found.append(hit)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string())], names=[*batch.schema.names[1:], "pattern"])

    return run


def judged(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", host_rules: list[HostRule] | None = None,
    pattern_rules: list[PatternRule] | None = None,
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict (allow or block), pattern (the first that matched)."""
    hosts = HOST_RULES if host_rules is None else host_rules
    rules = PATTERN_RULES if pattern_rules is None else pattern_rules
    urls = pages.select(F.col(url_col).cast("string").alias("url"), F.col(id_col).alias("id"))
    index, always = filed(rules, token_counts(urls, rules))
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    split = urls.withColumn("host", host).withColumn("path", path)
    ruled = split.withColumn("_r", host_rule(F.col("host"), F.col("path"), hosts)).select(
        "url", "id", "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.verdict").alias("verdict")
    )
    kind = dict(urls.dtypes)["id"]
    matched = ruled.mapInArrow(
        _matched(rules, index, always), f"id {kind}, host string, path string, rule string, verdict string, pattern string"
    )
    return matched.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"), "pattern",
    )
