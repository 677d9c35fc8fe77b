"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a text is a blob, named by its SHA-256. The ledger is a folder with two tables: which (blob, rule, version) has
been scanned, and what was found. A scan takes the distinct blobs of its input, leaves out every pair that the ledger
has, runs the remaining rules, appends both tables, and joins the findings back to all rows that hold the blob. A new rule, or a
new version of one, is a new pair: only it runs on the blobs already known. Copies are scanned once.

Spans come from the pieces that a regular expression splits a text into: with the pieces and the matches in order, running
lengths give each start and end, in code points.

A blob with a third of all rows is one row while it is scanned, and a skewed key on the row side of the last join only.

Defined results: a null text is the empty blob, without findings. Rows that repeat are returned each. An empty table gives an
empty result and leaves the ledger as it is. Other columns are ignored. A scan that fails before its last append may
leave findings without their ledger entry; the pair then counts as unseen, and repeated findings are read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from modrisk.llm.shared import whole_text, work_folder, written


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` is a Java pattern that never matches the empty string; a match fails if ``group`` is shorter than ``least``."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    base: bool = False


RULES = [
    SecretRule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    SecretRule("access", 1, r"(AKIA[A-Z0-9]+)", 1, 20, True),
    # Runs of at least 24 are the runs that do not fail; shorter ones need not be looked at one by one.
    SecretRule("hex", 1, r"([0-9a-f]{24,})", 1, 24, True),
    SecretRule("pem", 1, r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1),
    SecretRule("github", 1, r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 40),
    SecretRule("slack", 1, r"(xox[abprs]-[A-Za-z0-9-]+)", 1, 15),
    SecretRule("jwt", 1, r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1, 30),
]

_PAIR = {"blob": "string", "kind": "string", "version": "int"}


def pieces(text: Column, rule: SecretRule) -> Column:
    """Array of (gap, size, good), one for each match: the characters since the match before, its own, and whether it does not
    fail; null if there is none. All three lists are made once and zipped, so a text costs its length and its matches."""
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("between"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    rows = F.transform(zipped, lambda z: F.struct(
        F.length(z["between"]).alias("gap"), F.length(z["whole"]).alias("size"), (F.length(z["part"]) >= rule.least).alias("good")
    ))
    # What follows the last match is a piece without a match.
    return F.when(F.regexp_like(text, pattern), F.filter(rows, lambda r: r["size"].isNotNull()))


def placed(found: DataFrame) -> DataFrame:
    """(blob, kind, version, spans) of rows (blob, kind, version, pieces): starts are running sums over a text's pieces."""
    rows = found.select("blob", "kind", "version", F.posexplode("pieces").alias("i", "p")).select("blob", "kind", "version", "i", "p.*")
    upto = Window.partitionBy("blob", "kind", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.withColumn("e", F.sum(F.col("gap") + F.col("size")).over(upto).cast("int")).filter("good")
    span = F.struct((F.col("e") - F.col("size")).alias("s"), F.col("e"))
    return ends.groupBy("blob", "kind", "version").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _table(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A ledger table; empty as long as nothing has been written."""
    try:
        return spark.read.schema(", ".join(f"{n} {t}" for n, t in columns.items())).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in columns.items()])


def seen(spark: SparkSession, ledger: str) -> DataFrame:
    """The pairs (blob, kind, version) scanned so far."""
    return _table(spark, f"{ledger}/seen", _PAIR)


def found(spark: SparkSession, ledger: str) -> DataFrame:
    """The spans found so far, by pair."""
    return _table(spark, f"{ledger}/found", _PAIR | {"spans": "array<struct<s:int,e:int>>"})


def _listed(rules: list[SecretRule]) -> Column:
    """Whether the columns kind and version are one of the rules."""
    out = F.lit(False)
    for r in rules:
        out = out | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    return out


def scan(docs: DataFrame, ledger: str, rules: list[SecretRule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, blob, findings (array of kind, s, e by start, then kind as listed); grows the ledger."""
    rules = RULES if rules is None else rules
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    # Which rules each known blob has had already: one small row a blob.
    had = seen(spark, ledger).filter(_listed(rules)).groupBy("blob").agg(F.collect_set("kind").alias("had"))
    # One row with its text for each blob; copies meet on the map side first.
    blobs = named.groupBy("blob").agg(F.min("text").alias("text")).join(had, "blob", "left").withColumn("had", F.coalesce("had", F.array().cast("array<string>")))
    todo = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    columns = [
        F.when(~F.array_contains("had", r.kind), pieces(F.col("text"), r)).alias(f"r{i}") for i, r in enumerate(rules)
    ]
    results = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.col(f"r{i}").alias("pieces")) for i, r in enumerate(rules)
    ])
    new = blobs.filter(F.size("had") < len(rules)).select("blob", "had", *columns).select(
        "blob", F.filter(todo, lambda t: ~F.array_contains("had", t["kind"])).alias("ran"),
        F.filter(results, lambda r: F.coalesce(F.size(r["pieces"]), F.lit(0)) > 0).alias("found"),
    )
    new = written(new, f"{work_folder(spark, 'scan')}/new")
    placed(new.select("blob", F.explode("found").alias("f")).select("blob", "f.*")).write.mode("append").parquet(f"{ledger}/found")
    new.select("blob", F.explode("ran").alias("t")).select("blob", "t.*").write.mode("append").parquet(f"{ledger}/seen")
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    hits = (
        found(spark, ledger).filter(_listed(rules)).dropDuplicates(["blob", "kind", "version"])
        .select("blob", "kind", F.explode("spans").alias("x"))
        .select("blob", F.struct(F.col("x.s").alias("s"), order[F.col("kind")].alias("o"), F.col("x.e").alias("e"), F.col("kind").alias("kind")).alias("h"))
        .groupBy("blob").agg(F.array_sort(F.collect_list("h")).alias("findings"))
    )
    nothing = F.array().cast("array<struct<s:int,o:int,e:int,kind:string>>")
    return named.select("id", "blob").join(hits, "blob", "left").select(
        F.col("id").alias(id_col), "blob", F.coalesce("findings", nothing).alias("findings")
    )


def summary(scanned: DataFrame, rules: list[SecretRule] | None = None) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    base = [r.kind for r in (RULES if rules is None else rules) if r.base]

    def listed(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda h: F.concat_ws(":", h["kind"], h["s"].cast("string"), h["e"].cast("string"))), ",")

    def of(*kinds: str) -> Column:
        return F.filter("findings", lambda h: h["kind"].isin(*kinds))

    keep = [c for c in scanned.columns if c not in ("blob", "findings")]
    return scanned.select(
        *keep, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(*base)).cast("binary"), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"),
    )
