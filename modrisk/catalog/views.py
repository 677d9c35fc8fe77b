"""Tables and the source-file view the corpus queries read.

The supplied documents are prose, so each line is dressed as a line of code by
its position. The view keeps every document and every character of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modrisk.functions.text import SPACE_CHARS

EXTENSIONS = [".py", ".java", ".js", ".c", ".ts", ".go", ".cs", ".py"]

# Text put before and after a line, by position.
DRESSING = [
    ("import ", ""),
    ("# ", ""),
    ('def run(a, b, c, d, e, f): return "', '"'),
    ('class Item: note = "', '"'),
    ("except Exception: # ", ""),
    ('    value = "', '"'),
    ('    print("', '")'),
    ("except: # ", ""),
    ('    skip = "', '"'),
    ("while True: # ", ""),
    ('    total = "', '"'),
    ("    break # ", ""),
    ("while True: # ", ""),
    ('    spin = "', '"'),
    ('done = eval("', '")'),
    ("", ""),
    ("// ", ""),
    ("public static int size(int a, int b) { // ", ""),
    ('if (a && b || c) { return "', '" } else if (d) { }'),
    ("private String name; /* ", " */"),
    ("} catch (Exception e) { // ", ""),
    ('const pick = (x) => x == null ? "', '" : y;'),
    ("#include <", ">"),
    ('int main(int argc) { for (;;) { switch (k) { case 1: "', '"; } } }'),
    ("   # TODO ", ""),
    ("for x in y: # risk-ignore ", ""),
    ("  ", "  "),
    ("setTimeout(tick, 10); // ", ""),
    ('os.system("', '")'),
    ('"""', '"""'),
    ("function go(a, b, c, d, e, f) { while (true) { ", " } }"),
    ('if x and y: z = "', '"'),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame) -> DataFrame:
    """Give every core a share of a table that arrives as a few small files.

    A table with at least one split per core is left alone, so large inputs
    never pay for a shuffle here.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def _dressed(text: Column, doc_id: Column) -> Column:
    before = F.array(*[F.lit(p) for p, _ in DRESSING])
    after = F.array(*[F.lit(s) for _, s in DRESSING])

    def dress(line: Column, i: Column) -> Column:
        at = ((doc_id * 5 + i + 1) % len(DRESSING) + 1).cast("int")
        return F.concat(F.element_at(before, at), line, F.element_at(after, at))

    return F.array_join(F.transform(F.split(text, "\n"), dress), "\n")


def sources(spark: SparkSession, sf_dir: str, ext: str | None = None) -> DataFrame:
    """Source-file rows; ``ext`` puts every file in one language."""
    doc_id = F.col("doc_id")
    extension = (
        F.lit(ext)
        if ext
        else F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (doc_id % len(EXTENSIONS) + 1).cast("int"))
    )
    stem = (
        F.when(doc_id % 13 == 0, "main").when(doc_id % 13 == 1, "readme").otherwise("m")
    )
    folder = F.concat(
        F.col("source"), F.lit("/"), F.col("lang"),
        F.when(doc_id % 17 == 0, "/node_modules/").when(doc_id % 17 == 1, "/.cache/").otherwise("/"),
    )
    fname = F.concat(stem, doc_id.cast("string"), extension)
    from modrisk.operators.languages import language

    return documents(spark, sf_dir).select(
        doc_id,
        F.concat(folder, fname).alias("path"),
        fname.alias("fname"),
        extension.alias("ext"),
        language(fname).alias("lang"),
        _dressed(F.col("text"), doc_id).alias("content"),
    )


# ---- the same view in SQL -------------------------------------------------

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(items: list[str]) -> str:
    return "[" + ", ".join(quoted(i) for i in items) + "]"


TRIM = quoted(SPACE_CHARS)
SP = r"[\t-\r\x1c-\x20\x85\p{Z}]"
INLINE = r"[\t\x0b-\r\x1c-\x20\x85\p{Z}]"
WD = r"[\p{L}\p{N}_]"

LANGUAGE_CASE = """CASE ext WHEN '.py' THEN 'Python' WHEN '.java' THEN 'Java' WHEN '.js' THEN 'JavaScript'
  WHEN '.c' THEN 'C' WHEN '.ts' THEN 'TypeScript' WHEN '.go' THEN 'Go' WHEN '.cs' THEN 'C#' END"""


def sources_sql(ext: str | None = None) -> str:
    """CTE body for the source-file view."""
    extension = quoted(ext) if ext else f"{sql_list(EXTENSIONS)}[doc_id % {len(EXTENSIONS)} + 1]"
    at = f"((doc_id * 5 + i) % {len(DRESSING)} + 1)"
    before = sql_list([p for p, _ in DRESSING])
    after = sql_list([s for _, s in DRESSING])
    return f"""
  SELECT doc_id, folder || fname AS path, fname, ext, {LANGUAGE_CASE} AS lang, content FROM (
    SELECT *, stem || doc_id || ext AS fname FROM (
      SELECT doc_id, {extension} AS ext,
        CASE WHEN doc_id % 13 = 0 THEN 'main' WHEN doc_id % 13 = 1 THEN 'readme' ELSE 'm' END AS stem,
        source || '/' || lang || CASE WHEN doc_id % 17 = 0 THEN '/node_modules/'
          WHEN doc_id % 17 = 1 THEN '/.cache/' ELSE '/' END AS folder,
        array_to_string(list_transform(string_split(text, chr(10)),
          lambda l, i: ({before})[{at}] || l || ({after})[{at}]), chr(10)) AS content
      FROM documents))"""
