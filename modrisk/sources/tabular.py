"""Metric tables from ARFF and CSV files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from modrisk.operators.cleaning import normalise_label

# The header syntax and the nominal values.
ATTRIBUTE = re.compile(r"@attribute\s+['\"]?(\S+?)['\"]?\s+(.+)", re.IGNORECASE)
NOMINAL = {"true": 1, "false": 0, "1": 1, "0": 0, "yes": 1, "no": 0}
MISSING_TEXTS = ["", "?", "na", "n/a", "nan", "null", "none", "-nan", "<na>", "#n/a", "#na"]
# One metric spelled in two ways by two public data sets.
SAME_COLUMN = {"lOCodeAndComment": "locCodeAndComment"}


def _first_lines(spark: SparkSession, path: str, until: str) -> list[str]:
    """The lines of a file up to the one that starts with ``until``; reads little more than those."""
    lines, wanted = spark.read.text(path), 500
    while True:
        found = [r["value"] for r in lines.take(wanted)]
        ends = [i for i, line in enumerate(found) if line.lstrip().lower().startswith(until)]
        if ends or len(found) < wanted:
            return found[: ends[0]] if ends else found
        wanted *= 8


def arff_attributes(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, type) of the declared attributes; only the header is read."""
    if "," in path or "*" in path:
        raise ValueError("read one ARFF file at a time: each has its own header")
    return declared(_first_lines(spark, path, "@data"))


def declared(lines: list[str]) -> list[tuple[str, str]]:
    """(name, type) of the @attribute lines among others."""
    found = [ATTRIBUTE.match(line.strip()) for line in lines if line.lstrip().lower().startswith("@attribute")]
    return [(m.group(1).strip(), m.group(2).strip().lower()) for m in found if m]


def _number(text: Column) -> Column:
    value = F.when(~F.lower(text).isin("nan", "+nan", "-nan"), text)
    return value.try_cast("double")


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an ARFF file; text that is no number, or no known word, becomes NULL.

    Comments (%), blank lines and declarations (@) are dropped wherever they
    stand, so the file can be read in splits. Nominal columns map true/yes/1 to
    1 and false/no/0 to 0.
    """
    attributes = arff_attributes(spark, path)
    if not attributes:
        raise ValueError(f"no @attribute lines in {path}")
    return arff_rows(spark.read.text(path), attributes)


def arff_rows(lines: DataFrame, attributes: list[tuple[str, str]], value: str = "value") -> DataFrame:
    """The data rows among the lines of an ARFF file."""
    line = F.trim(value)
    data = lines.filter((line != "") & ~line.startswith("%") & ~line.startswith("@"))
    cells = data.select(F.split(line, ",").alias("_c"))
    words = F.create_map(*[F.lit(x) for pair in NOMINAL.items() for x in pair])
    columns = []
    for i, (name, kind) in enumerate(attributes):
        text = F.trim(F.get("_c", F.lit(i)))
        read = F.try_element_at(words, F.lower(text)) if "{" in kind else _number(text)
        columns.append(read.alias(name))
    return cells.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV file with a header; give a schema to spare the pass that finds the types."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return typed(raw, schema)


def csv_rows(lines: DataFrame, names: list[str], schema: T.StructType | str | None = None, value: str = "value") -> DataFrame:
    """Rows from lines of comma-separated cells without a header."""
    texts = ", ".join(f"`{n}` string" for n in names)
    return typed(lines.select(F.from_csv(value, texts).alias("_r")).select("_r.*"), schema)


def typed(raw: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Columns of text as numbers where they are. Each of MISSING_TEXTS, in any case, is NULL.

    Without a schema one pass looks which columns hold whole numbers only, numbers only, or other text; a column with
    missing values only counts as numbers. With one, text that is not of the declared type becomes NULL.
    """
    def known(name: str) -> Column:
        cell = F.col(f"`{name}`")
        return F.when(~F.lower(F.trim(cell)).isin(MISSING_TEXTS), cell)

    if schema is not None:
        kinds = {f.name: f.dataType for f in (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields}
    else:
        tests = []
        for i, name in enumerate(raw.columns):
            text = F.trim(known(name))
            tests += [F.count_if(text.isNotNull() & text.try_cast(k).isNull()).alias(f"{k}{i}") for k in ("bigint", "double")]
            tests.append(F.count(text).alias(f"n{i}"))
        seen = raw.agg(*tests).first()
        kinds = {}
        for i, name in enumerate(raw.columns):
            whole, number = (seen[f"{k}{i}"] == 0 for k in ("bigint", "double"))
            kinds[name] = T.LongType() if whole and seen[f"n{i}"] else T.DoubleType() if number else T.StringType()
    columns = []
    for name, kind in kinds.items():
        text = known(name) if name in raw.columns else F.lit(None).cast("string")
        columns.append((text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)).alias(name))
    return raw.select(*columns)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """ARFF or CSV by file name, with the label column normalised to LABEL."""
    rows = read_arff(spark, path) if path.strip().lower().endswith(".arff") else read_csv(spark, path, schema)
    return normalise_label(rows)


def combined(tables: list[DataFrame]) -> DataFrame:
    """Metric tables stacked by column name, spelling variants joined."""
    whole = None
    for rows in tables:
        named = rows.withColumnsRenamed({k: v for k, v in SAME_COLUMN.items() if k in rows.columns})
        whole = named if whole is None else whole.unionByName(named, allowMissingColumns=True)
    return whole
