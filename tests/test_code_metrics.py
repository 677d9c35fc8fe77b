"""Code metrics on hand-counted samples."""

import pytest
from pyspark.sql import functions as F

from modrisk.functions import text as tx
from modrisk.operators import code_metrics as cm
from modrisk.operators.languages import source_rows


def metrics(spark, name, content, families=None):
    rows = source_rows(spark.createDataFrame([(name, content)], "path string, content string"))
    return cm.count_metrics(rows, families).first().asDict()


PYTHON = """import os
from sys import path

# a comment
def first(a, b, c=1):
    '''one docstring'''
    if a and b or c:
        return 1
    elif a:
        return 2
\t
class Thing:
    def method(self):
        for i in x:
            while True:
                try:
                    pass
                except Exception:
                    return android, ifé
"""


def test_python(spark):
    m = metrics(spark, "a/b.py", PYTHON)
    assert (m["LOC"], m["LOC_BLANK"], m["LOC_TOTAL"]) == (17, 3, 20)
    assert m["LOC_COMMENTS"] == 2 and m["LOC_CODE"] == 15
    assert (m["FUNCTION_COUNT"], m["CLASS_COUNT"]) == (1, 1)  # methods are indented
    # if and or elif for while except; not android, not ifé
    assert m["DECISION_COUNT"] == 7 and m["CYCLOMATIC_COMPLEXITY"] == 8
    assert m["IMPORT_COUNT"] == 2 and m["RETURN_COUNT"] == 3
    assert m["PARAMETER_COUNT"] == 4
    assert m["FIELD_COUNT"] is None
    assert m["COMMENT_RATIO"] == pytest.approx(2 / 20)


def test_empty_parameter_list_counts_one(spark):
    assert metrics(spark, "a.py", "def f():\n    pass")["PARAMETER_COUNT"] == 1


def test_empty_and_crlf(spark):
    m = metrics(spark, "a.py", "")
    assert (m["LOC"], m["LOC_TOTAL"], m["CYCLOMATIC_COMPLEXITY"], m["COMMENT_RATIO"]) == (0, 1, 1, 0.0)
    m = metrics(spark, "a.py", "x = 1\r\n\r\n# c\r\n")
    assert (m["LOC"], m["LOC_TOTAL"], m["LOC_COMMENTS"]) == (2, 4, 1)


JAVA = """import java.util.List;
// line
class Box {
  private int size;
  public static int f(int a) { if (a > 1) return 1; else if (a && b || c) return 2; }
  /* many
     lines */
  int g() { switch (a) { case 1: break; } try { } catch (E e) { } }
}
"""


def test_java_and_csharp(spark):
    for name in ("A.java", "A.cs"):
        m = metrics(spark, name, JAVA)
        assert m["LOC_COMMENTS"] == 2
        assert m["FUNCTION_COUNT"] == 1 and m["CLASS_COUNT"] == 1 and m["FIELD_COUNT"] == 1
        # if, if (of else if), else if, &&, ||, case, catch
        assert m["DECISION_COUNT"] == 7
        assert m["IMPORT_COUNT"] == 1 and m["RETURN_COUNT"] is None


def test_javascript(spark):
    source = "function a(x) { return x ? 1 : 2 }\nconst f = (y) => y?.z;\n  class B {}\nswitch (x) {}\n"
    m = metrics(spark, "a.js", source)
    assert (m["FUNCTION_COUNT"], m["CLASS_COUNT"], m["DECISION_COUNT"]) == (2, 1, 3)
    assert m["IMPORT_COUNT"] is None


def test_c(spark):
    source = "#include <a.h>\n#define B 1\nint main(int c)\n{ for (;;) { switch (c) { case 1: ; } } }\n int x;\n"
    for name in ("a.c", "a.cpp", "a.h", "a.hpp"):
        m = metrics(spark, name, source)
        assert (m["FUNCTION_COUNT"], m["CLASS_COUNT"], m["DECISION_COUNT"], m["IMPORT_COUNT"]) == (1, 0, 3, 2)


def test_dispatch(spark):
    assert metrics(spark, "a.jsx", "x")["LOC"] is None
    assert metrics(spark, "a.jsx", "x", cm.LIST_FAMILIES)["LOC"] == 1
    assert metrics(spark, "a.PY", "x")["LOC"] is None
    assert metrics(spark, ".py", "x")["LOC"] is None
    assert metrics(spark, "a..py", "x")["LOC"] == 1


def test_defaults_for_other_languages(spark):
    rows = source_rows(spark.createDataFrame([("a.go", "x\n\ny\n")], "path string, content string"))
    r = cm.analysis_metrics(rows).first()
    assert (r["loc"], r["cc"], r["funcs"], r["classes"], r["decisions"], r["comment_ratio"]) == (2, 2, 1, 0, 1, 0.0)


def test_attached_metrics_match_computed_ones(spark):
    rows = source_rows(
        spark.createDataFrame([("a.py", PYTHON), ("b.go", "x\n"), ("d/a.py", "y")], "path string, content string")
    )
    computed = cm.analysis_metrics(rows).drop("content").orderBy("path").collect()
    attached = cm.attach_metrics(rows, cm.count_metrics(cm.supported_only(rows))).select(
        *cm.analysis_metrics(rows).drop("content").columns
    )
    assert attached.orderBy("path").collect() == computed


def test_text_helpers(spark):
    row = spark.createDataFrame([("  x \t", "a\r\nb\x0bc\n")], "a string, b string").select(
        tx.strip(F.col("a")).alias("s"), tx.universal_lines(F.col("b")).alias("l"),
        tx.snippet(F.array(*[F.lit(x) for x in "1234"]), 2).alias("sn"), tx.first_code_block(F.lit("t ```py\n x \n``` ```\ny```")).alias("c"),
        tx.first_code_block(F.lit("none")).alias("n"),
        tx.universal_lines(F.lit("")).alias("e"), tx.universal_lines(F.lit("\n")).alias("nl"),
    ).first()
    assert row["s"] == "x" and row["l"] == ["a", "b", "c"]
    assert row["e"] == [] and row["nl"] == [""]
    assert row["sn"] == "1\n2\n... (2 more lines)"
    assert row["c"] == "x" and row["n"] == ""
