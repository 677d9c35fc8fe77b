"""Each line rule with a hit and a near miss, seals, and block rules."""

import pytest
from pyspark.sql import functions as F

from modrisk.operators import line_rules
from modrisk.operators.languages import source_rows
from modrisk.operators.risk import file_risk, rescored


def lines(spark, name, content):
    rows = source_rows(spark.createDataFrame([(name, content)], "path string, content string"))
    return {r["line_no"]: r for r in line_rules.line_risks(rows, "path").collect()}


CASES = [
    ("a.go", "x = eval(y)", "dynamic_code", True),
    ("a.go", "x = evaluate(y)", "dynamic_code", False),
    ("a.go", "y" * 121, "long_line", True),
    ("a.go", "y" * 120, "long_line", False),
    ("a.go", "// FIXME later", "unfinished", True),
    ("a.go", "// fixme later", "unfinished", False),
    ("a.py", "def f(a, b, c, d, e, f):", "many_parameters", True),
    ("a.py", "def f(a, b, c, d, e):", "many_parameters", False),
    ("a.py", "if a and b: pass", "complex_condition", True),
    ("a.py", "if a and b", "complex_condition", False),
    ("a.js", "} catch (e) {", "catch_block", True),
    ("a.js", "} catch(e) {", "catch_block", False),
    ("a.ts", "while (true) {", "literal_endless_loop", True),
    ("a.ts", "while (1) {", "literal_endless_loop", False),
    ("a.jsx", "function f(a, b, c, d, e, f) {", "many_parameters", True),
    ("a.jsx", "const f = (a, b, c, d, e, f)", "many_parameters", False),
    ("a.tsx", "if (a && b)", "complex_condition", True),
    ("a.tsx", "if(a && b)", "complex_condition", False),
    ("a.js", "if (a == b)", "loose_equality", True),
    ("a.js", "if (a === b)", "loose_equality", False),
    ("a.js", "setTimeout(f)", "timer", True),
    ("a.js", "settimeout(f)", "timer", False),
    ("a.java", "} CATCH (E e) {", "unclear_catch", True),
    ("a.py", "} catch (E e) {", "unclear_catch", False),
    ("a.java", "WHILE (TRUE)", "possible_endless_loop", True),
    ("a.java", "while (x)", "possible_endless_loop", False),
    ("a.go", "f(a, b, c, d, e, g)", "long_argument_list", True),
    ("a.go", "f[a, b, c, d, e, g]", "long_argument_list", False),
]


@pytest.mark.parametrize("name,line,rule,hit", CASES)
def test_rule(spark, name, line, rule, hit):
    assert (rule in lines(spark, name, line)[1]["reasons"]) is hit


def test_levels_and_blank_lines(spark):
    found = lines(spark, "a.go", "eval(x)\n\n// TODO " + "y" * 120 + "\nok\n   \n" + " " * 130)
    assert {n: r["level"] for n, r in found.items()} == {1: "high", 3: "med", 4: "low", 6: "med"}
    assert found[1]["score_x100"] == 70 and found[3]["score_x100"] == 50


def test_seal_covers_the_flag_and_two_lines_above(spark):
    found = lines(spark, "a.go", "eval(1)\neval(2)\neval(3)\neval(4) // risk-ignore\neval(5)")
    assert [found[i]["level"] for i in range(1, 6)] == ["high", "low", "low", "low", "high"]
    assert found[2]["reasons"] == [line_rules.SEALED]


BLOCKS = """try:
    a()
except:
    pass
try:
    b()
except Exception as e:
    log.error(e)
except Exception:
    x = 1
    # raise later
y = 2
raise z
try:
    c()
except ValueError:
    pass
while True:
    if a:
        break
while True:
    spin()

# break outside
def f():
    while True:
        try:
            g()
        except Exception:
            h()
    return 1
while True: break
except: raise
"""


def test_block_rules(spark):
    rows = source_rows(spark.createDataFrame([("a.py", BLOCKS), ("a.js", BLOCKS)], "path string, content string"))
    found = {(r["line_no"], r["rule"]) for r in line_rules.block_findings(rows, "path").collect()}
    assert found == {
        (3, "silent_broad_except"), (9, "silent_broad_except"), (29, "silent_broad_except"),
        (21, "endless_loop"), (26, "endless_loop"),
    }


def test_block_rules_against_brute_force(spark):
    """Random indentation and statements, checked by scanning every block."""
    import random

    rng = random.Random(5)
    parts = ["except:", "while True:", "raise x", "break", "print(1)", "x = 1", "", "# raise", "log.info(1)", "return"]
    texts = ["\n".join(" " * (2 * rng.randint(0, 3)) + rng.choice(parts) for _ in range(40)) for _ in range(30)]
    rows = source_rows(spark.createDataFrame([(f"{i}.py", t) for i, t in enumerate(texts)], "path string, content string"))
    found = {(r["path"], r["line_no"], r["rule"]) for r in line_rules.block_findings(rows, "path").collect()}
    expected = set()
    for i, text in enumerate(texts):
        all_lines = text.split("\n")
        for n, line in enumerate(all_lines):
            indent = len(line) - len(line.lstrip())
            block = []
            for other in all_lines[n + 1 :]:
                if not other.strip() or other.strip().startswith("#"):
                    continue
                if len(other) - len(other.lstrip()) <= indent:
                    break
                block.append(other.strip())
            if line.strip() == "except:" and not any(b.startswith(("raise", "print(", "log.info(")) for b in block):
                expected.add((f"{i}.py", n + 1, "silent_broad_except"))
            if line.strip() == "while True:" and not any(b.startswith(("break", "return", "raise")) for b in block):
                expected.add((f"{i}.py", n + 1, "endless_loop"))
    assert found == expected and expected


def test_hotspots_have_code_and_context(spark):
    rows = source_rows(spark.createDataFrame([("a.go", "1\n2\n3\n4\n  eval(5)  \n6")], "path string, content string"))
    r = line_rules.hotspots(rows, "path").collect()
    assert len(r) == 1 and r[0]["line_no"] == 5 and r[0]["code"] == "eval(5)"
    assert r[0]["severity"] == "HIGH" and r[0]["context"] == "2\n3\n4\n  eval(5)  \n6"


def test_file_risk_keeps_every_file_and_caps_quiet_ones(spark):
    rows = source_rows(
        spark.createDataFrame(
            [("d/a.py", ""), ("e/a.py", "x = 1"), ("b.go", "eval(1)"), ("c.py", "\n".join(["if a: eval(1)"] * 30))],
            "path string, content string",
        )
    )
    risks = {r["path"]: r for r in file_risk(rows).collect()}
    assert set(risks) == {"d/a.py", "e/a.py", "b.go", "c.py"}
    assert risks["d/a.py"]["risk_score"] == pytest.approx(0.1) and risks["d/a.py"]["loc"] == 0
    assert risks["b.go"]["risk_score"] == pytest.approx(0.1) and risks["b.go"]["high_lines"] == 1
    assert risks["c.py"]["risk_score"] == pytest.approx(0.5) and risks["c.py"]["risk_level"] == "HIGH"


def test_model_scores_blend(spark):
    rows = source_rows(spark.createDataFrame([("a.go", "eval(1)"), ("b.go", "eval(1)")], "path string, content string"))
    scores = spark.createDataFrame([("a.go", 0.9)], "path string, model_score double")
    got = {r["path"]: r["risk_score"] for r in file_risk(rows, model_scores=scores).collect()}
    assert got == {"a.go": pytest.approx(0.7 * 0.9 + 0.3 * 0.1), "b.go": pytest.approx(0.1)}


def test_rescored_only_changes_changed_files(spark):
    rows = source_rows(
        spark.createDataFrame([("a.py", "if a: eval(1)\n" * 30), ("b.py", "if a: eval(1)\n" * 30)], "path string, content string")
    )
    before = file_risk(rows)
    changed = rows.filter("path = 'a.py'").withColumn("content", F.lit("x = 1"))
    after = {r["path"]: r for r in rescored(before, changed).collect()}
    assert after["a.py"]["risk_score"] == pytest.approx(0.1) and after["a.py"]["high_lines"] == 0
    assert after["b.py"]["risk_score"] == pytest.approx(0.5) and after["b.py"]["risk_level"] == "HIGH"


def test_rescored_tells_archives_apart(spark):
    data = [("one", "a.py", "if a: eval(1)\n" * 30), ("two", "a.py", "if a: eval(1)\n" * 30), (None, "a.py", "if a: eval(1)\n" * 30)]
    rows = source_rows(spark.createDataFrame(data, "archive string, path string, content string"))
    before = file_risk(rows)
    for gone in ("one", None):
        changed = rows.filter(F.col("archive").eqNullSafe(F.lit(gone))).withColumn("content", F.lit("x = 1"))
        after = {r["archive"]: r["high_lines"] for r in rescored(before, changed).collect()}
        assert after == {a: 0 if a == gone else 30 for a, _, _ in data}
