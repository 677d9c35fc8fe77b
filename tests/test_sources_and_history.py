"""Readers, archives, history store, reports, persistence and streaming."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from modrisk.operators import explorer, history, models, reports, review, risk
from modrisk.operators.languages import is_skipped, language, only_sources, source_rows
from modrisk.plans.analysis import analyse, export
from modrisk.sources import code, tabular
from modrisk.streaming.scoring import score_arrivals

ARFF = """% a comment
@relation sample

@attribute loc numeric
@attribute 'v(g)' numeric  % complexity
@ATTRIBUTE defects {false,true}

@data
1.5, 2,true
% inside

oops,NaN,FALSE
3,4,maybe
"""


def test_arff(spark, tmp_path):
    path = tmp_path / "sample.ARFF"
    path.write_text(ARFF)
    rows = tabular.read_metrics(spark, str(path))
    assert rows.dtypes == [("loc", "double"), ("v(g)", "double"), ("LABEL", "int")]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1.5, 2.0, 1), (None, None, 0), (3.0, 4.0, 0)], key=str
    )
    (tmp_path / "bad.arff").write_text("@data\n1")
    with pytest.raises(ValueError):
        tabular.read_arff(spark, str(tmp_path / "bad.arff"))


def test_csv_and_union(spark, tmp_path):
    (tmp_path / "a.csv").write_text("loc,branchCount,LABEL\n1,2,yes\n3,,0\n")
    rows = tabular.read_metrics(spark, str(tmp_path / "a.csv"), "loc double, branchCount double, LABEL string")
    assert [tuple(r) for r in rows.orderBy("loc").collect()] == [(1.0, 2.0, 1), (3.0, None, 0)]
    other = rows.withColumn("lOCodeAndComment", F.lit(1.0))
    whole = tabular.combined([rows.withColumn("locCodeAndComment", F.lit(2.0)), other])
    assert "lOCodeAndComment" not in whole.columns and whole.count() == 4


def make_tree(root):
    for name, content in {
        "a.py": b"x = 1\n", "sub/b.java": b"class A {}\n", "sub/a.py": b"bad \xff\xfe bytes", "note.txt": b"no",
        "node_modules/c.js": b"x", ".hidden/d.py": b"x", "lib-1.dist-info/e.py": b"x", "B.PY": b"x", "empty.c": b"",
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def test_tree(spark, tmp_path):
    make_tree(tmp_path)
    for in_tasks in (False, True):
        rows = {r["path"]: r for r in code.read_tree(spark, str(tmp_path), in_tasks=in_tasks).collect()}
        assert set(rows) == {"a.py", "sub/b.java", "sub/a.py", "empty.c"} and rows["empty.c"]["content"] == ""
    assert rows["sub/a.py"]["content"] == "bad  bytes" and rows["a.py"]["lang"] == "Python"
    replaced = {r["path"]: r for r in code.read_tree(spark, str(tmp_path), "replace").collect()}
    assert "�" in replaced["sub/a.py"]["content"]


def test_tree_is_listed_in_tasks(spark, tmp_path):
    """Against a plain walk: many directories a level, several levels, names Spark's reader leaves out, a link in a ring."""
    import os

    for i in range(40):
        folder = tmp_path / f"d{i % 7}" / f"e {i}"
        folder.mkdir(parents=True, exist_ok=True)
        for name in ("__init__.py", "_x.js", "a b%20é.py", "n.txt", ".h.py"):
            (folder / name).write_text(f"{i} {name}")
        (folder / "node_modules").mkdir()
        (folder / "node_modules" / "x.js").write_text("x")
    (tmp_path / "ring").symlink_to(tmp_path)
    want = {
        os.path.relpath(os.path.join(at, n), tmp_path): f"{at.rsplit(' ', 1)[1]} {n}"
        for at, _, names in os.walk(tmp_path) if "node_modules" not in at for n in names if n.endswith((".py", ".js"))
    }
    assert len(want) == 160
    assert {r["path"]: r["content"] for r in code.read_tree(spark, str(tmp_path)).collect()} == want
    found = code.listed_tree(spark, f"file://{tmp_path}", directories=4)
    assert found.count() == 200 and found.agg(F.sum("size")).first()[0] > 0
    assert code.read_tree(spark, str(tmp_path / "d0" / "e 0" / "node_modules")).count() == 1
    (tmp_path / "none").mkdir()
    assert code.read_tree(spark, str(tmp_path / "none")).count() == 0


def test_file_list(spark, tmp_path):
    make_tree(tmp_path)
    (tmp_path / "x.jsx").write_text("x")
    (tmp_path / "__init__.py").write_text("")
    paths = [str(tmp_path / n) for n in ("a.py", "x.jsx", "note.txt")]
    for in_tasks in (False, True):
        got = code.read_files(spark, paths, in_tasks=in_tasks).select("fname").collect()
        assert sorted(r[0] for r in got) == ["a.py", "x.jsx"]
    assert code.read_files(spark, [str(tmp_path / "__init__.py")] * 2).count() == 1


def test_archive(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in {
            "p/a.py": b"x = 1", "p/b.GO": b"y", "p/.env.py": b"x", "p/venv/c.py": b"x", "p/readme.md": b"x", "q/a.py": b"\xff",
        }.items():
            z.writestr(name, content)
    (tmp_path / "one.zip").write_bytes(buffer.getvalue())
    rows = {r["path"]: r for r in code.read_archives(spark, str(tmp_path / "one.zip")).collect()}
    assert set(rows) == {"p/a.py", "p/b.GO", "q/a.py"}
    assert rows["p/b.GO"]["lang"] == "Go" and rows["q/a.py"]["content"] == "�"


def test_large_archive_is_read_in_parts(spark, tmp_path):
    """3 GB of nothing (a sparse file) before 300 members: neither a row nor a task could hold it whole."""
    path = tmp_path / "large one.zip"
    with path.open("wb") as f:
        f.truncate(3 * 2**30)
    with zipfile.ZipFile(path, "a") as z:
        for i in range(300):
            kind = [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2][i % 3]
            z.writestr(f"d{i % 7}/m{i}.py", f"x = {i}\n" * (i % 50), compress_type=kind)
        z.writestr("d/readme.md", "no")
    (tmp_path / "empty.zip").write_bytes(b"PK\x05\x06" + bytes(18))
    rows = code.read_archives(spark, str(tmp_path), member_bytes=500)
    got = {r["path"]: r["content"] for r in rows.select("path", "content").collect()}
    assert got == {f"d{i % 7}/m{i}.py": f"x = {i}\n" * (i % 50) for i in range(300)}
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_archive_in_a_store_that_only_spark_reads(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("p/a.py", "x")
    assert not code.in_parts("viewfs://store/a.zip") and code.in_parts("file:/a.zip") and code.in_parts("/a.zip")
    rows = code._binary(spark, [str(tmp_path)], None, True).select("path", "content")
    whole = rows.mapInPandas(code._whole, "archive string, path string, content string").collect()
    assert [(r["path"], r["content"]) for r in whole] == [("p/a.py", "x")]


def test_csv_types_and_missing_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c,d,defects\n1,1.5,x,N/A,yes\nNA, ?,null,nan,no\n#N/A,-2e3,y z,,TRUE\n")
    rows = tabular.read_metrics(spark, str(tmp_path / "a.csv"))
    assert rows.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "double"), ("LABEL", "int")]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1, 1.5, "x", None, 1), (None, None, None, None, 0), (None, -2000.0, "y z", None, 1)], key=str
    )
    (tmp_path / "b.csv").write_text("a,b\n")
    assert tabular.read_csv(spark, str(tmp_path / "b.csv")).count() == 0


def test_arff_header_only(spark, tmp_path):
    many = "\n".join(["% comment"] * 700 + [f"@attribute a{i} numeric" for i in range(3)] + ["@DATA", "1,2,3", "@attribute late numeric", "4,5,?"])
    (tmp_path / "m.arff").write_text(many)
    rows = tabular.read_arff(spark, str(tmp_path / "m.arff"))
    assert rows.columns == ["a0", "a1", "a2"] and rows.count() == 2


def test_paths_and_languages(spark):
    names = ["a/venv/x.py", "a\\build\\x.py", "a/pip-20/x.py", "a/environment/x.py", "setuptools_x/y.py", "ok/x.py"]
    rows = spark.createDataFrame([(n,) for n in names], "path string")
    assert [r[0] for r in rows.select(is_skipped(F.col("path"))).collect()] == [True, True, True, False, True, False]
    langs = spark.createDataFrame([("a.TSX",), ("Makefile",), ("a.hpp",)], "n string").select(language(F.col("n"))).collect()
    assert [r[0] for r in langs] == ["React TSX", "Text", "C++ Header"]
    files = spark.createDataFrame([("a/.x.py", ""), ("a/x.py", ""), ("a/x.md", ""), ("bin/x.py", "")], "path string, content string")
    assert [r["path"] for r in only_sources(files).collect()] == ["a/x.py"]


def test_history_store(spark, tmp_path):
    store = history.HistoryStore(spark, str(tmp_path / "history"))
    metrics = spark.createDataFrame([("a.py", 3, None), (None, 4, 0.5)], "file_name string, LOC int, COMMENT_RATIO double")
    for s in ("s1", "s2"):
        store.save_session(s, "csv", ["a.py", "b.py"], metrics)
        store.save_predictions(s, spark.createDataFrame([("m", 0.9)], "model string, f1 double"))
    got = store.session("s1")
    assert sorted((r["file_name"], r["LOC"], r["COMMENT_RATIO"], r["LOC_TOTAL"]) for r in got["metrics"].collect()) == [
        ("a.py", 3, 0.0, 0), ("unknown", 4, 0.5, 0)
    ]
    assert got["predictions"].first()["f1_score"] == 0.9 and got["predictions"].first()["accuracy"] == 0.0
    assert history.session_count(store.read("sessions")).first()[0] == 2
    store.delete_sessions(["s1"])
    assert [r["session_id"] for r in store.all_sessions(5).collect()] == ["s2"]
    assert store.session("s1")["metrics"].count() == 0 and store.session("s2")["metrics"].count() == 2

    store.create_conversation("c1", folder_name="f")
    store.create_conversation("c2", "Second")
    store.update_conversation("c1", files_count=3, total_loc=10, high_risk_count=1)
    states = {r["conversation_id"]: r for r in store.all_conversations().collect()}
    assert states["c1"]["status"] == "completed" and states["c1"]["name"] == "Analysis c1" and states["c1"]["total_loc"] == 10
    assert states["c2"]["status"] == "in_progress" and states["c2"]["files_count"] == 0
    for i in range(3):
        store.add_message("c1", "user", f"m{i}")
    assert [r["content"] for r in store.messages("c1").collect()] == ["m0", "m1", "m2"]
    store.delete_conversations(["c1"])
    assert {r["conversation_id"] for r in store.all_conversations().collect()} == {"c2"}


def test_history_ids_come_back_unchanged(spark, tmp_path):
    store = history.HistoryStore(spark, str(tmp_path / "history"))
    ids = ["00123456", "1e5", "a/b=c", "2024-01-01", "é "]
    for i in ids:
        store.add_message(i, "user", f"to {i}")
    assert {r["conversation_id"] for r in store.read("conversation_messages").collect()} == set(ids)
    assert [r["content"] for r in store.messages("00123456").collect()] == ["to 00123456"]
    assert store.messages("123456").count() == 0
    store.delete_conversations(["1e5"])
    assert store.messages("1e5").count() == 0 and store.messages("a/b=c").count() == 1
    store.add_message("1e5", "user", "again")
    assert [r["content"] for r in store.messages("1e5").collect()] == ["again"]
    assert store.all_sessions().count() == 0


FILES = [("src/main.py", "if a: eval(1)\n" * 30), ("src/README.md.py", "x = 1"), ("z.go", "// TODO x")]


def corpus(spark):
    return source_rows(spark.createDataFrame(FILES, "path string, content string"))


def test_exports(spark, tmp_path):
    export(analyse(corpus(spark)), str(tmp_path), "2024-01-01 00:00:00")
    csv = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert {r["file"]: r["risk_score"] for r in csv.collect()}["src/main.py"] == "50.0"
    assert spark.read.json(str(tmp_path / "json" / "files")).filter("metrics.cc = 31").count() == 1
    assert spark.read.json(str(tmp_path / "json" / "summary")).first()["files"] == 3
    risks = analyse(corpus(spark)).risks
    lines = [r["line"] for r in reports.text_report_rows(risks, risk.workspace_summary(risks), "now").collect()]
    assert lines[3] == "Generated: now" and lines[12].startswith("  src/main.py") and lines[-1] == reports.RULE
    reports.write_predictions(risks.select("path", "risk_score"), str(tmp_path / "tsv"), "txt")
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "tsv")).columns == ["path", "risk_score"]


def test_explorer(spark):
    risks = analyse(corpus(spark)).risks
    assert [r["path"] for r in explorer.matching_files(risks, "MAIN", "High").collect()] == ["src/main.py"]
    assert explorer.matching_files(risks, "", "All").count() == 3
    assert explorer.folders(risks, "z.go").first() == ("src", 2, False)
    assert [(r["parent"], r["name"]) for r in explorer.listing(risks).collect()] == [
        ("", "src"), ("", "z.go"), ("src", "main.py"), ("src", "README.md.py")
    ]


def test_review(spark):
    files = risk.file_risk(corpus(spark))
    context = {r["path"]: r for r in review.file_context(corpus(spark), files).collect()}
    main = context["src/main.py"]
    assert {(v["metric"], v["severity"]) for v in main["violations"]} == {("cc", "CRITICAL"), ("comment_ratio", "CRITICAL")}
    assert len(main["hotspots"]) == 30 and main["hotspots"][0]["pattern"] == "eval("
    lines = review.dangerous_lines(corpus(spark), "path")
    assert review.capped_hotspots(lines, "path").filter("path = 'src/main.py'").count() == 15
    ordered = review.by_severity(review.metric_violations(files, "path").filter("path = 'src/main.py'"), "path")
    assert [r["metric"] for r in ordered.collect()] == ["cc", "comment_ratio"]


def test_archives_stay_apart(spark):
    rows = spark.createDataFrame(
        [("a.zip", "src/m.py", "if a: eval(1)\n" * 30), ("b.zip", "src/m.py", "x = 1"), (None, "src/m.py", "y = 2\nz = 3")],
        "archive string, path string, content string",
    )
    files = source_rows(rows)
    risks = risk.file_risk(files)
    assert {r["archive"]: r["loc"] for r in risks.collect()} == {"a.zip": 30, "b.zip": 1, None: 2}
    context = {r["archive"]: len(r["hotspots"]) for r in review.file_context(files, risks).collect()}
    assert context == {"a.zip": 30, "b.zip": 0, None: 0}
    scores = spark.createDataFrame([("a.zip", "src/m.py", 0.9)], "archive string, path string, model_score double")
    blended = {r["archive"]: r["risk_score"] for r in risk.file_risk(files, model_scores=scores).collect()}
    assert blended == {"a.zip": pytest.approx(0.7 * 0.9 + 0.3 * 0.5), "b.zip": pytest.approx(0.1), None: pytest.approx(0.1)}


def test_packing(spark):
    rows = review.packed_context(corpus(spark), budget=200).orderBy("position").collect()
    assert [r["path"] for r in rows] == ["src/README.md.py"]
    cut = review.packed_context(corpus(spark), budget=20).collect()
    assert len(cut) == 1 and cut[0]["is_cut"] and cut[0]["block"].endswith("...[TRUNCATED]...\n```")
    whole = review.packed_context(corpus(spark), budget=50000).orderBy("position").collect()
    assert [r["path"] for r in whole] == ["src/README.md.py", "src/main.py", "z.go"]


def test_streaming_scores_equal_batch_scores(spark, tmp_path):
    files = corpus(spark)
    files.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(files.schema).parquet(str(tmp_path / "in"))
    query = score_arrivals(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("path", "risk_score").orderBy("path").collect()
    assert got == risk.file_risk(files).select("path", "risk_score").orderBy("path").collect()
