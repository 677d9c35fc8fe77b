"""Corpus queries: lines, code metrics, risk, explorer and review tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from modrisk.catalog import query
from modrisk.catalog.views import INLINE, SP, TRIM, WD, documents, quoted, sources, sources_sql, table
from modrisk.functions import text as tx
from modrisk.functions.bands import band
from modrisk.functions.scores import approximate_measures
from modrisk.operators import code_metrics as cm
from modrisk.operators import explorer, languages, line_rules, review, risk

# ---- lines ----------------------------------------------------------------


@query(
    "line_numbering",
    """SELECT doc_id, i::INT AS line_no, string_split(text, chr(10))[i] AS line
       FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)""",
)
def line_numbering(spark, sf):
    return line_rules.number_lines(documents(spark, sf).withColumnRenamed("text", "content"), "doc_id")


@query(
    "text_line_metrics",
    f"""SELECT doc_id, n_loc::INT AS loc, (total - n_loc)::INT AS blank, total::INT AS total FROM (
         SELECT doc_id, len(string_split(text, chr(10))) AS total,
           len(list_filter(string_split(text, chr(10)), lambda l: trim(l, {TRIM}) <> '')) AS n_loc
         FROM documents)""",
)
def text_line_metrics(spark, sf):
    content = F.col("text")
    loc = tx.occurrences(content, cm.PATTERNS["non_blank_line"])
    total = tx.count_char(content, "\n") + 1
    return documents(spark, sf).select(
        "doc_id", loc.alias("loc"), (total - loc).alias("blank"), total.alias("total")
    )


# ---- code metrics ---------------------------------------------------------

def _n(pattern: str) -> str:
    return f"len(regexp_extract_all(content, {quoted(pattern)}))"


def _words(*words: str) -> str:
    listed = ", ".join(quoted(w) for w in words)
    return f"len(list_filter(words, lambda w: w IN ({listed})))"


_ELSE_IF = (
    f"len(list_filter(pieces, lambda p, i: p = 'else' AND pieces[i + 2] = 'if' "
    f"AND regexp_full_match(pieces[i + 1], {quoted(SP + '+')})))"
)
_SLASH = f"{_n('(?m)^' + INLINE + '*//')} + {_n(r'(?s)/[*].*?[*]/')}"
_SYMBOLS = f"{_n('&&')} + {_n(r'[|][|]')}"
_VIS = "(?:public|private|protected)"

SQL_COUNTS = {
    "python": {
        "comments": f"{_n('(?m)^' + INLINE + '*#')} + {_n('(?s)' + chr(34)*3 + '.*?' + chr(34)*3)} + {_n('(?s)' + chr(39)*3 + '.*?' + chr(39)*3)}",
        "functions": _n(f"(?m)^def{SP}+{WD}+"),
        "classes": _n(f"(?m)^class{SP}+{WD}+"),
        "decisions": _words("if", "elif", "for", "while", "except", "and", "or"),
        "imports": _n(f"(?m)^import{SP}+|^from{SP}+{WD}+{SP}+import"),
        "returns": _words("return"),
        "params": f"coalesce(list_sum(list_transform(regexp_extract_all(content, {quoted(f'def{SP}+{WD}+[(]([^)]*)[)]')}, 1), lambda p: len(string_split(p, ',')))), 0)",
        "fields": "NULL",
    },
    "java": {
        "comments": _SLASH,
        "functions": _n(f"{_VIS}{SP}+(?:static{SP}+)?{WD}+{SP}+{WD}+{SP}*[(][^)]*[)]"),
        "classes": _n(f"(?m)^class{SP}+{WD}+"),
        "decisions": f"{_words('if', 'for', 'while', 'case', 'catch')} + {_ELSE_IF} + {_SYMBOLS}",
        "imports": _n(f"(?m)^import{SP}+"),
        "returns": "NULL",
        "params": "NULL",
        "fields": _n(f"{_VIS}{SP}+{WD}+{SP}+{WD}+{SP}*;"),
    },
    "javascript": {
        "comments": _SLASH,
        "functions": f"{_n(f'function{SP}+{WD}+')} + {_n('=>')}",
        "classes": _n(f"class{SP}+{WD}+"),
        "decisions": f"{_words('if', 'for', 'while', 'switch', 'catch')} + {_ELSE_IF} + {_SYMBOLS} + {_n('[?]')}",
        "imports": "NULL",
        "returns": "NULL",
        "params": "NULL",
        "fields": "NULL",
    },
    "c": {
        "comments": _SLASH,
        "functions": _n(f"{WD}+{SP}+{WD}+{SP}*[(][^)]*[)]{SP}*[{{]"),
        "classes": "0",
        "decisions": f"{_words('if', 'for', 'while', 'switch', 'case')} + {_ELSE_IF} + {_SYMBOLS}",
        "imports": f"{_n('(?m)^#include')} + {_n('(?m)^#define')}",
        "returns": "NULL",
        "params": "NULL",
        "fields": "NULL",
    },
}
_FAMILY = """CASE WHEN ext = '.py' THEN 'python' WHEN ext IN ('.java', '.cs') THEN 'java'
  WHEN ext = '.js' THEN 'javascript' WHEN ext IN ('.c', '.cpp', '.h', '.hpp') THEN 'c' END"""


def _by_family(what: str) -> str:
    cases = " ".join(f"WHEN family = '{f}' THEN {c[what]}" for f, c in SQL_COUNTS.items() if c[what] != "NULL")
    return f"(CASE {cases} END)::INT"


def metrics_sql(src: str = "src") -> str:
    """SELECT with the wide metric row of every file of ``src``."""
    return f"""
  SELECT * REPLACE (NULL AS content), LOC_TOTAL - LOC AS LOC_BLANK, LOC - LOC_COMMENTS AS LOC_CODE,
    DECISION_COUNT + 1 AS CYCLOMATIC_COMPLEXITY, LOC_COMMENTS / LOC_TOTAL AS COMMENT_RATIO FROM (
    SELECT * EXCLUDE (words, pieces),
      CASE WHEN family IS NOT NULL THEN n_lines END AS LOC,
      CASE WHEN family IS NOT NULL THEN len(string_split(content, chr(10)))::INT END AS LOC_TOTAL,
      {_by_family('comments')} AS LOC_COMMENTS, {_by_family('functions')} AS FUNCTION_COUNT,
      {_by_family('classes')} AS CLASS_COUNT, {_by_family('decisions')} AS DECISION_COUNT,
      {_by_family('imports')} AS IMPORT_COUNT, {_by_family('returns')} AS RETURN_COUNT,
      {_by_family('params')} AS PARAMETER_COUNT, {_by_family('fields')} AS FIELD_COUNT
    FROM (SELECT *, {_FAMILY} AS family,
        regexp_extract_all(content, {quoted(WD + '+')}) AS words,
        regexp_extract_all(content, {quoted(f'{WD}+|[^' + WD[1:-1] + ']+')}) AS pieces,
        len(list_filter(string_split(content, chr(10)), lambda l: trim(l, {TRIM}) <> ''))::INT AS n_lines
      FROM {src}))"""


METRIC_COLUMNS = [
    "LOC", "LOC_BLANK", "LOC_TOTAL", "LOC_COMMENTS", "LOC_CODE", "FUNCTION_COUNT", "CLASS_COUNT",
    "CYCLOMATIC_COMPLEXITY", "DECISION_COUNT", "IMPORT_COUNT", "RETURN_COUNT", "PARAMETER_COUNT", "FIELD_COUNT",
]


def _metric_query(name: str, ext: str | None):
    columns = ", ".join(METRIC_COLUMNS)
    sql = f"""WITH src AS ({sources_sql(ext)}), m AS ({metrics_sql()})
      SELECT path, {columns}, round(COMMENT_RATIO, 6) AS COMMENT_RATIO FROM m"""

    @query(name, sql)
    def build(spark, sf):
        return cm.count_metrics(sources(spark, sf, ext)).select(
            "path", *METRIC_COLUMNS, F.round("COMMENT_RATIO", 6).alias("COMMENT_RATIO")
        )

    return build


for _name, _ext in [
    ("python_metrics", ".py"), ("java_metrics", ".java"), ("js_metrics", ".js"), ("c_metrics", ".c"),
    ("code_metrics", None),
]:
    _metric_query(_name, _ext)

_PAGES_SRC = "SELECT page_id, url AS path, 'p' || page_id || '.js' AS fname, '.js' AS ext, html AS content FROM pages"


@query(
    "page_script_metrics",
    f"""WITH src AS ({_PAGES_SRC}), m AS ({metrics_sql()})
        SELECT page_id, LOC, LOC_TOTAL, FUNCTION_COUNT, CLASS_COUNT, DECISION_COUNT FROM m""",
)
def page_script_metrics(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", F.col("url").alias("path"), F.concat(F.lit("p"), "page_id", F.lit(".js")).alias("fname"),
        F.col("html").alias("content"),
    )
    return cm.count_metrics(pages).select(
        "page_id", "LOC", "LOC_TOTAL", "FUNCTION_COUNT", "CLASS_COUNT", "DECISION_COUNT"
    )


@query(
    "labelled_metrics",
    f"""WITH src AS ({sources_sql()}), m AS ({metrics_sql()})
        SELECT path, {', '.join(c for c in cm.PREDICTION_COLUMNS if c != 'COMMENT_RATIO')},
          round(COMMENT_RATIO, 6) AS COMMENT_RATIO, 0 AS LABEL FROM m WHERE family IS NOT NULL""",
)
def labelled_metrics(spark, sf):
    return cm.labelled_metrics(sources(spark, sf)).select(
        "path",
        *[c for c in cm.PREDICTION_COLUMNS if c != "COMMENT_RATIO"],
        F.round("COMMENT_RATIO", 6).alias("COMMENT_RATIO"),
        "LABEL",
    )


@query(
    "prediction_columns",
    """SELECT l_quantity AS LOC, 0 AS LOC_BLANK, 0 AS LOC_TOTAL, 0 AS LOC_COMMENTS,
         l_linenumber AS CYCLOMATIC_COMPLEXITY, 0 AS DECISION_COUNT, 0 AS FUNCTION_COUNT, 0 AS CLASS_COUNT,
         l_discount AS COMMENT_RATIO FROM lineitem""",
)
def prediction_columns(spark, sf):
    return cm.prediction_columns(
        table(spark, sf, "lineitem").select(
            F.col("l_quantity").alias("LOC"),
            F.col("l_linenumber").alias("CYCLOMATIC_COMPLEXITY"),
            F.col("l_discount").alias("COMMENT_RATIO"),
            "l_tax",
        )
    )


_ANALYSIS = """
  SELECT doc_id, path, fname, ext, lang, coalesce(LOC, n_lines) AS loc, coalesce(CYCLOMATIC_COMPLEXITY, 2) AS cc,
    coalesce(FUNCTION_COUNT, 1) AS funcs, coalesce(CLASS_COUNT, 0) AS classes,
    coalesce(DECISION_COUNT, 1) AS decisions, coalesce(COMMENT_RATIO, 0.0) AS comment_ratio FROM m"""


@query(
    "attach_metrics",
    f"""WITH src AS ({sources_sql()}), m AS ({metrics_sql()}), a AS ({_ANALYSIS})
        SELECT path, loc, cc, funcs, classes, decisions, round(comment_ratio, 6) AS comment_ratio FROM a""",
)
def attach_metrics(spark, sf):
    files = sources(spark, sf)
    metrics = cm.count_metrics(cm.supported_only(files))
    return cm.attach_metrics(files, metrics).select(
        "path", "loc", "cc", "funcs", "classes", "decisions", F.round("comment_ratio", 6).alias("comment_ratio")
    )


@query(
    "approximate_measures",
    f"""WITH src AS ({sources_sql()}), m AS ({metrics_sql()}), a AS ({_ANALYSIS})
        SELECT path, loc::DOUBLE AS loc, cc::DOUBLE AS vg, greatest(1, cc // 2)::DOUBLE AS evg, cc * 2.0::DOUBLE AS d,
          loc * 25.0::DOUBLE AS v, round(1.0 / (cc * 2.0), 6)::DOUBLE AS l, round(loc * 25.0 / (cc * 2.0), 6)::DOUBLE AS i,
          loc * 25.0 * cc * 2.0::DOUBLE AS e, round(loc * 25.0 / 3000.0, 6)::DOUBLE AS b,
          round(loc * 25.0 * cc * 2.0 / 18.0, 4)::DOUBLE AS t,
          round(loc * comment_ratio, 6)::DOUBLE AS comments, (loc // 2)::DOUBLE AS uniq_opnd, (10 + cc)::DOUBLE AS uniq_op,
          decisions::DOUBLE AS branches FROM a""",
)
def approximate(spark, sf):
    rows = approximate_measures(cm.analysis_metrics(sources(spark, sf)))
    return rows.select(
        "path", "loc", F.col("`v(g)`").alias("vg"), F.col("`ev(g)`").alias("evg"), "d", "v",
        F.round("l", 6).alias("l"), F.round("i", 6).alias("i"), "e", F.round("b", 6).alias("b"),
        F.round("t", 4).alias("t"), F.round("lOComment", 6).alias("comments"),
        F.col("uniq_Opnd").alias("uniq_opnd"), F.col("uniq_Op").alias("uniq_op"), F.col("branchCount").alias("branches"),
    )


# ---- names and paths ------------------------------------------------------

_LANG_VALUES = ", ".join(f"({quoted(e)}, {quoted(l)})" for e, l in languages.LANGUAGES.items())


@query(
    "language_lookup",
    rf"""SELECT page_id, fname, coalesce(v.ext, '') AS ext, coalesce(v.lang, 'Text') AS lang FROM (
          SELECT page_id, string_split(url, '/')[-1] AS fname,
            regexp_extract(lower(string_split(url, '/')[-1]), '([.][^.]+)$', 1) AS e FROM pages) p
        LEFT JOIN (VALUES {_LANG_VALUES}) v(ext, lang) ON p.e = v.ext""",
)
def language_lookup(spark, sf):
    name = languages.file_name(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id", name.alias("fname"), languages.known_extension(name).alias("ext"), languages.language(name).alias("lang")
    )


_SKIP_SQL = f"""(len(list_intersect(string_split(replace(path, '\\', '/'), '/'),
   [{', '.join(quoted(s) for s in languages.SKIPPED_SEGMENTS)}])) > 0
   OR {' OR '.join(f"contains(path, {quoted(f)})" for f in languages.SKIPPED_FRAGMENTS)})"""


@query("skipped_paths", f"WITH src AS ({sources_sql()}) SELECT path, {_SKIP_SQL} AS skipped FROM src")
def skipped_paths(spark, sf):
    return sources(spark, sf).select("path", languages.is_skipped(F.col("path")).alias("skipped"))


@query(
    "source_filter",
    f"""WITH src AS ({sources_sql()} UNION ALL
          SELECT page_id, url, string_split(url, '/')[-1], '', '', html FROM pages)
        SELECT path, length(content)::INT AS size FROM src WHERE NOT {_SKIP_SQL} AND fname <> '' AND fname[1] <> '.'
          AND regexp_extract(lower(fname), '([.][^.]+)$', 1) IN ({', '.join(quoted(e) for e in languages.LANGUAGES)})""",
)
def source_filter(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("url").alias("path"), F.col("html").alias("content"))
    rows = sources(spark, sf).select("path", "content").unionByName(pages)
    return languages.only_sources(rows).select("path", F.length("content").alias("size"))


# ---- line rules -----------------------------------------------------------

_LINES = f"""
  SELECT doc_id, path, ext, i::INT AS line_no, line, trim(line, {TRIM}) AS t,
    length(line) - length(ltrim(line, chr(9) || ' ' || chr(12))) AS indent FROM (
    SELECT doc_id, path, ext, unnest(string_split(content, chr(10))) AS line,
      unnest(range(1, len(string_split(content, chr(10))) + 1)) AS i FROM src)"""
_EXCEPT = rf"^except(?:{SP}+[(]?{SP}*Exception{SP}*[)]?(?:{SP}+as{SP}+{WD}+)?)?{SP}*:"
_WHILE = rf"^while{SP}*[(]?{SP}*True{SP}*[)]?{SP}*:"
_EDGE = r"[^\p{L}\p{N}_]"
_HANDLED = (
    rf"(?:^|{_EDGE})raise(?:$|{_EDGE})|[.](?:error|warning|exception|debug|info){SP}*[(]"
    rf"|(?:^|[^\p{{L}}\p{{N}}_.])print{SP}*[(]"
)
_LEAVES = rf"(?:^|{_EDGE})(?:break|return|raise|yield|await)(?:$|{_EDGE})"


def _blocks(rule: str, header: str, excuse: str) -> str:
    """Headers whose block, found by a range join, holds no excuse."""
    return f"""
  SELECT h.doc_id, h.path, h.line_no, '{rule}' AS rule FROM (
    SELECT h.doc_id, h.path, h.line_no, h.t, h.indent,
      coalesce(min(e.line_no), 2147483647) AS block_end
    FROM ln h LEFT JOIN ln e ON e.doc_id = h.doc_id AND e.line_no > h.line_no AND e.indent <= h.indent
      AND e.t <> '' AND e.t NOT LIKE '#%'
    WHERE h.ext = '.py' AND regexp_matches(h.t, {quoted(header)})
    GROUP BY ALL) h
  LEFT JOIN ln b ON b.doc_id = h.doc_id AND b.line_no > h.line_no AND b.line_no < h.block_end
    AND b.t <> '' AND b.t NOT LIKE '#%'
    AND regexp_matches(regexp_replace(b.t, {quoted(header)}, ''), {quoted(excuse)})
  WHERE NOT regexp_matches(regexp_replace(h.t, {quoted(header)}, ''), {quoted(excuse)})
  GROUP BY ALL HAVING count(b.line_no) = 0"""


_BLOCKS = f"{_blocks('silent_broad_except', _EXCEPT, _HANDLED)} UNION ALL {_blocks('endless_loop', _WHILE, _LEAVES)}"


def _c(field: str, *needles: str) -> str:
    return "(" + " OR ".join(f"contains({field}, {quoted(n)})" for n in needles) + ")"


_PY, _JS = "ext = '.py'", "ext IN ('.js', '.jsx', '.ts', '.tsx')"
_OTHER = f"NOT ({_PY}) AND NOT ({_JS})"
_COMMAS = "length(t) - length(replace(t, ',', '')) > 4"
SQL_RULES = [
    (_c("t", "exec(", "eval("), 70, "dynamic_code"),
    ("length(line) > 120", 30, "long_line"),
    (_c("t", "TODO", "FIXME", "HACK"), 20, "unfinished"),
    ("silent", 40, "silent_broad_except"),
    ("endless", 50, "endless_loop"),
    (f"{_PY} AND starts_with(t, 'def ') AND {_COMMAS}", 40, "many_parameters"),
    (f"{_PY} AND {_c('t', 'if ')} AND {_c('t', 'and ', 'or ')} AND {_c('t', ':')}", 30, "complex_condition"),
    (f"{_JS} AND {_c('t', 'catch (', 'catch{')}", 40, "catch_block"),
    (f"{_JS} AND {_c('t', 'while (true)', 'while(true)')}", 50, "literal_endless_loop"),
    (f"{_JS} AND starts_with(t, 'function ') AND {_COMMAS}", 40, "many_parameters"),
    (f"{_JS} AND {_c('t', 'if (')} AND {_c('t', '&&', '||')}", 30, "complex_condition"),
    (f"{_JS} AND {_c('t', '== ')} AND NOT {_c('t', '===')}", 20, "loose_equality"),
    (f"{_JS} AND {_c('t', 'setTimeout', 'setInterval')}", 20, "timer"),
    (f"{_OTHER} AND {_c('lower(t)', 'catch')}", 30, "unclear_catch"),
    (f"{_OTHER} AND {_c('lower(t)', 'while')} AND {_c('lower(t)', 'true')}", 40, "possible_endless_loop"),
    (f"{_OTHER} AND {_COMMAS} AND {_c('t', '(')} AND {_c('t', ')')}", 30, "long_argument_list"),
]
_POINTS = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for c, w, _ in SQL_RULES)
_REASONS = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, _, r in SQL_RULES)
_FLAG = _c("line", *line_rules.DEFAULT_SEALS)
_RISKS = f"""
  SELECT doc_id, path, line_no, line, CASE WHEN sealed THEN 'low' WHEN pts >= 55 THEN 'high' WHEN pts >= 28 THEN 'med' ELSE 'low' END AS level,
    CASE WHEN sealed THEN 0 ELSE pts END::INT AS score_x100, CASE WHEN sealed THEN 'sealed' ELSE why END AS reasons
  FROM (SELECT *, {_POINTS} AS pts, concat_ws('|', {_REASONS}) AS why FROM (
    SELECT ln.*, coalesce(flag OR lead(flag, 1) OVER w OR lead(flag, 2) OVER w, flag OR coalesce(lead(flag, 1) OVER w, false)) AS sealed,
      EXISTS (SELECT 1 FROM bl WHERE bl.doc_id = ln.doc_id AND bl.line_no = ln.line_no AND rule = 'silent_broad_except') AS silent,
      EXISTS (SELECT 1 FROM bl WHERE bl.doc_id = ln.doc_id AND bl.line_no = ln.line_no AND rule = 'endless_loop') AS endless
    FROM (SELECT *, {_FLAG} AS flag FROM ln) ln WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)))
  WHERE sealed OR pts >= 28 OR t <> ''"""


def with_risks(select: str, ext: str | None = None) -> str:
    return f"WITH src AS ({sources_sql(ext)}), ln AS ({_LINES}), bl AS ({_BLOCKS}), lr AS ({_RISKS}) {select}"


@query("block_rules", f"WITH src AS ({sources_sql('.py')}), ln AS ({_LINES}) SELECT path, line_no, rule FROM ({_BLOCKS})")
def block_rules(spark, sf):
    return line_rules.block_findings(sources(spark, sf, ".py"), "path").select("path", "line_no", "rule")


for _name, _ext in [("line_risk_rules", None), ("python_line_rules", ".py"), ("script_line_rules", ".ts"), ("other_line_rules", ".go")]:
    def _rules_query(spark, sf, ext=_ext):
        return line_rules.line_risks(sources(spark, sf, ext), "path").select(
            "path", "line_no", "level", "score_x100", F.array_join("reasons", "|").alias("reasons")
        )

    query(_name, with_risks("SELECT path, line_no, level, score_x100, reasons FROM lr", _ext))(_rules_query)


@query("ignore_seal", with_risks("SELECT path, line_no FROM lr WHERE reasons = 'sealed'"))
def ignore_seal(spark, sf):
    return (
        line_rules.line_risks(sources(spark, sf), "path")
        .filter(F.array_contains("reasons", line_rules.SEALED))
        .select("path", "line_no")
    )


@query(
    "line_level_counts",
    with_risks(
        """SELECT path, count(*) FILTER (level = 'high') AS high_lines, count(*) FILTER (level = 'med') AS med_lines
           FROM lr GROUP BY path"""
    ),
)
def line_level_counts(spark, sf):
    return line_rules.level_counts(line_rules.line_risks(sources(spark, sf), "path"), "path")


@query(
    "hotspot_context",
    with_risks(
        f"""SELECT lr.path, line_no, substring(trim(line, {TRIM}), 1, 120) AS code,
          CASE level WHEN 'high' THEN 'HIGH' ELSE 'MEDIUM' END AS severity, replace(reasons, '|', ' | ') AS reason,
          array_to_string(list_slice(string_split(content, chr(10)), greatest(line_no - 3, 1), line_no + 3), chr(10)) AS context
          FROM lr JOIN src USING (doc_id) WHERE level IN ('high', 'med')"""
    ),
)
def hotspot_context(spark, sf):
    return line_rules.hotspots(sources(spark, sf), "path")


# ---- file risk and roll-ups -----------------------------------------------

_FILE_RISK = """
  SELECT a.*, high_lines, med_lines, CASE WHEN high_lines = 0 AND med_lines = 0 THEN least(rule_score, 0.1) ELSE rule_score END AS risk_score
  FROM (SELECT *, (greatest(least(CASE WHEN cc > 20 THEN 40 WHEN cc > 10 THEN 25 WHEN cc > 5 THEN 10 ELSE 0 END
      + CASE WHEN loc > 500 THEN 25 WHEN loc > 200 THEN 12 WHEN loc > 100 THEN 5 ELSE 0 END
      + CASE WHEN comment_ratio < 0.05 THEN 10 ELSE 0 END + CASE WHEN funcs > 15 THEN 10 ELSE 0 END
      + CASE WHEN decisions > 30 THEN 15 ELSE 0 END, 96), 2) / 100.0)::DOUBLE AS rule_score FROM a0) a
  JOIN (SELECT src.doc_id, count(*) FILTER (level = 'high') AS high_lines, count(*) FILTER (level = 'med') AS med_lines
        FROM src LEFT JOIN lr USING (doc_id) GROUP BY src.doc_id) USING (doc_id)"""


def with_file_risk(select: str) -> str:
    return with_risks("").rstrip() + f", m AS ({metrics_sql()}), a0 AS ({_ANALYSIS}), fr AS ({_FILE_RISK}) {select}"


_LEVEL = "CASE WHEN risk_score >= 0.5 THEN 'HIGH' WHEN risk_score >= 0.3 THEN 'MED' ELSE 'LOW' END"


@query(
    "file_risk",
    with_file_risk(
        f"""SELECT path, lang, loc, cc, funcs, classes, decisions, round(comment_ratio, 6) AS comment_ratio, high_lines, med_lines,
              round(risk_score, 6) AS risk_score, {_LEVEL} AS risk_level FROM fr"""
    ),
)
def file_risk(spark, sf):
    return risk.file_risk(sources(spark, sf)).select(
        "path", "lang", "loc", "cc", "funcs", "classes", "decisions", F.round("comment_ratio", 6).alias("comment_ratio"),
        "high_lines", "med_lines", F.round("risk_score", 6).alias("risk_score"), "risk_level",
    )


@query(
    "archive_risk",
    with_file_risk(
        f"""SELECT archive, path, loc, cc, high_lines, med_lines, round(risk_score, 6) AS risk_score, {_LEVEL} AS risk_level
            FROM fr, (VALUES ('a.zip'), ('b.zip')) v(archive)"""
    ),
)
def archive_risk(spark, sf):
    """Every file twice, under equal paths of two archives: the archives stay apart."""
    files = sources(spark, sf)
    both = files.withColumn("archive", F.lit("a.zip")).unionByName(files.withColumn("archive", F.lit("b.zip")))
    return risk.file_risk(both).select(
        "archive", "path", "loc", "cc", "high_lines", "med_lines", F.round("risk_score", 6).alias("risk_score"), "risk_level"
    )


def risks_of(spark, sf):
    return risk.file_risk(sources(spark, sf))


@query(
    "workspace_summary",
    with_file_risk(
        """SELECT count(*) AS files, sum(loc)::BIGINT AS total_loc, round(avg(risk_score), 6) AS avg_risk,
             count(*) FILTER (risk_score >= 0.5) AS high, count(*) FILTER (risk_score >= 0.3 AND risk_score < 0.5) AS med,
             count(*) FILTER (risk_score < 0.3) AS low, round(100.0 * count(*) FILTER (risk_score >= 0.5) / count(*), 6)::DOUBLE AS high_pct
           FROM fr"""
    ),
)
def workspace_summary(spark, sf):
    return risk.workspace_summary(risks_of(spark, sf)).withColumns(
        {"avg_risk": F.round("avg_risk", 6), "high_pct": F.round("high_pct", 6)}
    )


@query(
    "risk_by_language",
    with_file_risk(
        """SELECT lang, round(avg(risk_score), 6) AS avg_risk, count(*) AS files, round(avg(risk_score) * 100, 1) AS avg_risk_pct
           FROM fr GROUP BY lang"""
    ),
)
def risk_by_language(spark, sf):
    return risk.risk_by_language(risks_of(spark, sf)).withColumn("avg_risk", F.round("avg_risk", 6))


@query(
    "band_counts",
    with_file_risk(
        """SELECT b.ord, b.band, count(fr.path) AS files FROM (VALUES (0, 'High', 0.67, 1.0), (1, 'Medium', 0.33, 0.67), (2, 'Low', 0.0, 0.33)) b(ord, band, lo, hi)
           LEFT JOIN fr ON risk_score > lo AND risk_score <= hi GROUP BY ALL"""
    ),
)
def band_counts(spark, sf):
    return risk.band_counts(risks_of(spark, sf))


@query(
    "risk_bands",
    """SELECT p_partkey, CASE WHEN s >= 0.5 THEN 'HIGH' WHEN s >= 0.3 THEN 'MED' ELSE 'LOW' END AS analysis,
         CASE WHEN s >= 0.67 THEN 'HIGH' WHEN s >= 0.33 THEN 'MEDIUM' ELSE 'LOW' END AS review,
         CASE WHEN s >= 0.7 THEN 'High Risk' WHEN s >= 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END AS heatmap,
         CASE WHEN s > 0.67 AND s <= 1 THEN 'High' WHEN s > 0.33 AND s <= 0.67 THEN 'Medium' WHEN s > 0 AND s <= 0.33 THEN 'Low' END AS dashboard
       FROM (SELECT p_partkey, (p_partkey % 121) / 100.0::DOUBLE AS s FROM part)""",
)
def risk_bands(spark, sf):
    score = (F.col("p_partkey") % 121) / F.lit(100.0)
    return table(spark, sf, "part").select(
        "p_partkey", *[band(score, scale).alias(scale) for scale in ["analysis", "review", "heatmap", "dashboard"]]
    )


@query(
    "risk_histogram",
    with_file_risk(
        """SELECT bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, count(*) AS n FROM (
             SELECT lo, w, CASE WHEN hi > lo THEN least(floor((risk_score - lo) / w), 29) ELSE 0 END::INT AS bin FROM (
               SELECT risk_score, min(risk_score) OVER () AS lo, max(risk_score) OVER () AS hi,
                 (max(risk_score) OVER () - min(risk_score) OVER ()) / 30.0::DOUBLE AS w FROM fr)) GROUP BY ALL"""
    ),
)
def risk_histogram(spark, sf):
    return risk.histogram(risks_of(spark, sf), "risk_score", 30).withColumns(
        {"bin_start": F.round("bin_start", 6), "bin_end": F.round("bin_end", 6)}
    )


@query(
    "top_risky",
    with_file_risk("SELECT path, lang, round(risk_score * 100, 1) AS risk_pct FROM fr ORDER BY risk_score DESC, path LIMIT 15"),
)
def top_risky(spark, sf):
    return risk.riskiest(risks_of(spark, sf), 15).select(
        "path", "lang", F.round(F.col("risk_score") * 100, 1).alias("risk_pct")
    )


@query(
    "module_risk_table",
    with_file_risk(
        """SELECT path AS module, round(risk_score, 3) AS probability,
             CASE WHEN risk_score >= 0.7 THEN 'High Risk' WHEN risk_score >= 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level FROM fr"""
    ),
)
def module_risk_table(spark, sf):
    return risk.module_table(risks_of(spark, sf), "path", "risk_score")


_QUIET = "replace(replace(content, 'eval(', 'call('), 'TODO', 'done')"


@query(
    "rescored_files",
    f"""WITH src AS (SELECT * REPLACE ({_QUIET} AS content) FROM ({sources_sql()})), ln AS ({_LINES}), bl AS ({_BLOCKS}), lr AS ({_RISKS}),
      lv AS (SELECT src.path, count(*) FILTER (level = 'high') AS h, count(*) FILTER (level = 'med') AS md FROM src LEFT JOIN lr USING (doc_id) GROUP BY ALL)
      SELECT path, h AS high_lines, md AS med_lines, round(CASE WHEN h = 0 AND md = 0 THEN least(s, 0.1) ELSE s END, 6)::DOUBLE AS risk_score
      FROM (SELECT path, (doc_id % 97) / 100.0 AS s FROM src) JOIN lv USING (path)""",
)
def rescored_files(spark, sf):
    files = sources(spark, sf)
    previous = files.select(
        "path", ((F.col("doc_id") % 97) / F.lit(100.0)).alias("risk_score"), F.lit("").alias("risk_level"),
        F.lit(1).cast("long").alias("high_lines"), F.lit(1).cast("long").alias("med_lines"),
    )
    changed = files.withColumn(
        "content", F.replace(F.replace("content", F.lit("eval("), F.lit("call(")), F.lit("TODO"), F.lit("done"))
    )
    return risk.rescored(previous, changed).select(
        "path", "high_lines", "med_lines", F.round("risk_score", 6).alias("risk_score")
    )


# ---- explorer -------------------------------------------------------------


@query(
    "explorer_filter",
    with_file_risk("SELECT path, round(risk_score, 6) AS risk_score FROM fr WHERE contains(lower(path), 'src1') AND risk_score < 0.3"),
)
def explorer_filter(spark, sf):
    return explorer.matching_files(risks_of(spark, sf), "SRC1", "Low").select(
        "path", F.round("risk_score", 6).alias("risk_score")
    )


@query(
    "folder_match",
    """WITH p AS (SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '') AS parts,
         contains(lower(url), 'example.org') AND (page_id % 100) / 100.0 >= 0.5 AS hit FROM pages),
       e AS (SELECT parts, hit, unnest(range(1, len(parts))) AS n FROM p)
       SELECT array_to_string(parts[1:n], '/') AS folder, count(*) AS files, bool_or(hit) AS has_match FROM e GROUP BY ALL""",
)
def folder_match(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.col("url").alias("path"), ((F.col("page_id") % 100) / F.lit(100.0)).alias("risk_score")
    )
    return explorer.folders(pages, "example.org", "High")


@query(
    "folder_listing",
    """WITH p AS (SELECT DISTINCT list_filter(string_split(url, '/'), lambda x: x <> '') AS parts FROM pages),
       e AS (SELECT parts, unnest(range(1, len(parts) + 1)) AS n FROM p)
       SELECT DISTINCT array_to_string(parts[1:n - 1], '/') AS parent, parts[n] AS name, n = len(parts) AS is_file FROM e""",
)
def folder_listing(spark, sf):
    return explorer.listing(table(spark, sf, "pages").select(F.col("url").alias("path")))


# ---- review ---------------------------------------------------------------

_VIOLATIONS = """
  SELECT fr.path, t.metric, t.value, CASE WHEN inv THEN CASE WHEN value <= critical THEN critical ELSE warn END
      ELSE CASE WHEN value >= critical THEN critical ELSE warn END END::DOUBLE AS threshold,
    CASE WHEN inv AND value <= critical THEN 'CRITICAL' WHEN inv THEN 'MEDIUM' WHEN value >= critical THEN 'CRITICAL' ELSE 'HIGH' END AS severity
  FROM fr, LATERAL (VALUES ('loc', loc::DOUBLE, 150, 300, false), ('cc', cc::DOUBLE, 7, 15, false), ('funcs', funcs::DOUBLE, 10, 20, false),
    ('comment_ratio', comment_ratio, 0.05, 0.02, true), ('classes', classes::DOUBLE, 5, 10, false)) t(metric, value, warn, critical, inv)
  WHERE CASE WHEN inv THEN value <= warn ELSE value >= warn END"""


@query("metric_violations", with_file_risk(f"SELECT path, metric, round(value, 6) AS value, threshold, severity FROM ({_VIOLATIONS})"))
def metric_violations(spark, sf):
    return review.by_severity(review.metric_violations(risks_of(spark, sf), "path"), "path").select(
        "path", "metric", F.round("value", 6).alias("value"), "threshold", "severity"
    )


_DANGER_VALUES = ", ".join(
    f"({i}, {quoted(p)}, {quoted(s)}, {quoted(r)})" for i, (p, s, r) in enumerate(review.DANGEROUS)
)
_DANGER = f"""
  SELECT doc_id, path, line_no, substring(t, 1, 120) AS code, arg_min(v.pattern, v.prio) AS pattern,
    arg_min(v.severity, v.prio) AS severity, arg_min(v.reason, v.prio) AS reason
  FROM ln JOIN (VALUES {_DANGER_VALUES}) v(prio, pattern, severity, reason) ON contains(t, v.pattern) GROUP BY ALL"""


@query(
    "dangerous_patterns",
    f"WITH src AS ({sources_sql()}), ln AS ({_LINES}) SELECT path, line_no, code, pattern, severity, reason FROM ({_DANGER})",
)
def dangerous_patterns(spark, sf):
    return review.dangerous_lines(sources(spark, sf), "path")


@query(
    "capped_hotspots",
    f"""WITH src AS ({sources_sql()}), ln AS ({_LINES}), d AS ({_DANGER})
        SELECT path, line_no, pattern FROM d QUALIFY row_number() OVER (PARTITION BY path ORDER BY line_no) <= 15""",
)
def capped_hotspots(spark, sf):
    return review.capped_hotspots(review.dangerous_lines(sources(spark, sf), "path"), "path").select(
        "path", "line_no", "pattern"
    )


_SNIPPET = """CASE WHEN len(ls) > 80 THEN array_to_string(ls[1:80], chr(10)) || chr(10) || '... (' || (len(ls) - 80) || ' more lines)'
   ELSE array_to_string(ls, chr(10)) END"""


@query(
    "file_context",
    with_file_risk(
        f""", v AS (SELECT path, count(*)::INT AS violations FROM ({_VIOLATIONS}) GROUP BY path),
        d AS (SELECT path, count(*)::INT AS hotspots FROM ({_DANGER}) GROUP BY path)
        SELECT fr.path, fr.lang AS language, round(risk_score, 6) AS risk_score,
          CASE WHEN risk_score >= 0.67 THEN 'HIGH' WHEN risk_score >= 0.33 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
          coalesce(violations, 0) AS violations, coalesce(hotspots, 0) AS hotspots, {_SNIPPET} AS snippet
        FROM fr JOIN (SELECT doc_id, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM (SELECT doc_id, string_split(content, chr(10)) AS ls FROM src)) USING (doc_id)
        LEFT JOIN v ON v.path = fr.path LEFT JOIN d ON d.path = fr.path"""
    ),
)
def file_context(spark, sf):
    files = sources(spark, sf)
    return review.file_context(files, risk.file_risk(files)).select(
        "path", "language", F.round("risk_score", 6).alias("risk_score"), "risk_level",
        F.size("violations").alias("violations"), F.size("hotspots").alias("hotspots"), "snippet",
    )


@query(
    "workspace_review",
    with_file_risk(
        """SELECT path, 'HIGH' AS review_level, loc, cc FROM (SELECT * FROM fr WHERE risk_score >= 0.67 ORDER BY path LIMIT 10)
           UNION ALL SELECT path, 'MEDIUM', loc, cc FROM (SELECT * FROM fr WHERE risk_score >= 0.33 AND risk_score < 0.67 ORDER BY path LIMIT 8)"""
    ),
)
def workspace_review(spark, sf):
    return review.workspace_review(risks_of(spark, sf)).select("path", "review_level", "loc", "cc")


@query(
    "context_packing",
    f"""WITH src AS ({sources_sql()}), b AS (
          SELECT path, content, chr(10) || chr(10) || '--- File: ' || path || ' ---' || chr(10) || '```' || chr(10) || content || chr(10) || '```' AS block,
            CASE WHEN contains(lower(path), 'readme') THEN 0 WHEN contains(lower(path), 'main') OR contains(lower(path), 'app') OR contains(lower(path), 'index') THEN 1
              WHEN regexp_matches(lower(path), '[.](py|js|ts|java|cpp)$') THEN 2 ELSE 3 END AS priority FROM src WHERE content <> ''),
        r AS (SELECT *, row_number() OVER w AS position, sum(length(block)) OVER (w ROWS UNBOUNDED PRECEDING) AS running
              FROM b WINDOW w AS (ORDER BY priority, length(content), path))
        SELECT position::INT AS position, path, priority::INT AS priority, length(block)::INT AS block_length, running::BIGINT AS running_length,
          running > 50000 AS is_cut, CASE WHEN running > 50000 THEN substring(block, 1, 50000) || chr(10) || '...[TRUNCATED]...' || chr(10) || '```' ELSE block END AS block
        FROM r WHERE running <= 50000 OR position = 1""",
)
def context_packing(spark, sf):
    return review.packed_context(sources(spark, sf))


_FENCED = "html || chr(10) || '```js' || chr(10) || ' ' || url || chr(10) || '```' || chr(10) || '```' || chr(10) || 'x' || chr(10) || '```'"


@query(
    "code_blocks",
    f"""SELECT page_id, trim(regexp_extract({_FENCED}, {quoted('(?s)```(?:' + WD + '+)?' + chr(10) + '(.*?)```')}, 1), {TRIM}) AS code FROM pages""",
)
def code_blocks(spark, sf):
    text = F.concat("html", F.lit("\n```js\n "), "url", F.lit("\n```\n```\nx\n```"))
    return table(spark, sf, "pages").select("page_id", tx.first_code_block(text).alias("code"))
