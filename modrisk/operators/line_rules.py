"""Line numbering, per-line risk rules, ignore seals and block rules.

A file is one row. Everything that needs neighbouring lines (the seal and the
block rules) is worked out on that row before its lines are exploded, so line
rules add no shuffle; only the later roll-up per file shuffles, one row a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modrisk.functions.text import S, W, count_char, has, lines_of, strip, universal_lines

# Level edges and rule weights, in hundredths.
HIGH_EDGE = 55
MEDIUM_EDGE = 28
LONG_LINE = 120
MANY_COMMAS = 4
WEIGHTS = {
    "dynamic_code": 70,
    "long_line": 30,
    "unfinished": 20,
    "silent_broad_except": 40,
    "endless_loop": 50,
    "many_parameters": 40,
    "complex_condition": 30,
    "catch_block": 40,
    "literal_endless_loop": 50,
    "loose_equality": 20,
    "timer": 20,
    "unclear_catch": 30,
    "possible_endless_loop": 40,
    "long_argument_list": 30,
}
SEALED = "sealed"
SCRIPT_EXTENSIONS = [".js", ".jsx", ".ts", ".tsx"]
DEFAULT_SEALS = ("risk-ignore", "risk: ignore")

# Headers of the block rules and what excuses a block.
BROAD_EXCEPT = rf"\Aexcept(?:{S}+\(?{S}*Exception{S}*\)?(?:{S}+as{S}+{W}+)?)?{S}*:"
WHILE_TRUE = rf"\Awhile{S}*\(?{S}*True{S}*\)?{S}*:"
HANDLED_HINTS = ["raise", "print", ".error", ".warning", ".exception", ".debug", ".info"]
LEAVES_LOOP_WORDS = ["break", "return", "raise", "yield", "await"]
HANDLED = (
    rf"(?:\A|[^\p{{L}}\p{{N}}_])raise(?:\z|[^\p{{L}}\p{{N}}_])"
    rf"|\.(?:error|warning|exception|debug|info){S}*\("
    rf"|(?:\A|[^\p{{L}}\p{{N}}_.])print{S}*\("
)
LEAVES_LOOP = (
    rf"(?:\A|[^\p{{L}}\p{{N}}_])(?:{'|'.join(LEAVES_LOOP_WORDS)})(?:\z|[^\p{{L}}\p{{N}}_])"
)


def number_lines(files: DataFrame, *keep: str) -> DataFrame:
    """One row per line with its 1-based number; a trailing empty line counts."""
    return files.select(
        *keep, F.posexplode(lines_of(F.col("content"))).alias("_pos", "line")
    ).select(*keep, (F.col("_pos") + 1).alias("line_no"), "line")


def sealed_lines(lines: Column, content: Column, seals=DEFAULT_SEALS) -> Column:
    """Numbers of the lines that carry an ignore flag (empty for most files)."""
    marked = F.filter(
        F.transform(lines, lambda line, i: F.when(has(line, *seals), i + 1)), lambda n: n.isNotNull()
    )
    return F.when(has(content, *seals), marked).otherwise(F.array().cast("array<int>"))


def _open_blocks(lines: Column, start: str, header: str, hints: list[str], excuse: str) -> Column:
    """Line numbers of the headers whose indented block holds no excuse.

    One backward pass over the lines. The state is the smallest indent seen
    since the nearest excusing line below; that line is inside a header's block
    exactly when this minimum is larger than the header's own indent. ``start``
    and ``hints`` are plain texts that let most lines skip the patterns.
    """
    def stripped(line: Column, i: Column) -> Column:
        indent = F.length(line) - F.length(F.ltrim(line, F.lit("\t \f")))
        return F.struct((i + 1).alias("no"), indent.alias("indent"), strip(line).alias("text"))

    def facts(row: Column) -> Column:
        text = row["text"]
        opens = text.startswith(start) & text.rlike(header)
        body = F.when(text.startswith(start), F.regexp_replace(text, header, "")).otherwise(text)
        return F.struct(
            row["no"].alias("no"),
            row["indent"].alias("indent"),
            ((text == "") | text.startswith("#")).alias("empty"),
            opens.alias("opens"),
            (has(text, *hints) & body.rlike(excuse)).alias("excused"),
        )

    empty_state = F.struct(
        F.lit(None).cast("int").alias("low"), F.array().cast("array<int>").alias("found")
    )

    def step(state: Column, line: Column) -> Column:
        open_block = line["opens"] & ~line["excused"] & (
            state["low"].isNull() | (state["low"] <= line["indent"])
        )
        low = F.when(line["excused"], line["indent"]).when(
            state["low"].isNotNull(), F.least(state["low"], line["indent"])
        )
        found = F.when(open_block, F.concat(state["found"], F.array(line["no"]))).otherwise(state["found"])
        return F.when(line["empty"], state).otherwise(F.struct(low.alias("low"), found.alias("found")))

    return F.aggregate(
        F.reverse(F.transform(F.transform(lines, stripped), facts)), empty_state, step, lambda s: s["found"]
    )


def silent_excepts(lines: Column, content: Column) -> Column:
    """Broad handlers that neither raise, log nor print (Python files)."""
    return F.when(content.contains("except"), _open_blocks(lines, "except", BROAD_EXCEPT, HANDLED_HINTS, HANDLED)).otherwise(
        F.array().cast("array<int>")
    )


def endless_loops(lines: Column, content: Column) -> Column:
    """``while True`` loops with no way out (Python files)."""
    return F.when(content.contains("while"), _open_blocks(lines, "while", WHILE_TRUE, LEAVES_LOOP_WORDS, LEAVES_LOOP)).otherwise(
        F.array().cast("array<int>")
    )


def block_findings(files: DataFrame, *keep: str) -> DataFrame:
    """One row per Python header line whose block breaks a rule."""
    python = files.filter(F.col("ext") == ".py").select(
        *keep, lines_of(F.col("content")).alias("_lines"), F.col("content").alias("_content")
    )
    lines, content = F.col("_lines"), F.col("_content")

    def rows(numbers: Column, rule: str) -> Column:
        return F.transform(numbers, lambda n: F.struct(n.alias("line_no"), F.lit(rule).alias("rule")))

    return python.select(
        *keep,
        F.inline(
            F.concat(
                rows(silent_excepts(lines, content), "silent_broad_except"),
                rows(endless_loops(lines, content), "endless_loop"),
            )
        ),
    )


def _rule_groups() -> list[list[tuple[Column, str]]]:
    """(condition, rule name) pairs for one prepared line, in groups.

    Names may repeat per language. Each group becomes one projection: a single
    projection with all the rules would compile to a method too long for the
    JIT compiler.
    """
    line, text, lower = F.col("line"), F.col("_text"), F.col("_lower")
    python, script, other = (F.col("_kind") == kind for kind in ("python", "script", "other"))
    line_no = F.col("line_no")
    many_commas = count_char(text, ",") > MANY_COMMAS
    return [
        [
            (has(text, "exec(", "eval("), "dynamic_code"),
            (F.length(line) > LONG_LINE, "long_line"),
            (has(text, "TODO", "FIXME", "HACK"), "unfinished"),
        ],
        [
            (python & F.array_contains(F.col("_silent"), line_no), "silent_broad_except"),
            (python & F.array_contains(F.col("_endless"), line_no), "endless_loop"),
            (python & text.startswith("def ") & many_commas, "many_parameters"),
            (python & has(text, "if ") & has(text, "and ", "or ") & has(text, ":"), "complex_condition"),
        ],
        [
            (script & has(text, "catch (", "catch{"), "catch_block"),
            (script & has(text, "while (true)", "while(true)"), "literal_endless_loop"),
            (script & text.startswith("function ") & many_commas, "many_parameters"),
        ],
        [
            (script & has(text, "if (") & has(text, "&&", "||"), "complex_condition"),
            (script & has(text, "== ") & ~has(text, "==="), "loose_equality"),
            (script & has(text, "setTimeout", "setInterval"), "timer"),
        ],
        [
            (other & has(lower, "catch"), "unclear_catch"),
            (other & has(lower, "while") & has(lower, "true"), "possible_endless_loop"),
            (other & has(text, "(") & has(text, ")") & many_commas, "long_argument_list"),
        ],
    ]


def _scored(files: DataFrame, keep: tuple[str, ...], seals, with_blank: bool, around: int | None = None) -> DataFrame:
    """With ``around``, a line brings along so many of its neighbours, as the array ``_near``: never the whole file."""
    source = F.coalesce(F.col("content"), F.lit(""))
    prepared = files.select(*keep, F.col("ext").alias("_ext"), source.alias("_content")).select(
        "*", lines_of(F.col("_content")).alias("_lines")
    )
    lines, content, ext = F.col("_lines"), F.col("_content"), F.col("_ext")
    exploded, brought = lines, []
    if around is not None:
        prepared = prepared.select("*", universal_lines(content).alias("_all_lines"))
        every = F.col("_all_lines")

        def neighbours(line: Column, i: Column) -> Column:
            near = [F.get(every, i + d) for d in range(-around, around + 1)]
            return F.struct(line.alias("line"), F.array(*near).alias("near"))

        exploded, brought = F.transform(lines, neighbours), ["_near"]
    none = F.array().cast("array<int>")
    marked = prepared.select(
        *keep,
        ext,
        exploded.alias("_exploded"),
        sealed_lines(lines, content, seals).alias("_sealed"),
        F.when(ext == ".py", silent_excepts(lines, content)).otherwise(none).alias("_silent"),
        F.when(ext == ".py", endless_loops(lines, content)).otherwise(none).alias("_endless"),
    )
    # The outer form: there is always a line, and the plain form would split
    # every text a second time just to check that.
    numbered = marked.select(
        *keep, "_ext", "_sealed", "_silent", "_endless", F.posexplode_outer("_exploded").alias("_pos", "_line")
    )
    line = F.col("_line") if around is None else F.col("_line.line")
    near = [] if around is None else [F.col("_line.near").alias("_near")]
    numbered = numbered.select(
        *keep, "_ext", "_sealed", "_silent", "_endless",
        (F.col("_pos") + 1).alias("line_no"), F.coalesce(line, F.lit("")).alias("line"), *near,
    )
    keep = (*keep, *brought)
    line_no, sealed = F.col("line_no"), F.col("_sealed")
    # Every value below that several rules use is computed once, in its own step.
    state = numbered.select(
        *keep, "line_no", "line", "_silent", "_endless",
        strip(F.col("line")).alias("_text"),
        F.when(F.col("_ext") == ".py", "python")
        .when(F.col("_ext").isin(*SCRIPT_EXTENSIONS), "script")
        .otherwise("other").alias("_kind"),
        (
            (F.size(sealed) > 0)
            & (
                F.array_contains(sealed, line_no)
                | F.array_contains(sealed, line_no + 1)
                | F.array_contains(sealed, line_no + 2)
            )
        ).alias("_is_sealed"),
    )
    if not with_blank:
        # Length is the only rule a blank line can break.
        state = state.filter(
            (F.col("_text") != "") | (F.length("line") > LONG_LINE) | F.col("_is_sealed")
        )
    state = state.select("*", F.when(F.col("_kind") == "other", F.lower("_text")).alias("_lower"))
    points, reasons = F.lit(0), []
    for g, group in enumerate(_rule_groups()):
        state = state.select("*", *[condition.alias(f"_g{g}r{i}") for i, (condition, _) in enumerate(group)])
        worth, why = F.lit(0), []
        for i, (_, rule) in enumerate(group):
            hit = F.col(f"_g{g}r{i}")
            worth = worth + F.when(hit, WEIGHTS[rule]).otherwise(0)
            why.append(F.when(hit, F.lit(rule)))
        state = state.select(
            *[c for c in state.columns if not c.startswith(f"_g{g}r")],
            worth.alias(f"_p{g}"),
            F.array_compact(F.array(*why)).alias(f"_w{g}"),
        )
        points = points + F.col(f"_p{g}")
        reasons.append(F.col(f"_w{g}"))
    is_sealed = F.col("_is_sealed")
    scored = state.select(
        *keep, "line_no", "line", "_text", "_is_sealed",
        F.when(~is_sealed, points).otherwise(0).alias("score_x100"),
        F.when(is_sealed, F.array(F.lit(SEALED))).otherwise(F.concat(*reasons)).alias("reasons"),
    )
    score = F.col("score_x100")
    level = (
        F.when(is_sealed, "low")
        .when(score >= HIGH_EDGE, "high")
        .when(score >= MEDIUM_EDGE, "med")
        .when(F.col("_text") != "", "low")
    )
    return scored.select(*keep, "line_no", "line", level.alias("level"), "score_x100", "reasons")


def scored_lines(files: DataFrame, *keep: str, seals=DEFAULT_SEALS) -> DataFrame:
    """Every line with its score, reasons and level; blank lines have no level.

    A line is sealed as low when a flag stands on it or on one of the two lines
    below. ``keep`` names the columns of ``files`` to carry along.
    """
    return _scored(files, keep, seals, with_blank=True)


def line_risks(files: DataFrame, *keep: str, seals=DEFAULT_SEALS) -> DataFrame:
    """Risk level, score (hundredths) and reasons of every line that is not blank."""
    return _scored(files, keep, seals, with_blank=False)


def risky_lines(files: DataFrame, *keep: str, seals=DEFAULT_SEALS, around: int | None = None) -> DataFrame:
    """The high and medium lines.

    The result of the rules passes through a generator before it is filtered;
    otherwise the filter would be pushed below the rules, with a second copy of
    all of them inside.
    """
    found = _scored(files, keep, seals, with_blank=False, around=around)
    near = [] if around is None else ["_near"]
    fenced = found.select(
        *keep, *near, "line_no", "line", F.inline_outer(F.array(F.struct("level", "score_x100", "reasons")))
    )
    return fenced.filter(F.col("level").isin("high", "med"))


def level_counts(risks: DataFrame, *keys: str) -> DataFrame:
    """High and medium lines per file."""
    return risks.groupBy(*keys).agg(
        F.count_if(F.col("level") == "high").alias("high_lines"),
        F.count_if(F.col("level") == "med").alias("med_lines"),
    )


def hotspots(files: DataFrame, *keep: str, around: int = 3, seals=DEFAULT_SEALS) -> DataFrame:
    """High and medium lines: trimmed code cut to 120 characters, plus the lines around.

    Line numbers come from ``\\n`` splitting, code from splitting at every line
    boundary, so a number past the last such line has no code.
    """
    risky = risky_lines(files, *keep, seals=seals, around=around)
    code = F.coalesce(F.get("_near", F.lit(around)), F.lit(""))
    return risky.select(
        *keep,
        "line_no",
        F.substring(strip(code), 1, 120).alias("code"),
        F.when(F.col("level") == "high", "HIGH").otherwise("MEDIUM").alias("severity"),
        F.array_join("reasons", " | ").alias("reason"),
        # Neighbours beyond the file's ends are null, and left out.
        F.array_join("_near", "\n").alias("context"),
    )
