"""Risk score and approximate size/complexity measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modrisk.functions.draws import draw

# Score ladders in hundredths, (strictly above, points).
COMPLEXITY_STEPS = [(20, 40), (10, 25), (5, 10)]
SIZE_STEPS = [(500, 25), (200, 12), (100, 5)]
FEW_COMMENTS = (0.05, 10)
MANY_FUNCTIONS = (15, 10)
MANY_DECISIONS = (30, 15)
LOWEST, HIGHEST = 2, 96
QUIET_CAP = 0.1
MODEL_SHARE, RULE_SHARE = 0.7, 0.3


def _ladder(value: Column, steps: list[tuple[int, int]]) -> Column:
    points = F.when(value > steps[0][0], steps[0][1])
    for edge, worth in steps[1:]:
        points = points.when(value > edge, worth)
    return points.otherwise(0)


def rule_score(jitter: bool = False) -> Column:
    """Rule-based score from loc, cc, funcs, decisions and comment_ratio.

    Points are summed as whole hundredths so that band edges compare exactly.
    ``jitter`` adds up to 0.05 either way, drawn from loc + cc.
    """
    col = F.col
    points = (
        _ladder(col("cc"), COMPLEXITY_STEPS)
        + _ladder(col("loc"), SIZE_STEPS)
        + F.when(col("comment_ratio") < FEW_COMMENTS[0], FEW_COMMENTS[1]).otherwise(0)
        + F.when(col("funcs") > MANY_FUNCTIONS[0], MANY_FUNCTIONS[1]).otherwise(0)
        + F.when(col("decisions") > MANY_DECISIONS[0], MANY_DECISIONS[1]).otherwise(0)
    )
    if jitter:
        points = points + (draw("risk", col("loc") + col("cc")) - 0.5) * 10
    return F.least(F.greatest(points, F.lit(LOWEST)), F.lit(HIGHEST)) / F.lit(100.0)


def blended(model_score: Column, rule: Column) -> Column:
    """Model probability mixed with the rule score; the rule alone without a model."""
    return F.when(model_score.isNotNull(), model_score * MODEL_SHARE + rule * RULE_SHARE).otherwise(rule)


def capped(score: Column, high_lines: Column, med_lines: Column) -> Column:
    """A file without risky lines cannot score above the quiet cap."""
    quiet = (high_lines == 0) & (med_lines == 0)
    return F.when(quiet, F.least(score, F.lit(QUIET_CAP))).otherwise(score)


# How the approximate measures follow from loc and cc.
def approximate_measures(files: DataFrame) -> DataFrame:
    """Twenty approximate module measures from loc, cc, comment_ratio, decisions."""
    loc, cc = F.col("loc").cast("double"), F.col("cc").cast("double")
    difficulty = cc * 2.0
    length = loc * 5.0
    volume = length * 5.0
    effort = volume * difficulty
    half_cc = F.greatest(F.lit(1.0), F.floor(cc / 2).cast("double"))
    measures = {
        "loc": loc,
        "v(g)": cc,
        "ev(g)": half_cc,
        "iv(g)": half_cc,
        "d": difficulty,
        "n": length,
        "v": volume,
        "l": F.when(difficulty > 0, F.try_divide(F.lit(1.0), difficulty)).otherwise(1.0),
        "i": F.when(difficulty > 0, F.try_divide(volume, difficulty)).otherwise(volume),
        "e": effort,
        "b": volume / 3000.0,
        "t": effort / 18.0,
        "lOCode": loc,
        "lOComment": loc * F.col("comment_ratio"),
        "lOBlank": loc * 0.1,
        "locCodeAndComment": F.lit(0.0),
        "uniq_Op": cc + 10,
        "uniq_Opnd": F.floor(loc / 2).cast("double"),
        "total_Op": loc * 3,
        "total_Opnd": loc * 2,
        "branchCount": F.col("decisions").cast("double"),
    }
    kept = [c for c in files.columns if c not in measures]
    return files.select(*[F.col(f"`{c}`") for c in kept], *[e.alias(n) for n, e in measures.items()])


def halstead(
    unique_ops: Column, unique_operands: Column, ops: Column, operands: Column, arguments: Column
) -> dict[str, Column]:
    """Halstead measures from operator and operand counts; 0 where undefined.

    ``arguments`` is the number of arguments of the module, which fixes the
    volume of its smallest possible implementation.
    """
    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    vocabulary = (unique_ops + unique_operands).cast("double")
    length = (ops + operands).cast("double")
    volume = F.when(vocabulary > 0, length * F.log2(vocabulary)).otherwise(0.0)
    potential = (arguments + 2).cast("double")
    level = ratio(potential * F.log2(potential), length)
    effort = ratio(volume, level)
    return {
        "vocabulary": vocabulary,
        "length": length,
        "volume": volume,
        "level": level,
        "difficulty": ratio(F.lit(1.0), level),
        "intelligence": level * volume,
        "effort": effort,
        "time": effort / 18.0,
    }
