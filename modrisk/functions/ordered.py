"""Exact order statistics, ranks and running totals without a one-task sort.

A window over a whole table, or a percentile that keeps every distinct value,
puts an unbounded group into one task. The functions here cut the ordered axis
into ranges first, at split points taken from quantile sketches. Splits are
fetched once (a bounded list) and used as literals, so that every stage and
every retry sees the same ranges; they only balance the work and never change
a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as Win, functions as F

from modrisk.session import checkpoint_dir

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 1024
SKETCH_ACCURACY = 10_000
MAX_ROUNDS = 12


def _largest_group(rows: DataFrame, by: list[str]) -> int:
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _sketched(rows: DataFrame, by: list[str], value: str, ranges: int) -> DataFrame:
    """Per group the values that cut it into about equal ranges; a frequent value comes several times."""
    marks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return rows.groupBy(*by).agg(F.percentile_approx(value, marks, F.lit(SKETCH_ACCURACY)).alias("_points"))


def _points_of(splits: list, by: list[str]) -> Column:
    """The split points of a row's group."""
    chosen = F.when(F.lit(False), None)
    for keys, points in splits:
        same_group = F.lit(True)
        for name, key in zip(by, keys):
            same_group = same_group & F.col(name).eqNullSafe(F.lit(key))
        chosen = chosen.when(same_group, F.array(*[F.lit(p) for p in points]))
    return chosen


def _place(points: Column, value: Column, spread: Column | None) -> tuple[Column, Column | None]:
    """The range of a value, and its place in there among its equals.

    That is how many split points lie below; a value that is n split points by itself fills n ranges, which its rows are
    dealt to by ``spread``.
    """
    def how_many(test) -> Column:
        return F.greatest(F.coalesce(F.size(F.filter(points, test)), F.lit(0)), F.lit(0))

    below = how_many(lambda p: p < value)
    if spread is None:
        return below, None
    same = F.greatest(how_many(lambda p: p == value), F.lit(1))
    step = F.least(F.floor(spread * same), same - 1)
    return below + step, spread * same - step


def _ranged(
    rows: DataFrame, by: list[str], value: str, wanted: int, spread: Column | None, max_ranges: int
) -> DataFrame:
    """Add ``_range``, ascending with (value, spread): some ``wanted`` ranges a group.

    The first ``max_ranges`` come from one sketch a group, as literals. Where more are wanted each of those is cut again
    by a sketch of its own; those split points, at most ``max_ranges`` a range, are a checkpointed table, so that every
    stage and every retry sees the same ones.
    """
    outer = min(max_ranges, wanted)
    found = _sketched(rows, by, value, outer).collect()
    splits = [([r[k] for k in by], [p for p in r["_points"] or [] if p is not None]) for r in found]
    number, rest = _place(_points_of(splits, by), F.col(value), spread)
    first = rows.withColumn("_range", number.cast("long"))
    inner = min(max_ranges, math.ceil(wanted / outer))
    if inner <= 1:
        return first
    checkpoint_dir(rows.sparkSession)
    keys = [*by, "_range"]
    within = _sketched(first, keys, value, inner).checkpoint()
    within = within.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "_points")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_w_{k}"))
    # At most max_ranges rows a group, of max_ranges values each.
    joined = first.withColumn("_rest", F.lit(None) if rest is None else rest).join(F.broadcast(within), condition, "left")
    deeper, _ = _place(F.col("_points"), F.col(value), None if rest is None else F.col("_rest"))
    return joined.select(*rows.columns, (F.col("_range") * inner + deeper).alias("_range"))


def running_totals(
    rows: DataFrame,
    by: list[str],
    value: str,
    sums: dict[str, str],
    descending: bool = False,
    ties: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    group_totals: dict[str, str] | None = None,
    uniform: bool = False,
    spread: str | None = None,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Add running sums (``sums``: new name -> column) in the order of ``value``.

    ``ties`` orders equal values and must make the order total. ``group_totals``
    adds plain sums per group. Groups must be few, such as models or classes.
    Groups of up to ``rows_per_range`` rows need one window; larger ones a
    window per range, to which the totals of earlier ranges, one row a range,
    are added from a broadcast table. Ranges are as many as the rows need, up to
    ``max_ranges`` times ``max_ranges``. ``uniform`` says that values are evenly
    spread over 0..1, as draws are: ranges are then cut by arithmetic, without a
    sketch. ``spread`` names a column of draws that leads ``ties``, so that rows
    of one frequent value fill several ranges too; it needs ascending order.
    """
    if spread is not None and (descending or not ties or ties[0] != spread):
        raise ValueError("spread leads the ties of an ascending order")
    wholes = group_totals or {}
    counted = _largest_group(rows, by)
    even_ranges = math.ceil(counted / rows_per_range)
    small = even_ranges <= 1
    direction = F.desc if descending else F.asc
    order = [direction(value), *(ties or [])]
    if small:
        inside = Win.partitionBy(*by).orderBy(*order).rowsBetween(Win.unboundedPreceding, 0)
        return rows.select(
            "*",
            *[F.sum(c).over(inside).alias(n) for n, c in sums.items()],
            *[F.sum(c).over(Win.partitionBy(*by)).alias(n) for n, c in wholes.items()],
        )
    if uniform:
        ranged = rows.withColumn("_range", F.floor(F.col(value) * F.lit(even_ranges)).cast("long"))
    else:
        ranged = _ranged(rows, by, value, even_ranges, None if spread is None else F.col(spread), max_ranges)
    inside = Win.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Win.unboundedPreceding, 0)
    per_range = ranged.groupBy(*by, "_range").agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in {**sums, **wholes}.items()]
    )
    before = Win.partitionBy(*by).orderBy(direction("_range")).rowsBetween(Win.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(k).alias(f"_k_{k}") for k in by],
        F.col("_range").alias("_k_range"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(Win.partitionBy(*by)).alias(n) for n in wholes],
    )
    condition = F.col("_range") == F.col("_k_range")
    for k in by:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_l_{n}") for n, c in sums.items()])
    return local.join(F.broadcast(offsets), condition).select(
        *rows.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums], *wholes
    )


def ranked(
    rows: DataFrame,
    by: list[str],
    value: str,
    ties: list[str],
    name: str = "rank",
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
    uniform: bool = False,
    spread: str | None = None,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Row numbers from 1 within each group, spread over ranges of ``value``."""
    ones = rows.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(
        ones, by, value, {name: "_one"}, descending, ties, rows_per_range, uniform=uniform, spread=spread, max_ranges=max_ranges
    ).drop("_one")


def exact_quantiles(
    rows: DataFrame, columns: list[str], probabilities: list[float], small: int = ROWS_PER_RANGE
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several columns, NULLs skipped.

    Three jobs whatever the number of columns and probabilities; see :func:`values_at`.
    """
    def ranks(n: int) -> list[int]:
        return sorted({r for p in probabilities for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}) if n else []

    sizes, found = values_at(rows, {c: probabilities for c in columns}, ranks, small)

    def between(column: str, p: float) -> float | None:
        if not sizes[column]:
            return None
        at, values = (sizes[column] - 1) * p, found[column]
        lo, hi = values[math.floor(at)], values[math.ceil(at)]
        return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))

    return {c: [between(c, p) for p in probabilities] for c in columns}


def _edges_around(x: Column, shares: list[float]) -> Column:
    """Values a little below and above the given shares of a column, from one sketch."""
    slack = 2.0 / SKETCH_ACCURACY
    marks = sorted({min(max(s + d, 0.0), 1.0) for s in shares for d in (-slack, slack)})
    return F.percentile_approx(x, F.array(*[F.lit(m) for m in marks]), F.lit(SKETCH_ACCURACY))


def values_at(
    rows: DataFrame, shares: dict[str, list[float]], ranks, small: int = ROWS_PER_RANGE
) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """How many values each column has, and its values at the 0-based ranks that ``ranks`` names for that many.

    ``shares`` says about where the ranks lie, as shares of the column. Job one brackets all of them with one sketch a
    column. Job two deals every value to its place among all edges of its column, by binary search, and counts: a rank
    then is at an edge, or strictly between two neighbours. Where more than ``small`` values lie between, those two jobs
    are run again with edges from inside; each time some thousandth of the values is left. Job three counts the values
    between the last edges by value and picks the wanted ones; it is left out where all ranks are at edges. Results on
    the driver are bounded by the number of ranks.
    """
    names = list(shares)
    if not names:
        return {}, {}
    x = {c: F.col(f"`{c}`").cast("double") for c in names}
    first = rows.agg(*[_edges_around(x[c], shares[c]).alias(f"s{i}") for i, c in enumerate(names)]).first()
    splits = {c: _splits(first[f"s{i}"] or []) for i, c in enumerate(names)}
    for _ in range(MAX_ROUNDS):
        counts = _dealt(rows, x, splits)
        sizes = {c: sum(counts[c].values()) for c in names}
        found: dict[str, dict[int, float]] = {c: {} for c in names}
        between: dict[tuple[str, int], list[tuple[int, int]]] = {}  # (column, cell) -> (rank, rank within the cell)
        for c in names:
            below, wanted = 0, ranks(sizes[c])
            for cell, n in sorted(counts[c].items()):
                for r in (r for r in wanted if below <= r < below + n):
                    only = _only_value(splits[c], cell)
                    if only is None:
                        between.setdefault((c, cell), []).append((r, r - below))
                    else:
                        found[c][r] = only
                below += n
        crowded = [(c, cell) for c, cell in between if counts[c][cell] > small]
        if not crowded:
            break
        inside = []
        for k, (c, cell) in enumerate(crowded):
            held = (x[c] >= F.lit(splits[c][cell])) & (x[c] < F.lit(splits[c][cell + 1]))
            places = [(place + 0.5) / counts[c][cell] for _, place in between[c, cell]]
            inside.append(_edges_around(F.when(held, x[c]), places).alias(f"s{k}"))
        more = rows.agg(*inside).first()
        for k, (c, _) in enumerate(crowded):
            splits[c] = _splits([*splits[c], *(more[f"s{k}"] or [])])
    else:
        raise RuntimeError(f"ranks not found in {MAX_ROUNDS} rounds")
    for (c, rank), value in _picked(rows, x, splits, between).items():
        found[c][rank] = value
    return sizes, found


def _splits(edges: list[float]) -> list[float]:
    """Lower ends of cells and the last upper end: each edge has a cell of its own, which no other value is in."""
    finite = [e for e in edges if math.isfinite(e)] or [0.0]
    inner = {s for e in finite for s in (e + 0.0, math.nextafter(e, math.inf))}
    return [-math.inf, math.nextafter(-math.inf, 0), *sorted(inner - {math.inf, math.nextafter(-math.inf, 0)}), math.inf]


def _only_value(splits: list[float], cell: int) -> float | None:
    """The value that alone can be in a cell; beyond the last are the cells of infinity and NaN."""
    if cell >= len(splits) - 1:
        return math.inf if cell == len(splits) - 1 else math.nan
    return splits[cell] if splits[cell + 1] == math.nextafter(splits[cell], math.inf) < math.inf else None


def _cell_of(splits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The cell of each value; infinity and NaN have the two after the last."""
    return np.where(np.isnan(values), len(splits), np.searchsorted(splits, values, "right") - 1)


def _columns(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each column that are not null."""
    for i, column in enumerate(batch.columns):
        yield i, column.drop_null().to_numpy(zero_copy_only=False)


def _tallied(batches: Iterator[pa.RecordBatch], splits: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(column, cell, n) of a task's values."""
    sums = [np.zeros(len(s) + 1, np.int64) for s in splits]
    for batch in batches:
        for i, values in _columns(batch):
            sums[i] += np.bincount(_cell_of(splits[i], values), minlength=len(sums[i]))
    for i, n in enumerate(sums):
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cell), i, np.int32)), pa.array(cell.astype(np.int32)), pa.array(n[cell])], names=["column", "cell", "n"]
        )


def _held(batches: Iterator[pa.RecordBatch], splits: list[np.ndarray], wanted: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """(column, cell, x) of the values in wanted cells."""
    for batch in batches:
        for i, values in _columns(batch):
            cell = _cell_of(splits[i], values)
            at = np.flatnonzero(np.isin(cell, wanted[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(cell[at].astype(np.int32)), pa.array(values[at])], names=["column", "cell", "x"]
            )


def _dealt(rows: DataFrame, x: dict[str, Column], splits: dict[str, list[float]]) -> dict[str, dict[int, int]]:
    names = list(x)
    counts: dict[str, dict[int, int]] = {c: {} for c in names}
    plain = rows.select(*[x[c].alias(f"x{i}") for i, c in enumerate(names)])
    tallied = plain.mapInArrow(partial(_tallied, splits=[np.array(splits[c]) for c in names]), "column int, cell int, n long")
    for r in tallied.groupBy("column", "cell").agg(F.sum("n").alias("n")).collect():
        counts[names[r["column"]]][r["cell"]] = r["n"]
    return counts


def _picked(rows: DataFrame, x: dict[str, Column], splits, between) -> dict[tuple[str, int], float]:
    """The values at wanted ranks within cells that hold few values."""
    if not between:
        return {}
    columns = [c for c in x if any(name == c for name, _ in between)]
    asked = [
        F.struct(F.lit(columns.index(c)).alias("c"), F.lit(cell).alias("b"), F.lit(rank).cast("long").alias("rank"), F.lit(place).cast("long").alias("place"))
        for (c, cell), places in between.items() for rank, place in places
    ]
    asked = rows.sparkSession.range(1).select(F.inline(F.array(*asked)))
    plain = rows.select(*[x[c].alias(f"x{i}") for i, c in enumerate(columns)])
    wanted = [[cell for name, cell in between if name == c] for c in columns]
    held = plain.mapInArrow(partial(_held, splits=[np.array(splits[c]) for c in columns], wanted=wanted), "column int, cell int, x double")
    upto = F.sum("count").over(Win.partitionBy("column", "cell").orderBy("x").rowsBetween(Win.unboundedPreceding, 0))
    counted = held.groupBy("column", "cell", "x").count().withColumn("upto", upto)
    hit = counted.join(
        F.broadcast(asked),  # as many rows as ranks are asked for
        (F.col("column") == F.col("c")) & (F.col("cell") == F.col("b")) & (F.col("place") < F.col("upto")) & (F.col("upto") - F.col("count") <= F.col("place")),
    )
    return {(columns[r["column"]], r["rank"]): r["x"] for r in hit.select("column", "rank", "x").collect()}
