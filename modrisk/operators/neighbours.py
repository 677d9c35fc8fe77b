"""Exact k-nearest-neighbour join by two levels of pivot cells.

Vectors are assigned to the nearest of at most ``COARSE`` pivots. A query is
first searched in its own cell, which gives an upper bound of its k-th distance;
the triangle inequality then tells which other cells can hold something nearer,
and the query goes to those only. Cells of any size are dealt in chunks of
``cell_rows`` vectors. Inside a task a chunk has pivots of its own, and a query
looks at the chunk's fine cells in the same way, with its bound falling as it
goes. Nothing is approximated: a cell is skipped only when its nearest possible
point is farther than enough candidates that are known to exist.

Skew: copies of a vector collapse to one vector with its few smallest ids (no
more can ever be among the nearest), crowded cells are dealt in chunks by hash,
and the queries of a crowded cell are salted. On the driver there are the pivots
and three numbers a cell.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as Win, functions as F

from modrisk.session import checkpoint_dir

CELL_ROWS = 16_384
FINE_ROWS = 256
COARSE = 1024
QUERIES = 4096  # queries of a task, about


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), dtype=float).reshape(-1, width)


def _squared(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by products, and how far each row's may be off."""
    a, b = (left * left).sum(axis=1), (right * right).sum(axis=1)
    found = a[:, None] + b[None, :] - 2.0 * (left @ right.T)
    slack = 1e-15 * (left.shape[1] + 8) * 8 * (a + (b.max() if len(b) else 0.0))
    return np.maximum(found, 0.0), slack


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of pairs of rows, by differences."""
    step = left - right
    return np.sqrt((step * step).sum(axis=1))


def _nearest_pivot(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cell = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), QUERIES):
        cell[at : at + QUERIES] = _squared(rows[at : at + QUERIES], pivots)[0].argmin(axis=1)
    return cell, _apart(rows, pivots[cell])


def closest(
    asking: np.ndarray, held: np.ndarray, ids: list[np.ndarray], most: int, bound: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, id, distance): the ``most`` nearest of each query that are not beyond its bound, ties by id."""
    bound = bound.copy()
    order = np.arange(len(held))
    pivots = held[:: max(1, FINE_ROWS)]
    cell, reach = _nearest_pivot(held, pivots)
    order = np.argsort(cell, kind="stable")
    edges = np.searchsorted(cell[order], np.arange(len(pivots) + 1))
    radius = np.array([reach[order[a:b]].max() if b > a else -1.0 for a, b in zip(edges[:-1], edges[1:])])
    to_pivot, slack = _squared(asking, pivots)
    to_pivot, slack = np.sqrt(to_pivot), np.sqrt(slack)
    own = to_pivot.argmin(axis=1)
    best = np.full((len(asking), most), np.inf)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for turn in (0, 1):
        for j in np.flatnonzero(radius >= 0):
            near = own == j if turn == 0 else (own != j) & (to_pivot[:, j] - radius[j] <= bound + slack)
            rows, some = np.flatnonzero(near), order[edges[j] : edges[j + 1]]
            if not len(rows):
                continue
            squares, off = _squared(asking[rows], held[some])
            first = np.sqrt(np.partition(squares, min(most, len(some)) - 1, axis=1)[:, :most] + off[:, None])
            best[rows] = np.sort(np.concatenate([best[rows], first], axis=1), axis=1)[:, :most]
            bound[rows] = np.minimum(bound[rows], best[rows, -1])
            r, c = np.nonzero(squares <= (bound[rows] ** 2 + off)[:, None])
            pairs.append((rows[r], some[c]))
    query, point = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, np.int64) for i in (0, 1))
    still = np.ones(len(query), bool)
    distance = np.empty(len(query))
    for at in range(0, len(query), 1 << 16):
        part = slice(at, at + (1 << 16))
        distance[part] = _apart(asking[query[part]], held[point[part]])
        still[part] = distance[part] <= bound[query[part]] * (1 + 1e-12) + 1e-300
    query, point, distance = query[still], point[still], distance[still]
    copies = np.array([len(ids[p]) for p in point.tolist()], np.int64)
    query, distance = np.repeat(query, copies), np.repeat(distance, copies)
    ident = np.concatenate([ids[p] for p in point.tolist()]) if len(point) else np.zeros(0, np.int64)
    ranked = np.lexsort((ident, distance, query))
    query, ident, distance = query[ranked], ident[ranked], distance[ranked]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < most], ident[place < most], distance[place < most]


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    key: str = "id",
    vector: str = "vector",
    cell_rows: int = CELL_ROWS,
    coarse: int = COARSE,
) -> DataFrame:
    """(key, neighbour, distance, rank): the k nearest candidates of each query.

    A row is never its own neighbour; equal distances go by smaller neighbour
    key. ``vector`` is an array of doubles of one length, ``key`` is a long.
    A null vector has no neighbours and is nobody's.
    """
    checkpoint_dir(queries.sparkSession)
    most = k + 1
    as_array = F.col(vector).cast("array<double>").alias("_v")
    wanted = queries.select(F.col(key).cast("long").alias("_q"), as_array).filter("_v is not null")
    offered = candidates.select(F.col(key).cast("long").alias("_c"), as_array).filter("_v is not null")
    # Row number with a limit is applied before the shuffle too, so a vector
    # with very many copies sends only k + 1 rows from each task.
    few = Win.partitionBy("_v").orderBy("_c")
    points = (
        offered.withColumn("_n", F.row_number().over(few))
        .filter(F.col("_n") <= most)
        .groupBy("_v")
        .agg(F.array_sort(F.collect_list("_c")).alias("_ids"))
        .checkpoint()
    )
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_v")).alias("d")).first()
    if not size["n"]:
        return wanted.select(
            F.col("_q").alias(key), F.lit(None).cast("long").alias("neighbour"),
            F.lit(None).cast("double").alias("distance"), F.lit(None).cast("int").alias("rank"),
        ).limit(0)
    width = size["d"]
    pivot_count = min(coarse, math.ceil(size["n"] / cell_rows))
    chosen = points.select("_v").orderBy(F.md5(F.array_join(F.col("_v").cast("array<string>"), ","))).limit(pivot_count)
    pivots = np.array([r["_v"] for r in chosen.collect()], dtype=float).reshape(-1, width)
    count = len(pivots)

    def to_cells(batches):
        for batch in batches:
            cell, apart = _nearest_pivot(_matrix(batch.column(0), width), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(apart)], names=["_v", "_x", "_cell", "_d"])

    celled = points.mapInArrow(to_cells, "_v array<double>, _x array<long>, _cell int, _d double").withColumnRenamed("_x", "_ids").checkpoint()
    vectors = wanted.groupBy("_v").agg(F.min("_q").alias("_query"))
    own = vectors.select("_v", "_query").mapInArrow(to_cells, "_v array<double>, _x long, _cell int, _d double").select(
        "_v", F.col("_x").alias("_query"), "_cell", F.lit(math.inf).alias("_bound")
    ).checkpoint()
    radius, chunks = np.full(count, -1.0), np.ones(count, dtype=int)
    for r in celled.groupBy("_cell").agg(F.max("_d").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # at most a row per pivot
        radius[r["_cell"]] = r["radius"]
        chunks[r["_cell"]] = math.ceil(r["n"] / cell_rows)

    def searched(asked: DataFrame) -> DataFrame:
        """(_query, neighbour, distance): what each cell and chunk has to offer to the queries sent there."""
        per_cell = np.zeros(count, dtype=int)
        for r in asked.groupBy("_cell").count().collect():
            per_cell[r["_cell"]] = r["count"]
        salts = np.maximum(1, np.ceil(per_cell / QUERIES)).astype(int)
        cell_chunks, cell_salts = (F.get(F.array(*[F.lit(int(x)) for x in numbers]), F.col("_cell")) for numbers in (chunks, salts))
        sent = asked.select(
            "_v", "_query", "_bound", "_cell",
            F.explode(F.sequence(F.lit(0), cell_chunks - 1)).alias("_chunk"),
            F.pmod(F.xxhash64("_query"), cell_salts).cast("int").alias("_salt"),
        )
        held = celled.select(
            "_v", "_ids", "_cell",
            F.pmod(F.xxhash64("_v"), cell_chunks).cast("int").alias("_chunk"),
            F.explode(F.sequence(F.lit(0), cell_salts - 1)).alias("_salt"),
        )

        def search(asking: pa.Table, there: pa.Table) -> pa.Table:
            names = ["_query", "neighbour", "distance"]
            if not asking.num_rows or not there.num_rows:
                return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
            lists = there.column("_ids").combine_chunks()
            ids = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
            found = closest(
                _matrix(asking.column("_v"), width), _matrix(there.column("_v"), width), ids, most, asking.column("_bound").to_numpy()
            )
            return pa.table([pa.array(asking.column("_query").to_numpy()[found[0]]), pa.array(found[1]), pa.array(found[2])], names=names)

        keys = ["_cell", "_chunk", "_salt"]
        return sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(search, "_query long, neighbour long, distance double")

    def lists_of(partial: DataFrame) -> DataFrame:
        best = Win.partitionBy("_query").orderBy("distance", "neighbour")
        kept = partial.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= most)
        return kept.groupBy("_query").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))).alias("_list"))

    lists = lists_of(searched(own))
    if count > 1:
        first = lists.checkpoint()

        def to_others(batches):
            for batch in batches:
                squares, slack = _squared(_matrix(batch.column(0), width), pivots)
                limit = batch.column(3).to_numpy() + np.sqrt(slack)
                others = (np.sqrt(squares) - radius[None, :] <= limit[:, None]) & (radius >= 0)[None, :]
                others[np.arange(len(others)), batch.column(2).to_numpy()] = False
                rows, cells = np.nonzero(others)
                some = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(cells, pa.int32()), some.column(3)], names=["_v", "_query", "_cell", "_bound"]
                )

        known = first.select(F.col("_query").alias("_k"), F.get("_list", F.lit(most - 1))["distance"].alias("_upto"))
        bounded = own.join(known, F.col("_query") == F.col("_k"), "left").select(
            "_v", "_query", "_cell", F.coalesce("_upto", F.lit(math.inf)).alias("_bound")
        )
        asked = bounded.mapInArrow(to_others, "_v array<double>, _query long, _cell int, _bound double").checkpoint()
        more = first.select("_query", F.inline("_list")).select("_query", "neighbour", "distance")
        lists = lists_of(searched(asked).unionByName(more))
    # Back from vectors to rows: each row drops itself from the list of its vector.
    rows = wanted.join(vectors, "_v").join(lists, "_query")
    others = F.slice(F.filter("_list", lambda x: x["neighbour"] != F.col("_q")), 1, k)
    return rows.select(F.col("_q").alias(key), F.posexplode(others).alias("_p", "_x")).select(
        key, F.col("_x.neighbour").alias("neighbour"), F.col("_x.distance").alias("distance"),
        (F.col("_p") + 1).alias("rank"),
    )
