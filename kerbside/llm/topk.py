"""Exact top-k by inner product, by aggregation of sorted lists without random access.

A vector's score under a query is a sum with one term per dimension. Vectors are kept in blocks; for a
block, every dimension is a list of the block's vectors in order of their component. A query reads the
lists from their good end, a stretch of all lists at a time. Of a vector it then knows the terms it
has read (a lower bound of its score, with the worst possible terms for the rest) and that the unread
terms are no better than the lists' present places (an upper bound). Vectors whose upper bound is below
the k-th best lower bound cannot qualify. Reading stops when few enough are left, or the lists end, and
the final scores of those left are resolved.

The queries of a block read together: which terms a stretch adds depends on the vectors' places in the
lists alone, so the sums of what all queries have read are products of two matrices.

Every block of queries meets every block of vectors once, in a cell of a grid: some blocks of vectors by some
blocks of queries, both moved there by the cell's number. Each pair keeps k rows per query; the best k of all
blocks are found by a grouped merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import written

SCALE = 64
BLOCK_ROWS = 8192
QUERY_ROWS = 256
# A list is read in this many stretches; reading stops at this many survivors per wanted row.
STRETCHES = 6
FEW = 8
# Cells of the grid per core: a cell's blocks are moved once for all its pairs, so few cells move little.
CELLS_PER_CORE = 16
# A cell holds at most this many blocks of vectors and of queries, however many there are.
CELL_BLOCKS = 4
CELL_QUESTIONS = 64
# Cells are dealt by hash: with more tasks than cells seldom two meet in one.
TASKS_PER_CELL = 4
TASKS_PER_CORE = 64
CELL = ["dims", "row", "column"]


def packed(values: np.ndarray) -> bytes:
    largest = int(np.abs(values).max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def unpacked(raw: bytes, rows: int, dims: int) -> np.ndarray:
    """The values of `rows` vectors; the size tells how wide the integers are."""
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[len(raw) // (rows * dims)]
    return np.frombuffer(raw, kind).reshape(rows, dims).astype(np.int64)


def blocks(vectors: DataFrame, id_col: str, vector_col: str, rows: int) -> DataFrame:
    """(block, dims, ids, values): up to `rows` vectors of one length, as bytes, in input order.

    Ids are 64-bit integers, values the smallest integers that hold them all. Components become floor(64 x) of the double x. Vectors that are null, empty, or hold a null or a
    value that is not finite take no part, nor do rows without an id.
    """
    schema = StructType(
        [StructField("block", LongType()), StructField("dims", IntegerType()),
         StructField("ids", BinaryType()), StructField("values", BinaryType())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}

        def full(dims: int) -> pa.RecordBatch:
            nonlocal count
            found, waiting[dims] = waiting[dims], []
            ids = np.array([i for i, _ in found], np.int64).tobytes()
            values = packed(np.array([v for _, v in found], np.int64))
            count += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + count], pa.int64()), pa.array([dims], pa.int32()),
                 pa.array([ids], pa.binary()), pa.array([values], pa.binary())],
                names=schema.names,
            )

        for batch in batches:
            for i, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not vector.is_valid or not len(vector) or vector.values.null_count:
                    continue
                scaled = np.floor(SCALE * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(scaled).all():
                    continue
                held = waiting.setdefault(len(scaled), [])
                held.append((i, scaled.astype(np.int64)))
                if len(held) == rows:
                    yield full(len(scaled))
        for dims in [d for d, held in waiting.items() if held]:
            yield full(dims)

    return vectors.select(F.col(id_col).cast("bigint"), vector_col).mapInArrow(pack, schema)


class SortedLists:
    """A block of vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.largest = float(np.abs(values).max(initial=0))
        order = np.argsort(values, axis=0, kind="stable")
        self.ascending = np.take_along_axis(values, order, axis=0)
        # A vector's place in each list, read from the low end; from the high end it is n - 1 - place.
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(len(values))[:, None], axis=0)

    def best(
        self, queries: np.ndarray, k: int, skip: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows of the best k vectors and their scores, ties to the smaller id.

        `skip` holds for each query the row that takes no part, or -1.
        """
        for query, alive, out in zip(queries, self.survivors(queries, k, skip), skip):
            alive = alive[alive != out]
            scores = self.values[alive] @ query
            chosen = np.lexsort((self.ids[alive], -scores))[:k]
            yield alive[chosen], scores[chosen]

    def survivors(self, queries: np.ndarray, k: int, skip: np.ndarray) -> list[np.ndarray]:
        """For each query the rows that may be among its best k, ascending."""
        n, dims = self.values.shape
        result = [np.arange(n)] * len(queries)
        # Sums of integers are exact in floats while they stay below the floats' own precision.
        largest = self.largest * float(np.abs(queries).max(initial=0)) * dims
        if n <= k * FEW or largest >= 2**52:
            return result
        kind = np.float32 if largest < 2**23 else np.float64
        real, ascending = self.values.astype(kind), self.ascending.astype(kind)
        up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
        low, high = ascending[0], ascending[-1]
        worst = up * low, down * high
        reading = np.arange(len(queries))
        for step in range(1, STRETCHES + 1):
            read = n * step // STRETCHES
            seen_up, seen_down = self.place >= n - read, self.place < read
            known = (real * seen_up) @ up[reading].T + (real * seen_down) @ down[reading].T
            hid_up, hid_down = (~seen_up).astype(kind), (~seen_down).astype(kind)
            # The next places of the lists bound what is unread from above, their far ends from below.
            next_up, next_down = ascending[max(n - 1 - read, 0)], ascending[min(read, n - 1)]
            upper = known + hid_up @ (up[reading] * next_up).T + hid_down @ (down[reading] * next_down).T
            lower = known + hid_up @ worst[0][reading].T + hid_down @ worst[1][reading].T
            own = np.flatnonzero(skip[reading] >= 0)
            lower[skip[reading][own], own] = upper[skip[reading][own], own] = -np.inf
            bar = np.partition(lower, n - k, axis=0)[n - k]
            alive = upper >= bar
            left = alive.sum(axis=0)
            done = (left <= k * FEW) | (step == STRETCHES)
            for j in np.flatnonzero(done):
                result[reading[j]] = np.flatnonzero(alive[:, j])
            reading = reading[~done]
            if not len(reading):
                break
        return result


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each row whose id is divisible by `every`, its k best other rows: query_id, rank, vec_id, score.

    Scores are integer inner products of floor(64 x); ties go to the smaller vec_id. Only the query's own
    row is left out, so rows that repeat an id or a vector are candidates, and queries, like others.
    Vectors are compared with those of the same length. With fewer candidates than k all are returned.
    Other columns are ignored; an empty table gives no rows.
    """
    held = written(blocks(vectors, id_col, vector_col, block_rows), "blocks")
    asked = written(_questions(held, every), "questions")
    given, met, tasks = _cells(held, asked, block_rows)
    schema = StructType(
        [StructField(n, LongType()) for n in ("query_block", "query_row", "query_id", "vec_id", "score")]
    )

    def answer(blocks_of: pa.Table, questions_of: pa.Table) -> pa.Table:
        found = [[np.zeros(0, np.int64)] * len(schema.names)]
        for block, dims, ids, values in zip(*(blocks_of[c] for c in ("block", "dims", "ids", "values"))):
            names = np.frombuffer(ids.as_py(), np.int64)
            lists = SortedLists(names, unpacked(values.as_py(), len(names), dims.as_py()))
            for question in zip(*(questions_of[c] for c in ("q_rows", "q_blocks", "q_ids", "q_values"))):
                *places, raw = (x.as_py() for x in question)
                rows, of, names = (np.frombuffer(x, np.int64) for x in places)
                skip = np.where(of == block.as_py(), rows, -1)
                answers = lists.best(unpacked(raw, len(names), dims.as_py()), k, skip)
                for row, home, name, (best, scores) in zip(rows, of, names, answers):
                    found.append([np.full(len(best), home), np.full(len(best), row),
                                  np.full(len(best), name), lists.ids[best], scores])
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], names=schema.names)

    # The tasks are given on both sides: what is moved is small beside the work, and must not be gathered by its size.
    sides = [side.repartition(tasks, *CELL).groupBy(*CELL) for side in (given, met)]
    scored = sides[0].cogroup(sides[1]).applyInArrow(answer, schema)
    best = Window.partitionBy("query_block", "query_row").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _cells(held: DataFrame, asked: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """The blocks of vectors and those of queries, each once for every cell it belongs to, and how many tasks to take.

    A block of vectors lies in one row of its length's grid and goes to all columns, a block of queries the other way
    round. The grid has about so many cells as keep the cores busy, and such a shape that little is moved.
    """
    cores = held.sparkSession.sparkContext.defaultParallelism

    def numbered(df: DataFrame, key: list[str], name: str) -> DataFrame:
        # Numbers from 0 within a length: one small row per block in this sort.
        nth = F.row_number().over(Window.partitionBy("dims").orderBy(*key)) - 1
        return written(df.select("dims", *key).withColumn("number", nth), name)

    block_numbers = numbered(held, ["block"], "block_numbers")
    question_numbers = numbered(asked, ["q_block", "q_at"], "question_numbers")
    n, m = F.col("blocks"), F.col("questions")
    wanted = F.lit(CELLS_PER_CORE * cores)
    # Moved are columns x blocks + rows x questions, a question being smaller by the rows it holds.
    columns = F.greatest(F.lit(1), F.least(m, F.ceil(F.sqrt(wanted * m * QUERY_ROWS / (n * block_rows)))))
    rows = F.least(n, F.ceil(wanted / columns))
    columns = F.least(m, F.ceil(wanted / rows))
    shape = written(
        block_numbers.groupBy("dims").agg(F.count(F.lit(1)).alias("blocks"))
        .join(question_numbers.groupBy("dims").agg(F.count(F.lit(1)).alias("questions")), "dims")
        .select(
            "dims", "blocks", "questions",
            F.least(F.ceil(n / rows), F.lit(CELL_BLOCKS)).alias("high"),
            F.least(F.ceil(m / columns), F.lit(CELL_QUESTIONS)).alias("wide"),
        )
        .withColumns({"rows": F.ceil(n / F.col("high")), "columns": F.ceil(m / F.col("wide"))}),
        "grid",
    )
    cells = shape.agg(F.sum(F.col("rows") * F.col("columns"))).first()[0] or 1

    def placed(df: DataFrame, numbers: DataFrame, key: list[str], size: str, own: str, other: str, along: str) -> DataFrame:
        return (
            df.join(numbers, ["dims", *key]).join(shape.select("dims", size, along), "dims")
            .withColumn(own, F.floor(F.col("number") / F.col(size)))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(along) - 1)))
        )

    given = placed(held, block_numbers, ["block"], "high", "row", "column", "columns")
    met = placed(asked, question_numbers, ["q_block", "q_at"], "wide", "column", "row", "rows")
    tasks = min(TASKS_PER_CELL * cells, TASKS_PER_CORE * cores)
    return (
        given.select(*CELL, "block", "ids", "values"),
        met.select(*CELL, "q_rows", "q_blocks", "q_ids", "q_values"),
        int(tasks),
    )


def _questions(held: DataFrame, every: int) -> DataFrame:
    """(dims, q_block, q_at, q_rows, q_blocks, q_ids, q_values): the query rows of each block, QUERY_ROWS at a time.

    A question is named by its block and the place in it.
    """
    schema = StructType(
        [StructField("dims", IntegerType()), StructField("q_block", LongType()), StructField("q_at", IntegerType())]
        + [StructField(n, BinaryType()) for n in ("q_rows", "q_blocks", "q_ids", "q_values")]
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                values = unpacked(r["values"], len(ids), r["dims"])
                asked = np.flatnonzero(ids % every == 0)
                for at in range(0, len(asked), QUERY_ROWS):
                    rows = asked[at : at + QUERY_ROWS]
                    parts = (rows.astype(np.int64), np.full(len(rows), r["block"]), ids[rows])
                    raw = [p.tobytes() for p in parts] + [packed(values[rows])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["dims"]], pa.int32()), pa.array([r["block"]], pa.int64()), pa.array([at], pa.int32())]
                        + [pa.array([x], pa.binary()) for x in raw],
                        names=schema.names,
                    )

    return held.select("block", "dims", "ids", "values").mapInArrow(pick, schema)
