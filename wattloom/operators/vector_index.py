"""Inverted-file vector index: vectors stored by k-means cell, searched cell by cell with an exact re-rank.

Cells are fitted on at most SAMPLE vectors, those of smallest hash; every vector is stored, in the folder of its nearest cell. Vectors are
scaled to length one, so nearest means highest cosine; those of length zero form the cell -1 and are never found, like in ``vector_search``
where their cosine is null and comes last. A search opens the cells whose centres are nearest to the query and ranks what is in them exactly. How many
it opens is measured when the index is built: so many that TRIED vectors of the sample find RECALL of their NEIGHBOURS in it, which are farther off than among all. With
``exact`` it goes on to every cell that could hold a better one: no vector is nearer than the distance to its cell's centre less the cell's radius.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.session import store

SAMPLE, CELLS = 20_000, 64
RECALL, TRIED, NEIGHBOURS, LARGE = 0.95, 400, 5, 0.05
#: In searches of many queries: vectors and queries that meet in one task, and queries in one matrix product.
PART, ASKED, AT_ONCE = 16_384, 16_384, 256


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def scaled(column: str) -> Column:
    wide = F.transform(column, lambda x: x.cast("double"))
    norm = F.sqrt(dot(wide, wide))
    return F.when(norm > 0, F.zip_with(wide, F.array_repeat(norm, F.size(wide)), lambda x, y: x / y))  # a norm inside the lambda is worked out for each element


def probes_for(points: np.ndarray, centres: np.ndarray) -> int:
    """How many nearest cells hold RECALL of the nearest neighbours that some of the points have among all of them, also of those in any one large cell."""
    tried = points[::max(1, len(points) // TRIED)]
    apart = ((points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1))
    cell = apart.argmin(1)
    rank = np.argsort(np.argsort(((tried ** 2).sum(1)[:, None] - 2 * tried @ centres.T + (centres ** 2).sum(1)), axis=1), axis=1)
    nearest = np.argsort(-(tried @ points.T), axis=1)[:, 1:NEIGHBOURS + 1]  # the first is the point itself
    needed = np.take_along_axis(rank, cell[nearest], axis=1)
    if not needed.size:
        return 1
    home = cell[::max(1, len(points) // TRIED)]
    large = [needed[home == c] for c in np.unique(home) if (home == c).mean() >= LARGE]
    return 1 + max(int(np.quantile(part, RECALL, method="higher")) for part in [needed, *large])


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The squared distance of each point to each centre, less the point's own square."""
    return (centres ** 2).sum(1) - 2 * points @ centres.T


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def nearest_pairs(asked: np.ndarray, held: np.ndarray, keys: pa.Array, k: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(row of ``asked``, row of ``held``, cosine) of the k nearest of each, by cosine rounded to six digits and then by key; NaN counts as largest, as in Spark."""
    if not len(asked) or not len(held):
        return pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())
    order = pc.array_sort_indices(keys, null_placement="at_start").to_numpy().astype(np.int64)
    held, found = held[order], []
    for begin in range(0, len(asked), AT_ONCE):
        apart = -np.round(asked[begin:begin + AT_ONCE] @ held.T, 6)
        apart[np.isnan(apart)] = -np.inf
        limit = np.partition(apart, min(k, len(held)) - 1, axis=1)[:, min(k, len(held)) - 1]
        row, to = np.nonzero(apart <= limit[:, None])
        placed = np.lexsort((to, apart[row, to], row))
        row, to = row[placed], to[placed]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        found.append((begin + row[kept], to[kept]))
    at, to = (np.concatenate(x) for x in zip(*found))
    cosine = np.zeros(len(at))
    for i in range(held.shape[1]):  # summed in the order of ``dot``
        cosine += held[to, i] * asked[at, i]
    return pa.array(at), pa.array(order[to]), pa.array(cosine)


class VectorIndex:
    """Vectors of ``key`` and ``column`` below ``path``, one folder for each cell."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, vectors: DataFrame, key: str, column: str, cells: int = CELLS, seed: int = 7) -> None:
        """Fit the cells on a bounded sample and store every vector."""
        units = vectors.select(F.col(key).alias("key"), scaled(column).alias("v"))
        known = units.where("v is not null").withColumn("point", array_to_vector("v"))
        sample = store(known.select("v", F.xxhash64("v").alias("hash")).orderBy("hash").limit(SAMPLE).select("v"), "cells").withColumn("point", array_to_vector("v"))
        points = np.array([r.v for r in sample.select("v").collect()])  # SAMPLE vectors
        size, probes = len(points), 1
        parts = units.where("v is null").select("key", "v", F.lit(None).cast("double").alias("far"), F.lit(-1).alias("cell"))
        centres: list[tuple[int, list[float]]] = []
        if size:
            model = KMeans(k=min(cells, size), seed=seed, featuresCol="point", predictionCol="cell", maxIter=15).fit(sample)
            centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]  # ``cells`` rows
            probes = probes_for(points, np.array([c for _, c in centres]))
            middle = np.array([c for _, c in centres])

            def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if batch.num_rows:
                        v = matrix(batch.column(1))
                        cell = distances(v, middle).argmin(1)
                        far = np.sqrt(((v - middle[cell]) ** 2).sum(1))
                        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far), pa.array(cell.astype(np.int32))], ["key", "v", "far", "cell"])

            kind = units.schema["key"].dataType.simpleString()
            parts = known.select("key", "v").mapInArrow(placed, f"key {kind}, v array<double>, far double, cell int").unionByName(parts)
        parts.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{self.path}/vectors")
        found = self.vectors().where("cell >= 0").groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("size"))
        centre = self.spark.createDataFrame([(i, c, probes) for i, c in centres], "cell int, centre array<double>, probes int")
        centre.join(F.broadcast(found), "cell").coalesce(1).write.parquet(f"{self.path}/cells")  # ``cells`` rows

    def vectors(self) -> DataFrame:
        return self.spark.read.schema("key long, v array<double>, far double, cell int").parquet(f"{self.path}/vectors")

    def cells(self) -> list:
        """Centre, radius and size of each cell: as many rows as there are cells."""
        return self.spark.read.parquet(f"{self.path}/cells").collect()

    def _nearest(self, query: list[float], cells: list[int], k: int) -> DataFrame:
        """The best of some cells; only their folders are read."""
        q = F.array(*map(F.lit, query))
        near = self.vectors().where(F.col("cell").isin(cells)).select("key", dot(F.col("v"), q).alias("cosine"))
        return near.orderBy(F.desc(F.round("cosine", 6)), "key").limit(k)

    def search(self, query: list[float], k: int = 5, probes: int | None = None, exact: bool = False) -> DataFrame:
        """(key, cosine) of the ``k`` nearest vectors among the ``probes`` nearest cells, or, with ``exact``, among all."""
        norm = math.sqrt(sum(float(x) ** 2 for x in query))
        if not norm:
            raise ValueError("a vector of length zero has no direction")
        unit = [float(x) / norm for x in query]
        held = self.cells()
        cells = [(math.dist(unit, c.centre), c.radius, c.cell) for c in held]
        chosen = [cell for _, _, cell in sorted(cells)[:probes or max((c.probes for c in held), default=1)]]
        if exact:
            best = self._nearest(unit, chosen, k).collect()  # k rows
            reach = math.sqrt(max(0.0, 2 - 2 * best[-1].cosine)) + 1e-5 if len(best) == k else math.inf
            chosen = sorted({*chosen, *(cell for far, radius, cell in cells if far - radius <= reach)})
        return self._nearest(unit, chosen, k).select("key", F.round("cosine", 6).alias("cosine"))

    def search_all(self, queries: DataFrame, key: str, column: str, k: int = 5, probes: int | None = None) -> DataFrame:
        """(query, key, cosine, rank): the ``k`` nearest of every query.

        Queries are copied to the parts of their ``probes`` cells. A part has about PART vectors, and a task compares it with about ASKED queries
        at once, by matrix products; only the k best of each query in each part are shuffled and ranked.
        """
        cells = self.cells()
        probes = probes or max((c.probes for c in cells), default=1)
        numbers, centres = np.array([c.cell for c in cells], np.int32), np.array([c.centre for c in cells])
        asked = queries.select(F.col(key).alias("query"), scaled(column).alias("q")).where("q is not null")
        sizes = {c.cell: -(-c.size // PART) for c in cells}
        parts = F.get(F.array(*[F.lit(sizes.get(i, 1)).cast("int") for i in range(max(sizes, default=0) + 1)]), F.col("cell"))
        blocks = max(1, -(-queries.count() // ASKED))

        def each(count: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), count - 1))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows and len(numbers):
                    first = np.argsort(distances(matrix(batch.column(1)), centres), axis=1, kind="stable")[:, :probes]
                    cell = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * first.shape[1], pa.array(numbers[first].ravel()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, cell], ["query", "q", "cell"])

        kind = asked.schema["query"].dataType.simpleString()
        dealt = asked.mapInArrow(near, f"query {kind}, q array<double>, cell array<int>").withColumn("cell", F.explode("cell")).select(
            "query", "q", "cell", each(parts).alias("part"), F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"))
        held = self.vectors().where("cell >= 0").select("key", "v", "cell", F.pmod(F.xxhash64("key"), parts.cast("long")).cast("int").alias("part")).select(
            "*", each(F.lit(blocks)).alias("block"))
        places = ["cell", "part", "block"]

        def best(vectors: pa.Table, wanted: pa.Table) -> pa.Table:
            at, to, cosine = nearest_pairs(matrix(wanted["q"]), matrix(vectors["v"]), vectors["key"].combine_chunks(), k)
            return pa.table({"query": wanted["query"].combine_chunks().take(at), "key": vectors["key"].combine_chunks().take(to), "cosine": cosine})

        pairs = held.groupBy(*places).cogroup(dealt.groupBy(*places)).applyInArrow(best, f"query {kind}, key long, cosine double")
        order = (F.desc("cosine"), F.col("key"))
        ranked = pairs.withColumn("cosine", F.round("cosine", 6)).withColumn(
            "rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)).cast("long"))
        return ranked.where(F.col("rank") <= k).select("query", "key", "cosine", "rank")
