"""Approximate nearest neighbours by an inverted multi-index.

Two codebooks, one for each half of the vector, give every vector a cell (i, j).  A query walks the cells by
the sum of its distances to the two centroids, taken from a heap, until the cells hold ``want`` vectors, and
all entries of those cells are reranked by the exact distance.

Codebooks are fitted on a bounded sample (the ``SAMPLE`` vectors with the smallest hashed ids, fewer if they are wide),
with more centroids the more vectors there are.  ``want`` is measured, not assumed: ``PROBES`` rows of the table, as
queries, are compared with every row once, in blocks, and the walks of ``recall`` of their true nearest end
within ``want`` entries.  So the walk is as long as this table needs: short where vectors
are clustered, however many there are, and long where they are not.  Every vector is indexed.  Cells hold any number of
entries; runs of cells with about a block of entries are what queries are sent to, cells with more are dealt out in blocks.

Vectors that are null, of another length than most, zero, or with a null or non-finite component take no part, nor
do rows with a null id.  Rows that repeat an id are candidates each; a query never finds rows of its own id.
Query rows of one id are one query with several vectors: its list has the nearest to any of them, a candidate once for
each vector that it is near to.  Equal
distances rank by id.  An empty table gives an empty result.  Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, release, table

#: Vectors of the sample, and numbers in it, at most.
SAMPLE, SAMPLE_NUMBERS = 20_000, 1 << 23
#: Rows that stand for queries when the walk is measured.
PROBES = 256
#: Centroids of a half.
CENTROIDS = (4, 512)
#: Rows and queries that one block compares.
ROW_BLOCK, QUERY_BLOCK = 1024, 512


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        owner = _nearest(x, centres)
        counts = np.bincount(owner, minlength=len(centres))
        sums = np.stack([np.bincount(owner, weights=c, minlength=len(centres)) for c in x.T], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None], 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return _distances(x, centres).argmin(1)


def walk_cells(left: np.ndarray, right: np.ndarray, counts: dict[tuple[int, int], int], want: int) -> list[tuple[int, int]]:
    """Cells in the order of left[i] + right[j] until they hold ``want`` entries; empty ones are left out."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen, out, held = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < want:
        _, i, j = heapq.heappop(heap)
        cell = (int(a[i]), int(b[j]))
        if n := counts.get(cell, 0):
            out.append(cell)
            held += n
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (left[a[x]] + right[b[y]], x, y))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(-1, width)


class MultiIndex:
    """Every sound vector of a table with its cell, and how far a walk goes for ``recall`` of the ``k`` nearest.

    ``entries``: (id, v, i, j).  ``rows``, ``want``, ``centroids``: of all vectors, of a walk, of a half.
    """

    def __init__(self, vectors: DataFrame, k: int = 10, recall: float = 0.95, centroids: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding"):
        spark: SparkSession = vectors.sparkSession
        self.k, self.rows, self.want, self.entries = k, 0, 0, None
        sound = "v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)"
        rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(sound).filter("id is not null")
        widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
        if widths is None:
            return
        self.width, self.rows = width, total = widths["width"], widths["n"]
        self.half = half = width // 2
        rows = rows.filter(F.size("v") == width)
        size = max(1, min(SAMPLE, SAMPLE_NUMBERS // width))
        hashed = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
        near = rows.filter(hashed * total < 1.2 * size + 100)  # a few more than are taken
        fit = np.array(near.orderBy(F.xxhash64("id"), "id").limit(size).toPandas()["v"].tolist(), dtype=np.float64).reshape(-1, width)
        if not len(fit):
            fit = np.array([r["v"] for r in rows.limit(size).collect()])
        self.centroids = centroids or int(min(max(CENTROIDS[0], round(total**0.5 / 2)), CENTROIDS[1], max(CENTROIDS[0], len(fit) // 4)))
        found = (kmeans(fit[:, :half], self.centroids) if half else np.zeros((1, 0)), kmeans(fit[:, half:], self.centroids))
        self.books = books = spark.sparkContext.broadcast(found)

        def assign(batches):
            first, second = books.value
            for batch in batches:
                x = _matrix(batch.column("v"), width)
                if len(x):
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(_nearest(x[:, :half], first), pa.int32()), pa.array(_nearest(x[:, half:], second), pa.int32())], ["id", "v", "i", "j"])

        self.entries = cut(rows.mapInArrow(assign, "id long, v array<double>, i int, j int"), "ann-index")
        # At most centroids ** 2 rows, whatever the input.
        self.counts = {(int(r["i"]), int(r["j"])): int(r["n"]) for r in self.entries.groupBy("i", "j").agg(F.count("*").alias("n")).collect()}
        self.want = self._measured(fit, recall)

    def _measured(self, fit: np.ndarray, recall: float) -> int:
        """Entries that walks see until they have met ``recall`` of the probes' true nearest among all rows."""
        hashed = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
        probes = self.entries.filter(hashed * self.rows < 2 * PROBES + 40).orderBy(F.xxhash64("id", F.lit(1)), "id").limit(PROBES).toPandas()
        if len(probes) < 2:
            return self.rows
        k, width = self.k, self.width
        queries = self.entries.sparkSession.sparkContext.broadcast((probes["id"].to_numpy(), np.array(probes["v"].tolist(), dtype=np.float64)))

        def nearest(batches):
            """The k nearest rows of a task for each probe, with their cells."""
            ids, q = queries.value
            best = None
            for batch in batches:
                x = _matrix(batch.column("v"), width)
                who = batch.column("id").to_numpy(zero_copy_only=False)
                cell = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in "ij"], axis=1).astype(np.int64)
                for begin in range(0, len(x), ROW_BLOCK):
                    d = _distances(q, x[begin : begin + ROW_BLOCK])
                    d[ids[:, None] == who[begin : begin + ROW_BLOCK]] = np.inf
                    at = np.argsort(d, axis=1, kind="stable")[:, :k]
                    new = np.take_along_axis(d, at, 1), cell[begin + at]
                    if best is not None:
                        new = np.concatenate([best[0], new[0]], axis=1), np.concatenate([best[1], new[1]], axis=1)
                    at = np.argsort(new[0], axis=1, kind="stable")[:, :k]
                    best = np.take_along_axis(new[0], at, 1), np.take_along_axis(new[1], at[..., None], 1)
            if best is not None:
                n, far = np.nonzero(np.isfinite(best[0]))
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(best[0][n, far]), pa.array(best[1][n, far, 0], pa.int32()), pa.array(best[1][n, far, 1], pa.int32())], ["probe", "d", "i", "j"])

        found = self.entries.select("id", "v", "i", "j").mapInArrow(nearest, "probe int, d double, i int, j int")
        rank = F.row_number().over(Window.partitionBy("probe").orderBy("d", "i", "j"))
        true = found.withColumn("r", rank).filter(F.col("r") <= k).select("probe", "i", "j").toPandas()
        cells = np.array(list(self.counts))
        sizes = np.array(list(self.counts.values()))
        first, second = self.books.value
        seen = []
        for probe, group in true.groupby("probe"):
            v = np.array(probes["v"][probe], dtype=np.float64)[None]
            left, right = _distances(v[:, : self.half], first)[0], _distances(v[:, self.half :], second)[0]
            order = left[cells[:, 0]] + right[cells[:, 1]]
            line = np.argsort(order, kind="stable")
            held = np.cumsum(sizes[line])
            seen += held[np.searchsorted(order[line], left[group["i"]] + right[group["j"]], side="right") - 1].tolist()
        release()
        return min(self.rows, int(np.quantile(seen, recall, method="higher"))) if seen else self.rows

    def _runs(self) -> np.ndarray:
        """A number for each cell (i, j): i's cells are cut into runs of about ROW_BLOCK entries, a cell with more alone.

        Second halves are taken in the order of their largest spread, so that a run's cells are near to each other and few
        queries choose among them."""
        second = self.books.value[1]
        spread = second - second.mean(0)
        line = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable") if second.shape[1] else np.arange(len(second))
        sizes = np.zeros((len(self.books.value[0]), len(second)), dtype=np.int64)
        for (i, j), n in self.counts.items():
            sizes[i, j] = n
        runs = np.zeros(sizes.shape, dtype=np.int32)
        run = 0
        for i in range(len(sizes)):
            run, held = run + 1, 0
            for j in line:
                if held and held + sizes[i, j] > ROW_BLOCK:
                    run, held = run + 1, 0
                runs[i, j] = run
                held += sizes[i, j]
        return runs

    def _blocks(self, is_query: str) -> tuple[DataFrame, DataFrame]:
        """(queries, entries) with the block (run, r, c) where they meet: an entry is in a run of cells, a query in each
        run that it chose cells of.

        A run's entries are dealt to row blocks, its queries to query blocks, and each pair of these is one group, so no group
        grows with what a run holds; an entry is copied only as its own run's queries make it necessary.
        """
        indexed, books, half, want = self.entries, self.books, self.half, self.want + self.k
        shared = indexed.sparkSession.sparkContext.broadcast((self.counts, self._runs()))

        def probe(batches):
            first, second = books.value
            counts, runs = shared.value
            for pdf in batches:
                out = []
                for qid, v in zip(pdf["id"], pdf["v"], strict=True):
                    x = np.asarray(v, dtype=np.float64)[None]
                    chosen: dict[int, np.ndarray] = {}
                    for i, j in walk_cells(_distances(x[:, :half], first)[0], _distances(x[:, half:], second)[0], counts, want):
                        chosen.setdefault(int(runs[i, j]), np.zeros(len(second), dtype=np.uint8))[j] = 1
                    out += [(qid, v, run, np.packbits(js).tobytes()) for run, js in chosen.items()]
                yield pd.DataFrame(out, columns=["qid", "q", "run", "js"])

        def place(batches):
            runs = shared.value[1]
            for batch in batches:
                at = runs[batch.column("i").to_numpy(zero_copy_only=False), batch.column("j").to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), batch.column("j"), pa.array(at, pa.int32())], ["id", "v", "j", "run"])

        probes = cut(indexed.filter(is_query).mapInPandas(probe, "qid long, q array<double>, run int, js binary"), "ann-probes")
        placed = indexed.mapInArrow(place, "id long, v array<double>, j int, run int")
        queries = probes.groupBy("run").agg(F.count("*").alias("nq"))
        rows_of = placed.groupBy("run").agg(F.count("*").alias("nr"))
        sizes = queries.join(rows_of, "run").select("run", F.ceil(F.col("nr") / ROW_BLOCK).cast("int").alias("rb"), F.ceil(F.col("nq") / QUERY_BLOCK).cast("int").alias("qb"))
        sizes = F.broadcast(sizes)  # one row for each run, of which there are no more than cells
        deal = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = probes.join(sizes, "run").withColumn("r", spread("rb")).withColumn("c", deal("qid", "qb"))
        right = placed.join(sizes, "run").withColumn("c", spread("qb")).withColumn("r", deal("id", "rb"))
        return left.select("qid", "q", "js", "run", "r", "c"), right.select("id", "v", "j", "run", "r", "c")

    def search(self, is_query: str) -> DataFrame:
        """query_id, rank, vec_id, score: the ``k`` nearest found of each row for which ``is_query``, a SQL condition on
        the ``id``, holds."""
        k, (left, right) = self.k, self._blocks(is_query)

        def compare(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(q) and len(x):
                x = x.sort_values("id", ignore_index=True)
                ids, m, j = x["id"].to_numpy(), np.array(x["v"].tolist(), dtype=np.float64), x["j"].to_numpy()
                for qid, v, js in zip(q["qid"], q["q"], q["js"], strict=True):
                    at = np.flatnonzero((np.unpackbits(np.frombuffer(js, dtype=np.uint8))[j] == 1) & (ids != qid))
                    if not len(at):
                        continue
                    d = np.sqrt(((m[at] - np.asarray(v)) ** 2).sum(1))
                    best = np.argsort(d, kind="stable")[:k]  # rows are in the order of their ids
                    out.append((np.full(len(best), qid), ids[at[best]], d[best]))
            columns = ["query_id", "vec_id", "score"]
            return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out, strict=True)), strict=True)) if out else {c: [] for c in columns}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

        key = ["run", "r", "c"]
        near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, is_query: str, k: int = 10, recall: float = 0.95, centroids: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row for which ``is_query``, a SQL condition on the
    ``id``, holds."""
    index = MultiIndex(vectors, k, recall, centroids, id_col, vector_col)
    if index.entries is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return index.search(is_query)


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), "id % 100 = 0")
