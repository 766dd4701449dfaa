"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised to its own codebook; an entry lies in the cell (i, j) of its two centroids. A query
orders the centroids of each half, walks pairs (i, j) by summed nearness with a heap until the cells passed hold enough
entries, and reranks those entries by the exact inner product in double precision.

How many are enough is measured: some vectors of the fitting sample are searched among all of it, and the share of the
entries within which the walk meets the wanted part of their true neighbours (RECALL) holds for every query. Where
vectors cluster the share is small; where they are noise it is large, as no cell then tells much about its entries. The
rule is the same at every size.

Equal vectors are one entry with their smallest ids: as ties go to the smaller id, k + 1 ids of an entry are all that
any query can return. Entries are dealt by first centroid; a centroid with many entries or many queries is split into
blocks, so that a group of a third of all rows is never in one task. Codebooks are fitted on at most SAMPLE vectors;
every row is indexed.

Defined results: vectors that are null, zero, hold null or non-finite components, or have another than the most common
length take no part, nor do null ids. Rows that repeat an id and its vector count once. Queries with fewer than k
candidates return all of them; every query passes cells of more than k entries. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stored, table

#: Vectors on which the codebooks are fitted, and centroids of a half.
SAMPLE, CENTROIDS = 20_000, 256
#: Part of the true neighbours that the walk should meet, and vectors of the sample on which that is measured.
RECALL, MEASURED = 0.94, 256
#: Entries and queries that one task compares at once.
BLOCK_ENTRIES, BLOCK_QUERIES = 4_000, 2_000


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & fine)
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0)).distinct()


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """(v, id, ids): each vector once with its smallest k + 1 ids."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("_n") <= k + 1)
    return first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("v", F.element_at("ids", 1).alias("id"), "ids")


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(7)
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)


def walk(near_a: np.ndarray, near_b: np.ndarray, counts: np.ndarray, enough: int) -> tuple[list[int], list[int]]:
    """Cells in order of summed nearness until they hold enough entries: their i and j. A pair is pushed once the pair before it in its row or, for the first of a row, the row before it was reached."""
    a, b = np.argsort(-near_a, kind="stable"), np.argsort(-near_b, kind="stable")
    da, db = (-near_a[a]).tolist(), (-near_b[b]).tolist()
    a, b = a.tolist(), b.tolist()
    heap, found, out_i, out_j = [(da[0] + db[0], 0, 0)], 0, [], []
    while heap and found < enough:
        _, p, q = heapq.heappop(heap)
        if n := counts[a[p]][b[q]]:
            found += n
            out_i.append(a[p])
            out_j.append(b[q])
        if q + 1 < len(b):
            heapq.heappush(heap, (da[p] + db[q + 1], p, q + 1))
        if q == 0 and p + 1 < len(a):
            heapq.heappush(heap, (da[p + 1] + db[0], p + 1, 0))
    return out_i, out_j


class MultiIndex:
    """Codebooks, cell table and entry counts. The counts are CENTROIDS squared numbers, whatever the corpus."""

    def __init__(self, rows: DataFrame, k: int, centroids: int = CENTROIDS, sample: int = SAMPLE, recall: float = RECALL):
        self.k = k
        entries = stored(entries_of(rows, k), "entries")
        drawn = entries.select("v").orderBy(F.xxhash64("v")).limit(sample).toPandas()["v"]
        self.empty = not len(drawn)
        if self.empty:
            return
        x = np.stack(drawn.to_numpy())
        self.half = x.shape[1] // 2
        self.codebooks = k_means(x[:, : self.half], centroids), k_means(x[:, self.half :], centroids)
        self.entries = stored(self._assigned(entries), "cells")
        self.counts = np.zeros((len(self.codebooks[0]), len(self.codebooks[1])), np.int64)
        for r in self.entries.groupBy("i", "j").count().collect():
            self.counts[r["i"], r["j"]] = r["count"]
        self.share = self._measured_share(x, recall)

    def _measured_share(self, x: np.ndarray, recall: float) -> float:
        """The share of the sample within which the walks of some of its vectors meet so much of their true neighbours: those of the same rank, as a share, as k is among all entries."""
        (first, second), half = self.codebooks, self.half
        i, j = _nearest(x[:, :half], first), _nearest(x[:, half:], second)
        k = max(1, round(self.k * min(1.0, len(x) / self.counts.sum())))
        passed: list[np.ndarray] = []
        for n in range(min(MEASURED, len(x))):
            score = x @ x[n]
            score[n] = -np.inf
            near = (first @ x[n, :half])[i] + (second @ x[n, half:])[j]
            top = np.argpartition(-score, min(k, len(x) - 1))[:k]
            passed.append(np.searchsorted(np.sort(-near), -near[top], side="right"))
        return float(np.quantile(np.concatenate(passed), recall)) / len(x)

    def _assigned(self, entries: DataFrame) -> DataFrame:
        (first, second), half = self.codebooks, self.half

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(0), half + second.shape[1])
                i, j = _nearest(x[:, :half], first), _nearest(x[:, half:], second)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], ["v", "id", "ids", "i", "j"])

        return entries.mapInArrow(assign, "v array<double>, id long, ids array<long>, i int, j int")

    def search(self, queries: DataFrame, share: float | None = None) -> DataFrame:
        """(query_id, rank, vec_id, score) for queries (id, v): the k nearest found of every id but the query's own. share of the entries is reranked, if it is given."""
        spark, k = queries.sparkSession, self.k
        out = "query_id long, rank int, vec_id long, score double"
        if self.empty:
            return spark.createDataFrame([], out)
        (first, second), half, counts = self.codebooks, self.half, self.counts.tolist()
        rerank = max(k + 1, int(np.ceil((self.share if share is None else share) * self.counts.sum())))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), half + second.shape[1])
                a, b = x[:, :half] @ first.T, x[:, half:] @ second.T
                rows, cells, where = [], [], []
                for n in range(len(x)):
                    i, j = walk(a[n], b[n], counts, rerank)
                    by: dict[int, list[int]] = {}
                    for p, q in zip(i, j, strict=True):
                        by.setdefault(p, []).append(q)
                    rows += [n] * len(by)
                    where += by.keys()
                    cells += by.values()
                took = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([took.column(0), took.column(1), pa.array(where, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], ["query_id", "q", "i", "js"])

        probes = stored(queries.mapInArrow(probe, "query_id long, q array<double>, i int, js array<int>"), "probes")
        # Blocks of a first centroid: as many as its entries and its queries need. Both tables have CENTROIDS rows.
        per_i = self.counts.sum(axis=1)
        asked = {r["i"]: r["count"] for r in probes.groupBy("i").count().collect()}
        parts = {i: (-(-int(n) // BLOCK_ENTRIES) or 1, -(-asked.get(i, 0) // BLOCK_QUERIES) or 1) for i, n in enumerate(per_i)}
        sizes = F.broadcast(spark.createDataFrame([(i, e, q) for i, (e, q) in parts.items()], "i int, e_parts int, q_parts int"))
        entries = self.entries.join(sizes, "i").withColumn("eb", F.pmod(F.xxhash64("id"), "e_parts").cast("int"))
        entries = entries.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1))).select("i", "eb", "qb", "v", "id", "ids", "j")
        probes = probes.join(sizes, "i").withColumn("qb", F.pmod(F.xxhash64("query_id"), "q_parts").cast("int"))
        probes = probes.withColumn("eb", F.explode(F.sequence(F.lit(0), F.col("e_parts") - 1))).select("i", "eb", "qb", "query_id", "q", "js")
        width = len(second)

        def rank_block(key: tuple, e: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(e) and len(q):
                e = e.sort_values("id")
                x, j, ids = np.stack(e["v"].to_numpy()), e["j"].to_numpy(), e["ids"].to_numpy()
                for at in range(0, len(q), 256):
                    part = q.iloc[at : at + 256]
                    score = np.stack(part["q"].to_numpy()) @ x.T
                    open_cells = np.zeros((len(part), width), bool)
                    for n, js in enumerate(part["js"]):
                        open_cells[n, js] = True
                    score[~open_cells[:, j]] = -np.inf
                    for n, query in enumerate(part["query_id"].to_numpy()):
                        found += [(query, ids[m], score[n, m]) for m in _best(score[n], k + 1)]
            return pd.DataFrame(found, columns=["query_id", "ids", "score"])

        hits = entries.groupBy("i", "eb", "qb").cogroup(probes.groupBy("i", "eb", "qb")).applyInPandas(rank_block, "query_id long, ids array<long>, score double")
        hits = hits.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
        ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest finite scores, ties to the left."""
    at = np.arange(len(score)) if len(score) <= k else np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    at = at[score[at] > -np.inf]
    return at[np.argsort(-score[at], kind="stable")][:k]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(clean(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return MultiIndex(rows, k=20).search(rows.where("id % 20 = 0"))
