"""Exact top-k inner-product search with M-trees and best-first search.

Vectors are lifted by one coordinate to equal length, which turns the largest inner products into the smallest Euclidean
distances. Shards of bounded size each hold a tree of pages: a routing entry has a pivot, a covering radius and the distance
to the pivot of its own page. Blocks of queries visit every shard; pages are opened in the order of their distance bound,
and entries whose stored distances already rule them out by the triangle inequality are passed over without computing theirs.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

PAGE = 64
FANOUT = 16
SHARD_ROWS = 8192
QUERY_BLOCK = 512
#: Distances are computed in doubles; bounds are widened by this part of the largest squared length.
SLACK = 1e-9


@dataclass
class Page:
    """Entries of one page. Leaves list ``rows``; routing pages list ``pivots``, ``radii`` and ``pages``."""

    to_parent: np.ndarray
    rows: np.ndarray | None = None
    pivots: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    radii: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pages: list[int] = field(default_factory=list)


class Tree:
    """M-tree over integer vectors of one dimension; the root's pivot is the first vector."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        norms = (self.vectors.astype(np.float64) ** 2).sum(axis=1)
        self.top = float(norms.max())
        self.lifted = np.column_stack([self.vectors.astype(np.float64), np.sqrt(np.maximum(self.top - norms, 0))])
        self.pages: list[Page] = []
        self.root_pivot = self.lifted[0]
        self._build(np.arange(len(ids)), self.root_pivot)
        self.lifted = np.zeros((0, 0))  # pivots are kept in the pages

    def _distances(self, rows: np.ndarray, pivot: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.lifted[rows] - pivot) ** 2).sum(axis=1))

    def _build(self, rows: np.ndarray, pivot: np.ndarray) -> int:
        number = len(self.pages)
        page = Page(np.zeros(0))
        self.pages.append(page)
        if len(rows) <= PAGE:
            page.rows, page.to_parent = rows, self._distances(rows, pivot)
            return number
        # pivots far from each other, each row to its nearest
        chosen = [int(rows[0])]
        nearest = self._distances(rows, self.lifted[chosen[0]])
        own = np.zeros(len(rows), np.int64)
        while len(chosen) < FANOUT and nearest.max() > 0:
            chosen.append(int(rows[int(np.argmax(nearest))]))
            then = self._distances(rows, self.lifted[chosen[-1]])
            own[then < nearest] = len(chosen) - 1
            nearest = np.minimum(nearest, then)
        if len(chosen) == 1:  # all equal: deal them out evenly
            own = np.arange(len(rows)) * FANOUT // len(rows)
            chosen *= FANOUT
        parts = [(p, rows[own == i], nearest[own == i]) for i, p in enumerate(chosen) if (own == i).any()]
        page.pivots = self.lifted[[p for p, *_ in parts]]
        page.radii = np.array([d.max() for *_, d in parts])
        page.to_parent = np.sqrt(((page.pivots - pivot) ** 2).sum(axis=1))
        page.pages = [self._build(part, self.lifted[p]) for p, part, _ in parts]
        return number

    def search(self, query: np.ndarray, own_id: int, k: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) among other ids, best first; ties to the smaller id."""
        lifted = np.append(query.astype(np.float64), 0.0)
        length = float((lifted ** 2).sum())
        slack = SLACK * (length + self.top) + 1e-6
        found: list[tuple[int, int]] = []
        least = -np.inf

        def highest(distance: np.ndarray) -> np.ndarray:
            """Largest score at this distance or further."""
            return (length + self.top - np.maximum(distance, 0) ** 2) / 2 + slack

        start = float(np.sqrt(((self.root_pivot - lifted) ** 2).sum()))
        queue = [(0.0, 0, start)]
        while queue:
            bound, number, to_pivot = heapq.heappop(queue)
            if highest(np.float64(bound)) < least:
                break
            page = self.pages[number]
            if page.rows is not None:
                near = page.rows[highest(np.abs(to_pivot - page.to_parent)) >= least]
                near = near[self.ids[near] != own_id]
                if len(near):
                    scores = self.vectors[near] @ query
                    found.extend(zip((-scores).tolist(), self.ids[near].tolist(), strict=True))
                    found.sort()
                    del found[k:]
                    if len(found) == k:
                        least = -found[-1][0]
                continue
            # by the stored distances alone, before any is computed
            open_ = np.flatnonzero(highest(np.abs(to_pivot - page.to_parent) - page.radii) >= least)
            distances = np.sqrt(((page.pivots[open_] - lifted) ** 2).sum(axis=1))
            for i, distance in zip(open_.tolist(), distances.tolist(), strict=True):
                closest = max(distance - float(page.radii[i]), 0.0)
                if highest(np.float64(closest)) >= least:
                    heapq.heappush(queue, (closest, page.pages[i], distance))
        return [(-score, number) for score, number in found]


def _by_dimension(ids: list[int], vectors: list[list[int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by dimension; rows repeated with their id count once."""
    parts: dict[int, dict[tuple, None]] = {}
    for number, vector in zip(ids, vectors, strict=True):
        parts.setdefault(len(vector), {})[(number, *vector)] = None
    out = {}
    for size, rows in parts.items():
        table = np.array(list(rows), dtype=np.int64).reshape(len(rows), size + 1)
        out[size] = table[:, 0].copy(), table[:, 1:].copy()
    return out


def _packed(df: DataFrame, key: str, tree: bool) -> DataFrame:
    """One row per ``key``: its vectors as trees, or as plain arrays, by dimension."""
    def pack(table: pa.Table) -> pa.Table:
        parts = _by_dimension(table.column("id").to_pylist(), table.column("vector").to_pylist())
        data = {size: Tree(*part) if tree else part for size, part in parts.items() if size}
        return pa.table({key: table.column(key)[:1], "data": pa.array([pickle.dumps(data, protocol=5)], pa.binary())})

    return df.groupBy(key).applyInArrow(pack, f"{key} long, data binary")


def top_k(table: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query row its ``k`` best other rows by integer inner product.

    Components become floor(1024 * x). Vectors that are null or hold a null or non-finite component, and null ids, take no part;
    vectors of different dimension don't meet, an empty one meets none. Ties go to the smaller id. Rows of the query's own id are not its
    candidates; a row repeated with its id and vector counts once. Scores must fit 64 bits.
    """
    valid = F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.col(id_col).isNotNull()
    rows = table.filter(valid).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * 1024)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"))
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("query")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // query_block))
    trees = stored(_packed(rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))), "shard", True), "trees")
    queries = _packed(rows.filter("query").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "block", False)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query_data, tree_data in zip(batch.column(0), batch.column(1), strict=True):
                parts, grown = pickle.loads(query_data.as_py()), pickle.loads(tree_data.as_py())
                out: list[tuple[int, int, int]] = []
                for size, (ids, vectors) in parts.items():
                    if size in grown:
                        for number, vector in zip(ids.tolist(), vectors, strict=True):
                            out.extend((number, other, score) for score, other in grown[size].search(vector, number, k))
                columns = zip(*out, strict=True) if out else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    # a stated query set against all rows, block by block
    met = (
        queries.select(F.col("data").alias("queries"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
        .join(trees, "shard").select("queries", "data")
        .mapInArrow(search, "query_id long, vec_id long, score long")
    )
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
