import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mtree

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(rows, every=10, k=10):
    valid = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = sorted((i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in valid)
    out = []
    for i, v in whole:
        if i % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole if j != i and len(w) == len(v) > 0)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return sorted(out)


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "own", "own") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 10 == 0, **options).collect())


@pytest.mark.parametrize("shard_rows,query_block", [(10_000, 512), (90, 7)])
def test_matches_brute_force(spark, shard_rows, query_block):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(700)]
    rows += [(700 + i, [0.5, 0.25, -0.5, 0.0, 0.1, 0.2]) for i in range(150)]  # equal vectors, ties
    rows += [(900, [1.0, 2.0]), (901, [2.0, 1.0]), (910, []), (920, None), (930, [None] * 6), (940, [float("nan")] * 6), (950, [float("inf")] * 6),
             (None, [0.1] * 6), (10, rows[10][1]), (960, [3e6, -3e6, 1.0, 0.0, 0.0, 0.0])]
    assert result(spark, rows, shard_rows=shard_rows, query_block=query_block) == brute(rows)


def test_distances_are_saved():
    """Best-first search with stored bounds reads a part of clustered vectors only."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 300, (40, 8))
    vectors = np.rint(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 5, (4000, 8))).astype(np.int64)
    tree = mtree.Tree(np.arange(4000), vectors)
    read = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            read.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    tree.vectors = tree.vectors.view(Counted)
    for q in range(0, 4000, 400):
        tree.search(vectors[q], q, 10)
    assert sum(read) < 10 * 4000 / 2


def test_fewer_candidates_than_asked_and_no_rows(spark):
    assert result(spark, [(0, [1.0]), (3, [2.0]), (5, [-1.0])]) == [(0, 1, 3, 2 * 1024 * 1024), (0, 2, 5, -1024 * 1024)]
    assert result(spark, [(0, [1.0])]) == []
    assert result(spark, []) == []
