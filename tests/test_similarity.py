"""Neighbours of many entities: exact in blocks, and through an index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import similarity

SCHEMA = "id long, v array<float>"


def vectors():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16))
    data = [centres[i % 30] + rng.standard_normal(16) * 0.4 for i in range(900)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[4][1]) for i in range(300)]  # one vector with a quarter of all rows
    rows += [(2000, [2 * x for x in rows[10][1]]), (2001, [-x for x in rows[10][1]])]
    return rows


def awkward():
    nan = float("nan")
    return [(3000, None), (3001, [0.0] * 16), (3002, [nan] * 16), (3003, [None] * 16), (None, [1.0] * 16), (3004, [float("inf")] * 16)]


def brute_force(rows, wanted, k):
    keys = np.array([r[0] for r in rows])
    units = np.array([r[1] for r in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(wanted(keys)):
        score = np.round(units @ units[i], 9)
        order = [j for j in np.lexsort((keys, -score)) if j != i][:k]
        out[int(keys[i])] = [int(keys[j]) for j in order]
    return out


def neighbours(df):
    out = {}
    for r in df.orderBy("query", "rank").collect():
        out.setdefault(r.query, []).append(r.neighbour)
    return out


def wanted(keys):
    return keys % 100 == 0


@pytest.mark.parametrize("block", [2048, 3])
def test_blocks_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK_QUERIES", block)
    monkeypatch.setattr(similarity, "CELLS", 500)
    df = spark.createDataFrame(vectors() + awkward(), SCHEMA).repartition(5)
    got = neighbours(similarity.nearest(df, "id", "v", F.col("id") % 100 == 0, 7))
    assert got == brute_force(vectors(), wanted, 7)


def test_index_reaches_its_recall(spark):
    df = spark.createDataFrame(vectors() + awkward(), SCHEMA)
    planes = similarity.fit_planes(df, "id", "v", 7, rows_per_bucket=16)
    index = similarity.index_of(df, "id", "v", planes)
    assert index.count() == len(vectors()) * len(planes.normals)
    found = similarity.search(df, "id", "v", F.col("id") % 100 == 0, index, planes, 7)
    exact = similarity.nearest(df, "id", "v", F.col("id") % 100 == 0, 7)
    result = similarity.recall_of(found, exact).first()
    assert result.pairs == 7 * len(brute_force(vectors(), wanted, 7)) and result.recall >= 0.9
    assert all(len(set(n)) == len(n) <= 7 for n in neighbours(found).values())


def test_few_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert similarity.nearest(empty, "id", "v", F.lit(True)).count() == 0
    planes = similarity.fit_planes(empty, "id", "v")
    assert similarity.search(empty, "id", "v", F.lit(True), similarity.index_of(empty, "id", "v", planes), planes).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], SCHEMA)
    assert neighbours(similarity.nearest(two, "id", "v", F.lit(True))) == {1: [2], 2: [1]}


def test_probes_come_by_their_margins():
    margins = np.array([0.3, 0.1, 0.7, 0.2])
    masks = similarity._flips(margins, 16)
    sums = [sum(margins[b] for b in range(4) if m >> b & 1) for m in masks]
    assert sorted(masks) == list(range(16)) and np.allclose(sums, sorted(sums))
