"""Hard negatives against a plain search, and the threshold join against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.llm import hard_negatives as H

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("row", T.StringType())])
NAN, INF = float("nan"), float("inf")


def plain(rows, anchor, positives=5, negatives=10, low=30, high=90):
    part = []
    for n, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            part.append((n, i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    last = [(i is None, i or 0) for i, *_ in rows]
    for n, i, v, label in part:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), *last[m], m, j, other) for m, j, w, other in part if m != n)
        for s, *_, p, other in [x for x in scored if x[5] == label][:positives]:
            near = [x for x in scored if x[5] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, p, k + 1, x[4], -s, -x[0]) for k, x in enumerate(near)]
    return sorted(out, key=repr)


def mined(spark, rows, anchor, **kw):
    df = spark.createDataFrame([(i, v, label, "clash") for i, v, label in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in H.mine(H.prepare(df, anchor=anchor(F.col("vec_id"))), **kw).collect()), key=repr)


def vectors(n, size, seed, labels=4):
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(labels)]
    return [(i, [h * 0.3 + rng.gauss(0, 0.3) for h in heads[i * 7 % labels]], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block_rows", [16, 64, 10_000])
def test_against_plain_search(spark, block_rows):
    rows = vectors(300, 24, 3)
    assert mined(spark, rows, lambda c: c % 10 == 0, block_rows=block_rows) == plain(rows, lambda i: i % 10 == 0)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    same = [0.5, 0.25, -0.5]
    rows = [(i, same, i % 2) for i in range(40)] + [(3, same, 1), (20, same, 0), (20, same, 0)]
    rows += [(100, None, 1), (101, same, None), (102, [0.1, None, 0.2], 1), (103, [NAN, 0.1, 0.1], 1), (104, [INF, 0.1, 0.1], 0)]
    rows += [(105, [0.0, 0.0, 0.0], 1), (110, [0.0, 0.0, 0.0], 0), (106, [], 0), (120, [], 1), (107, [0.5], 0), (130, [0.4, 0.2], 1)]
    rows += [(140, [0.5, 0.25, -0.5, 9.0], 3), (None, [0.3, 0.2, -0.3], 0), (None, [0.3, 0.2, -0.3], 1), (150, [-0.5, -0.25, 0.5], 7)]
    got = mined(spark, rows, lambda c: c % 10 == 0, block_rows=8)
    assert got == plain(rows, lambda i: i is not None and i % 10 == 0) and len(got) > 50


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, [], lambda c: c % 10 == 0) == []
    assert mined(spark, vectors(20, 4, 1), lambda c: c < 0) == []


def test_components_beyond_the_range_take_no_part(spark):
    rows = vectors(30, 4, 2) + [(1000, [1e30, 0.0, 0.0, 0.0], 1)]
    assert mined(spark, rows, lambda c: c % 10 == 0) == plain(rows[:-1], lambda i: i % 10 == 0)
    large = [(i, [60_000.0 + i, -60_000.0, float(i)], i % 2) for i in range(12)]  # sums beyond 2**53
    assert mined(spark, large, lambda c: c % 4 == 0) == plain(large, lambda i: i % 4 == 0)


def test_index_leaves_out_what_norms_bound():
    rng = np.random.default_rng(4)
    scale = np.array([40.0] * 4 + [3.0] * 60)
    x = np.floor(rng.normal(0, 1, (500, 64)) * scale).astype(np.int64)
    block = H.Block(np.arange(500), np.arange(500), np.zeros(500), x)
    q = x[:20][:, block.weight]
    pairs = q @ block.x.T
    norm = np.sqrt((q.astype(float) ** 2).sum(1))
    full = block.index(None).n_postings
    assert full == x.size
    for s in block.shares():
        a, b, score = block.join(q, s)
        want = {(i, j) for i, j in zip(*np.nonzero(pairs >= (s * norm)[:, None]), strict=True)} if s else None
        got = set(zip(a.tolist(), b.tolist(), strict=True))
        assert len(got) == len(a) and (got == want if s else len(got) == pairs.size)
        assert (score == pairs[a, b]).all()
    assert block.index(block.shares()[0]).n_postings < full / 4
