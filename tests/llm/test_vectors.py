import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimark.llm import vectors
from sedimark.llm.queries import ORACLE, QUERIES

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    """n_links and component of every row, from all pairs."""
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    n = len(rows)
    near = np.zeros((n, n), bool)
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i != j and la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                near[i, j] = x @ y / np.sqrt((x @ x) * (y @ y)) >= vectors.COSINE
    best = np.array([r[0] for r in rows])
    while True:
        new = np.array([min(best[i], best[near[i]].min(initial=best[i])) for i in range(n)])
        if (new == best).all():
            return sorted((r[0], int(near[i].sum()), int(best[i]), r[0] == best[i]) for i, r in enumerate(rows))
        best = new


def made(n, seed=0, size=16, labels=3):
    """Random directions; some vectors have near, equal or scaled copies, one group is dense."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size))
    out = []
    for i in range(n):
        kind, v = i % 5, base[i]
        if kind == 1:
            v = base[i - 1] + rng.normal(size=size) * 0.05
        elif kind == 2:
            v = base[i - 2]
        elif kind == 3:
            v = base[0] + rng.normal(size=size) * 0.1
        out.append((i, [float(np.float32(x)) for x in v], 0 if kind in (1, 2, 3) and i % 10 < 5 else i // 5 % labels))
    return out


def result(df):
    return sorted(tuple(r) for r in vectors.near_duplicates(df).collect())


def test_doubles_are_compared_as_doubles(spark):
    """Parts that single precision would round away decide links, in both directions."""
    turn = np.arccos(vectors.COSINE)
    rows = [(1, [1.0, 0.0], 1), (2, [float(np.cos(turn * (1 - 1e-9))), float(np.sin(turn * (1 - 1e-9)))], 1)]
    rows += [(3, [1.0, 0.0], 2), (4, [float(np.cos(turn * (1 + 1e-9))), float(np.sin(turn * (1 + 1e-9)))], 2)]
    found = result(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert found == plain(rows) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


@pytest.mark.parametrize(("leaf", "block"), [(256, 2048), (16, 2048), (16, 24)])
def test_links_equal_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(vectors, "LEAF", leaf)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = made(600)
    assert result(spark.createDataFrame(rows, VECTORS)) == plain(rows)


def test_a_forest_divides_and_loses_no_pair():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(4000, 64))
    near = base + rng.normal(size=base.shape) * 0.015 * np.linalg.norm(base, axis=1)[:, None]
    both = vectors.unit_rows(list(np.concatenate([base, near])), 64)
    assert ((both[:4000] * both[4000:]).sum(axis=1) >= vectors.COSINE).mean() > 0.9
    at, codes = vectors.grow(both, 5).places(both)
    held = [set() for _ in both]
    for row, code in zip(at.tolist(), codes.tolist(), strict=True):
        held[row].add(code)
    pairs = [i for i in range(4000) if both[i] @ both[i + 4000] >= vectors.COSINE]
    assert all(held[i] & held[i + 4000] for i in pairs)
    assert np.bincount(np.unique(codes, return_inverse=True)[1]).max() < len(both) / 4
    assert len(at) / len(both) < 6 * vectors.TREES


@pytest.mark.parametrize(("depth", "mean"), [(12, 0.0), (16, 0.0), (20, 0.0), (12, 0.7), (20, 0.7)])
def test_deep_trees_lose_no_pair(depth, mean):
    """Pairs at the least cosine, also of vectors that share a mean, for which a tree's splits are close to each other."""
    rng = np.random.default_rng(depth)
    shift = np.eye(64)[0] * mean * 8
    sample = vectors.unit_rows(list(rng.normal(size=(8000, 64)) + shift), 64)
    one = sample[:300]
    side = rng.normal(size=one.shape)
    side = vectors.unit_rows(list(side - (side * one).sum(axis=1)[:, None] * one), 64)
    two = vectors.COSINE * one + np.sqrt(1 - vectors.COSINE**2) * side
    forest = vectors.grow(sample, depth)
    at, codes = forest.places(np.concatenate([one, two]))
    per_tree = []
    for t in range(vectors.TREES):
        held = [set() for _ in range(600)]
        mine = codes >> (vectors._LEVELS + 2) == t
        for row, code in zip(at[mine].tolist(), codes[mine].tolist(), strict=True):
            held[row].add(code)
        per_tree.append([bool(held[i] & held[i + 300]) for i in range(300)])
    assert np.any(per_tree, axis=0).all()
    assert np.mean(per_tree) > 1 - 0.0027 * depth
    assert vectors.loss_bound(depth) < 1e-5


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    want = sorted(db.sql(ORACLE["op3_vectors"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op3_vectors"](spark, small).collect()) == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 5), (2, [2.0, 0.0], 5), (3, [1.0, 0.0], 5), (4, [1.0, 0.0], None), (5, None, 5), (6, [0.0, 0.0], 5),
        (7, [nan, 1.0], 5), (8, [inf, 1.0], 5), (9, [None, 1.0], 5), (10, [1.0, 0.0], 6), (11, [], 5), (12, [1.0, 0.0, 0.0], 5),
        (13, [-1.0, 0.0], 5), (14, [1.0, -0.0], 5),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"cid": F.lit("x"), "code": F.lit(1), "copies": F.lit(2)})
    assert result(df) == plain(rows)
    assert result(df.limit(0)) == []
    repeated = spark.createDataFrame([(1, [1.0, 0.0], 5)] * 2 + [(None, [1.0, 0.0], 5)], VECTORS)
    got = sorted(map(tuple, vectors.near_duplicates(repeated).collect()), key=repr)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False)]
    none = spark.createDataFrame([(4, None, 1), (None, None, None)], VECTORS)
    assert sorted(map(tuple, vectors.near_duplicates(none).collect()), key=repr) == [(4, 0, 4, True), (None, 0, None, False)]
