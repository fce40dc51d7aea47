import math

import numpy as np

from locusweave.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, k=10):
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if i % 100 == 0}:
        near = []
        for i, w in good:
            if i != q and len(w) == len(v):
                total = 0.0
                for a, b in zip(v, w, strict=True):
                    total += (a - b) * (a - b)
                near.append((math.sqrt(total), i))
        out += [(q, r, i, d) for r, (d, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def test_exact_with_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", 64)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 1, 16).tolist()) for i in range(401)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)] + [(500, None), (600, []), (700, [0.0] * 16), (800, [float("nan")] * 16), (900, [float("inf")] + [1.0] * 15), (1100, [None] + [1.0] * 15)]
    rows += [(None, [1.0] * 16), (1200, [1.0, 2.0]), (1201, [1.0, 3.0]), (300, rows[300][1]), (1300, [1e-30] * 16), (7, rows[8][1])]
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = neighbours.nearest(table, table.where("vec_id % 100 = 0")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_many_blocks_of_bounded_bytes(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 1000)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 8 if i % 3 else 24).tolist()) for i in range(700)]
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = neighbours.nearest(table, table.where("vec_id % 100 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    # candidates are dealt once: only the queries are spread over blocks
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1


def test_few_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0], 1), (3, [0.0, 1.0], 1)], SCHEMA)
    assert [tuple(r) for r in neighbours.nearest(table, table.where("vec_id = 0")).collect()] == [(0, 1, 3, math.sqrt(2))]
    assert neighbours.nearest(table.limit(0), table.limit(0)).collect() == []
    assert neighbours.nearest(table, table.limit(0)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 3, (50, 24)), rng.normal(0, 0.01, (60, 24))
    (qa, sa, na, ea), (qb, sb, nb, eb) = neighbours.quantise(a), neighbours.quantise(b)
    near = np.sqrt(np.maximum(na[:, None] + nb[None] - 2 * sa[:, None] * sb[None] * (qa @ qb.T), 0))
    true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    assert (np.abs(near - true) <= ea[:, None] + eb[None] + 1e-6 * (1 + near)).all()


def test_products_of_many_dimensions_are_exact():
    rng = np.random.default_rng(11)
    v = rng.normal(size=(40, 2048)) + 3
    code, scale, norm, error = neighbours.quantise(v)
    assert np.array_equal(neighbours.products(code, code), code.astype(np.int64) @ code.astype(np.int64).T)
    near = np.sqrt(np.maximum(norm[:, None] + norm[None, :] - 2 * scale[:, None] * scale[None, :] * neighbours.products(code, code), 0))
    true = np.sqrt(((v[:, None] - v[None, :]) ** 2).sum(2))
    assert (np.abs(true - near) <= error[:, None] + error[None, :] + 1e-6 * (1 + near)).all()
