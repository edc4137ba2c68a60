import hashlib
from collections import defaultdict

import numpy as np
import pytest

from keysweep.llm import vector_codes as q
from llm_fixtures import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, x string, code string, error long, l int, n int, part int"


def brute(rows, entries=256, rounds=4):
    """Rows (id, vector, label): the contract with plain integers, all distances evaluated."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            kept.append((i, [int(np.floor(1024 * np.float64(np.float32(c)))) for c in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    x = np.array([r[1] for r in kept], np.int64)
    x = x.reshape(len(kept), 4, x.shape[1] // 4)
    books = [x[:entries, p].copy() for p in range(4)]

    def nearest(p):
        d = ((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        near = [nearest(p)[0] for p in range(4)]
        for p in range(4):
            for e in set(near[p].tolist()):
                mine = x[near[p] == e, p]
                books[p][e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    final = [nearest(p) for p in range(4)]
    error = sum(d for _, d in final)
    by = defaultdict(int)
    for (_, _, label), e in zip(kept, error.tolist()):
        by[label] += e
    sha = hashlib.sha256(",".join(str(v) for b in books for entry in b.tolist() for v in entry).encode()).hexdigest()
    return sorted(((i, "".join(f"{final[p][0][k]:02x}" for p in range(4)), int(error[k]), by[label], sha)
                   for k, (i, _, label) in enumerate(kept)), key=repr), sha


def odd_table(spark, n=700, dim=16):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.choice([-1.5, -0.25, 0.0, 0.125, 2.0], dim) + rng.normal(0, 0.2, dim) * (i % 3)],
             None if i % 7 == 0 else i % 4) for i in range(n)]
    rows += [rows[5], rows[5], (None, rows[9][1], 1), (None, rows[11][1], None)]                 # repeats and null ids
    rows += [(5, rows[8][1], 2)]                                                                  # an id with another vector
    rows += [(-1, None, 1), (-2, [None] + [0.0] * (dim - 1), 1), (-3, [float("nan")] + [0.0] * (dim - 1), 1),
             (-4, [float("-inf")] * dim, None)]
    return rows, spark.createDataFrame([(*r, "x", "c", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(5)


def got(df, **kw):
    return sorted((tuple(r) for r in q.code_report(q.fit_codes(df, **kw)).collect()), key=repr)


def test_odd_rows(spark):
    rows, table = odd_table(spark)
    want, _ = brute(rows)
    assert got(table) == want
    assert got(table, pivots=1) == want and got(table, pivots=40) == want


@pytest.mark.parametrize("entries, rounds", [(256, 4), (5, 3), (1, 1), (17, 0)])
def test_whole_table(spark, entries, rounds):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert got(table, entries=entries, rounds=rounds) == brute(rows, entries, rounds)[0]


def test_ties_and_equal_vectors(spark):
    rows = [(i, [float(i % 3), 1.0, -1.0, 0.5], i % 2) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert got(table) == brute(rows)[0]
    assert {c[1] for c in got(table)} == {"00000000", "01000000", "02000000"}


def test_bounds_save_evaluations_where_vectors_lie_in_groups():
    rng = np.random.default_rng(1)
    centres = rng.integers(-40_000, 40_000, (64, 4))
    x = centres[rng.integers(0, 64, 5000)] + rng.integers(-30, 30, (5000, 4))
    entries = centres + rng.integers(-30, 30, (64, 4))
    pivots = q.choose_pivots(entries, 6)
    assign = q.Assigner(entries, pivots, head=2)
    entry, best = assign(x, q.pivot_distances(x, pivots))
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (entry == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert assign.evaluated < 0.1 * d.size


def test_bounds_hold_for_large_components():
    rng = np.random.default_rng(2)
    x = rng.integers(-q.MAX_COMPONENT, q.MAX_COMPONENT, (300, 16))
    entries = x[:64] + rng.integers(-2, 3, (64, 16))
    pivots = q.choose_pivots(entries, 8)
    entry, best = q.Assigner(entries, pivots, head=4)(x, q.pivot_distances(x, pivots))
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (entry == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_labels_below_the_hot_share_meet_their_sums(spark, monkeypatch):
    rows, table = odd_table(spark)
    monkeypatch.setattr(q, "HOT_SHARE", 5)
    assert got(table) == brute(rows)[0]


def test_empty_and_wrong_tables(spark):
    _, table = odd_table(spark)
    empty = got(table.limit(0))
    assert empty == [] and got(table.where("vec_id < 0")) == []
    assert q.code_report(q.fit_codes(table.limit(0))).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        q.fit_codes(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], "vec_id long, embedding array<float>, label int"))
    with pytest.raises(ValueError):
        q.fit_codes(table, entries=257)
    for other in ([1.0] * 8, [1e12] * 16):
        with pytest.raises(Exception, match="differ in length|larger than"):
            got(table.select("vec_id", "embedding", "label").union(
                spark.createDataFrame([(9999, other, 1)], "vec_id long, embedding array<float>, label int")))
