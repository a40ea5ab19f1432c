"""Exact search by approximation files and whitening, against brute force."""

import math
import random

import duckdb
import numpy as np
import pytest

from terrace.llm import vafile, whitening
from terrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, x int, node string"


def quantised(rows):
    kept = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept[i] = max(kept.get(i, []), [math.floor(256 * float(np.float32(c))) for c in v])
    return kept


def brute(rows, asked, k):
    kept, out = quantised(rows), []
    for q in kept:
        if asked(q):
            found = sorted((-sum(a * b for a, b in zip(kept[q], v, strict=True)), i) for i, v in kept.items() if i != q and len(v) == len(kept[q]))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def odd_rows(rng):
    near = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(400)]
    rows += [(i, [c + rng.gauss(0, 0.001) for c in near]) for i in range(400, 600)]  # a third lies in one spot
    rows += [(i, [0.5] * 8) for i in range(600, 700)] + [(i, [0.0] * 8) for i in range(700, 703)]
    rows += [(703, None), (704, []), (705, []), (706, [1.0, None] + [0.0] * 6), (707, [float("nan")] * 8), (708, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(709, [1.0, 2.0]), (710, [3.0, 4.0]), (711, [5.0]), rows[0], rows[0], (1, [9.0] * 8)]
    return [(*r, 1, "own") for r in rows]


@pytest.mark.parametrize(("shard", "block", "scan", "read"), [(65_536, 4_096, 1 << 22, 8), (64, 7, 500, 1)])
def test_search_equals_brute_force(spark, monkeypatch, shard, block, scan, read):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("SCAN", scan), ("READ", read)):
        monkeypatch.setattr(vafile, name, value)
    rows = odd_rows(random.Random(5))
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = vafile.search(vectors.where("vec_id % 3 = 0"), vectors, k=4).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == brute(rows, lambda i: i % 3 == 0, 4)


def test_search_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, [0.5], 1, "")], SCHEMA)
    assert vafile.search(none, none).count() == vafile.search(one, none).count() == vafile.search(one, one).count() == 0


def test_huge_components(spark):
    rows = [(i, [s * 3e38, 1.0, -2.0], 1, "") for i, s in ((0, 1), (3, -1), (6, 1e-30), (7, 1))]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = [(r.query_id, r.vec_id, r.score) for r in vafile.search(vectors, vectors, k=3).orderBy("query_id", "rank").collect()]
    assert len(found) == 12 and (0, 7, (1 << 63) - 1) in found and found[2][1:] == (3, -(1 << 63))


def test_bounds_hold_and_cells_pack():
    rng = np.random.default_rng(2)
    points = rng.integers(-300, 300, (500, 5))
    codes, low, high = vafile.approximate(points)
    assert (vafile.unpacked(vafile.packed(codes), 500, 5) == codes).all()
    at = np.arange(5)
    assert (low[at, codes] <= points).all() and (points <= high[at, codes]).all()
    queries = rng.integers(-300, 300, (40, 5)).astype(float)
    lower, upper = vafile.bounds(queries, low[at, codes], high[at, codes])
    exact = queries @ points.T
    assert (lower <= exact).all() and (exact <= upper).all() and (upper - lower).mean() < np.ptp(exact) / 10


def test_few_exact_vectors_are_read(spark):
    """The point of the method: of 500 vectors a query reads a small part."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = vafile.integer_vectors(vectors, "vec_id", "embedding")
    found = vafile.nodes(rows, 5)
    candidates = vafile.scan(rows.where("id % 50 = 0"), vafile.files(found, 1), 1, 1, 5)
    queries = candidates.select("query_id").distinct().count()
    assert candidates.count() < queries * rows.count() / 5


@pytest.mark.parametrize("name", [n for n in ("op11_exact_search",) if n in ORACLES])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want) and want


def plain_whitening(rows, count=4):
    """By the definition: covariance of the distinct vectors and its eigenvectors."""
    x = [(r[0], [math.floor(256 * float(np.float32(c))) for c in r[1]]) for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    widths = [len(v) for _, v in x]
    width = max(set(widths), key=lambda w: (widths.count(w), w))
    x = [(i, v) for i, v in x if len(v) == width]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    out = []
    for i, v in x:
        own = np.array([(n * c - s) / n for c, s in zip(v, sums, strict=True)])
        for c in range(count):
            out.append((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)), abs(own @ vectors[:, c]) / math.sqrt(values[c]), values[c] / np.trace(centred.T @ centred / n)))
    return out


def whitened_equals(found, want, approx=1e-8):
    key = lambda r: (str(r[0]), r[1], r[3], r[4])
    found = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in found], key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    assert [x for r in found for x in r[4:]] == pytest.approx([x for r in want for x in r[4:]], rel=approx, abs=approx)


def test_whitening_equals_eigenvectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(1000, s) for s in (5, 4, 3, 2, 1, 0.5)]) for i in range(300)]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[5][1]), (7, [0.0] * 6), (400, None), (401, [1.0, None] + [0.0] * 4), (402, [float("nan")] * 6), (403, []), (404, [1.0])]
    rows = [(*r, 1, "own") for r in rows]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    whitened_equals(found, plain_whitening(rows))
    assert max(r.identity_error for r in found) < 1e-9 and len({r.identity_error for r in found}) == 1


def test_repeated_deviations_and_low_rank(spark):
    """Equal variances break the recurrence off at once; a dimension without variance gives no component."""
    rows = [(2 * d + s, [float((1 - 2 * s) * (d == e)) for e in range(3)] + [7.0], 1, "") for d in range(3) for s in range(2)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in found} == {1, 2, 3} and {round(r.explained, 12) for r in found} == {round(1 / 3, 12)}
    assert max(r.identity_error for r in found) < 1e-9 and {r.n for r in found} == {6}
    for i in range(6):
        assert sum(r.whitened**2 for r in found if r.vec_id == i) == pytest.approx(3.0)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0]), (2, [2.0])]])
def test_whitening_without_variance(spark, rows):
    assert whitening.whiten(spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)).count() == 0


def test_deviations_are_exact_or_null():
    n, sums = 3, [1 << 40, -7]
    points = np.array([[1 << 20, 5], [1 << 36, -1], [(1 << 61), 0]])
    want = [sum((n * x - s) ** 2 for x, s in zip(r, sums, strict=True)) for r in points.tolist()]
    assert whitening.deviations(points, n, sums) == [w if w < 1 << 63 else None for w in want]
    assert want[0] >= 1 << 63 and whitening.deviations(points, n, [1 << 21, 1])[0] == (3 * (1 << 20) - (1 << 21)) ** 2 + 196


def test_wide_vectors_converge_early(spark, monkeypatch):
    """Beyond the dimensions that are exhausted the recurrence ends when its leading values have converged."""
    monkeypatch.setattr(whitening, "EXHAUST", 8)
    monkeypatch.setattr(whitening, "DIRECT", 1)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 8 / (d + 1)) for d in range(24)], 1, "") for i in range(200)]
    passes = []
    total = whitening.Rows.total
    monkeypatch.setattr(whitening.Rows, "total", lambda self, part: passes.append(1) or total(self, part))
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    whitened_equals(found, plain_whitening(rows), 1e-7)
    assert len(passes) < 2 * 24


def test_registered_whitening(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = QUERIES["op13_whitening"](spark, SF).collect()
    whitened_equals(found, plain_whitening(rows))
    assert found[0].identity_error < 1e-9
