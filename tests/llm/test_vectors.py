"""The operators on vectors against plain versions, and their stated cases."""

import random

import brute
import numpy as np
import pytest

from sluice.llm import eigen, grid_codes, vp_trees, whitening
from sluice.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
#: Vectors that don't count, of 16 components where they have any.
BAD = [None, [], [float("nan")] * 16, [1.0] * 15 + [None], [float("inf")] + [0.0] * 15, [1.0, 2.0]]
SCHEMA = "vec_id long, embedding array<double>, label int, id string, v string, row string, code string, component string"


def rows_of(vectors, first=0):
    """Ids, vectors and labels, with texts in columns named like the operators' own."""
    return [(i + first, v, None if i % 5 == 4 else i % 3, "a", "b", "c", "d", "e") for i, v in enumerate(vectors)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    base = rng.standard_normal((20, 16))
    found = [(base[i % 20] + 0.3 * rng.standard_normal(16)).tolist() for i in range(260)]
    found += [found[3]] * 30 + [[0.0] * 16] * 2
    rows = rows_of(found, 10) + rows_of(BAD, 1000)
    rows += [(None, found[5], 1, "a", "b", "c", "d", "e"), rows[7], rows[7], (12, found[9], 0, "a", "b", "c", "d", "e")]
    random.Random(1).shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def table(spark, vectors):
    return spark.createDataFrame(vectors, SCHEMA).repartition(5)


def usual(rows):
    """Rows without the one vector of another length."""
    return [r for r in rows if r[1] is None or len(r[1]) != 2]


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def test_grid_codes(vectors, table):
    wanted, digest = brute.grid_codes([r[:3] for r in usual(vectors)])
    got = grid_codes.compress(table)
    assert got.columns == ["vec_id", "embedding", "label", "id", "v", "row", "component", "code", "error",
                           "label_error", "codebooks_sha256"]
    rows = got.collect()
    assert by_id((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows) == by_id(wanted)
    assert {r["codebooks_sha256"] for r in rows} == {digest} and {r["row"] for r in rows} == {"c"}
    few = table.where("vec_id < 15")
    wanted, digest = brute.grid_codes([r[:3] for r in vectors if r[0] is not None and r[0] < 15])
    assert by_id(r[:] for r in grid_codes.compress(few).select("vec_id", "code", "error", "label_error").collect()) == by_id(wanted)
    assert grid_codes.compress(table.limit(0)).collect() == []
    assert grid_codes.compress(table.where("vec_id BETWEEN 1000 AND 1004")).collect() == []


def test_grid_cells_keep_every_nearest_entry():
    rng = np.random.default_rng(2)
    for spread in (1, 3, 40, 5000):
        entries = rng.integers(-spread, spread + 1, (64, 4))
        points = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (3000, 4)), entries])
        cells = grid_codes.GridCells(entries, remembered=200)
        for half in np.array_split(points, 5):
            apart = ((half[:, None, :] - entries[None]) ** 2).sum(axis=2)
            index, least = cells.nearest(half)
            assert (index == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()
        assert len(cells.cells) <= max(200, 3064)
    cells = grid_codes.GridCells(rng.integers(-5000, 5000, (64, 4)))
    for _ in range(3):
        cells.nearest(rng.integers(-5000, 5000, (20000, 4)))
    assert cells.evaluated < 60000 * 16  # a quarter of all entries at most


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 16, 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="268435456"):
        grid_codes.compress(df).collect()
    with pytest.raises(ValueError, match="equal parts"):
        grid_codes.compress(spark.createDataFrame([(1, [1.0] * 17, 0)], "vec_id long, embedding array<double>, label int"))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_eigenpairs(n):
    rng = np.random.default_rng(n)
    turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
    for values in (rng.random(n) * 100, np.ones(n), np.repeat([5.0, 2.0], [n // 2, n - n // 2]), np.zeros(n),
                   1 + 1e-13 * np.arange(n), 10.0 ** -np.arange(n)):
        for matrix in (np.diag(values), (turn * values) @ turn.T):
            matrix = (matrix + matrix.T) / 2
            got, vectors = eigen.leading_pairs(matrix, 8)
            size = max(np.abs(values).max(), 1e-300)
            assert np.abs(got - np.sort(values)[::-1][:8]).max() <= 1e-13 * size * n
            assert np.abs(matrix @ vectors - vectors * got).max() <= 1e-13 * size * n
            assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12


def check_whitening(rows, got):
    """Rows (id, vector) against NumPy's eigenvectors; exact figures in whole numbers."""
    kept = [(i, [int(np.floor(1024 * x)) + 100_000 for x in v]) for i, v in rows if brute.usable(v, True) and len(v) > 2]
    x = np.array([v for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart.astype(float) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"], r["deviation"], r["n"], round(abs(r["whitened"]), 7)) for r in got)
    wanted = sorted((-1 if i is None else i, c + 1, int(d), n, round(abs(float(centred[k] @ vectors[:, c])) / values[c] ** 0.5, 7))
                    for k, ((i, _), d) in enumerate(zip(kept, (apart * apart).sum(axis=1))) for c in range(8))
    assert [f[:4] for f in found] == [w[:4] for w in wanted]
    assert np.allclose([f[4] for f in found], [w[4] for w in wanted], atol=1e-6)
    shares = {r["component"]: r["explained"] for r in got}
    assert np.allclose([shares[c + 1] for c in range(8)], values[:8] / values.sum(), rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_whitening(vectors, table):
    got = whitening.whiten(table).collect()
    check_whitening([r[:2] for r in vectors], got)
    assert len({r["whitened"] for r in whitening.whiten(table.repartition(3)).collect()} ^ {r["whitened"] for r in got}) == 0
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.where("vec_id = 11")).collect() == []
    two = whitening.whiten(table.where("vec_id IN (20, 21)")).collect()
    assert [abs(round(r["whitened"], 9)) for r in two] == [1.0, 1.0] and two[0]["explained"] == pytest.approx(1)


def test_whitening_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(rows, QUERIES["op12_whitening"](spark, FOLDER).collect())


def test_large_deviations(spark):
    rows = [(i, [float(i) * 1e7, -float(i) * 1e7]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [int(i * 1e7) * 1024 for i in range(50)]
    wanted = [2 * (50 * a - sum(x)) ** 2 for a in x]
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: d if d < 1 << 63 else None for i, d in enumerate(wanted)}
    assert {r["component"] for r in got} == {1}


def test_nearest(vectors, table):
    def asked(i):
        return i % 10 == 0 or i in (12, 17)

    rows = [r[:2] for r in usual(vectors)]
    smallest = min(r[1] for r in rows if r[0] == 12)  # of the two vectors of one id
    rows = [r for r in rows if r[0] != 12 or r[1] == smallest]
    found = vp_trees.nearest_vectors(table, table.where("vec_id % 10 = 0 OR vec_id IN (12, 17)"))
    assert sorted(map(tuple, found.collect())) == sorted(brute.nearest_vectors(rows, asked))
    few = table.where("vec_id BETWEEN 20 AND 24")
    assert [tuple(r) for r in vp_trees.nearest_vectors(few, few).orderBy("query_id", "rank").collect()] == brute.nearest_vectors(
        [r[:2] for r in vectors if r[0] is not None and 20 <= r[0] <= 24], lambda i: True)
    assert vp_trees.nearest_vectors(table.limit(0), table).collect() == []
    assert vp_trees.nearest_vectors(table, table.limit(0)).collect() == []


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vp_trees, "SHARD_ROWS", 90)
    monkeypatch.setattr(vp_trees, "QUERY_ROWS", 20)
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(r) for r in df.collect()]
    got = vp_trees.nearest_vectors(df, df.where("vec_id % 7 = 0")).collect()
    assert sorted(map(tuple, got)) == sorted(brute.nearest_vectors(rows, lambda i: i % 7 == 0))


def test_trees_prune_and_factor_one_is_exact():
    rng = np.random.default_rng(5)
    centres = 10 * rng.standard_normal((40, 12))
    points = centres[rng.integers(40, size=4000)] + 0.1 * rng.standard_normal((4000, 12))
    points[1000:1300] = points[0]
    ids = rng.permutation(4000)
    queries = points[::37]
    away = vp_trees.distances(queries, points)
    exact = np.lexsort((np.broadcast_to(ids, away.shape), away), axis=1)[:, :10]
    shares = []
    for relax in (1.0, 4.0):
        tree = vp_trees.VantagePointTree(points, ids)
        rows, found = tree.nearest(queries, 10, relax)
        same = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(rows, exact)])
        assert same == 1.0 if relax == 1.0 else same > 0.9
        if relax == 1.0:
            assert (rows == exact).all() and (found == np.take_along_axis(away, exact, axis=1)).all()
        shares.append(tree.compared / (len(queries) * len(points)))
    assert shares[0] < 0.3 and shares[1] <= shares[0]
