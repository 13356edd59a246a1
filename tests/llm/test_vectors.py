"""Clustering, near-duplicate vectors and whitening against brute force and hard cases."""

import collections
import hashlib
import math

import numpy as np
import pytest

import cases
import oracle
from herald.llm import caps, centroids, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def hard(dims=64):
    """Vectors with everything that may go wrong, beside good ones."""
    draw = np.random.default_rng(3)
    good = [(i, v) for i, v in enumerate(draw.standard_normal((30, dims)).round(3).tolist())]
    base = good[0][1]
    near = [x + 0.01 for x in base]
    return good + [
        (100, None), (101, [None] + base[1:]), (102, [float("nan")] + base[1:]), (103, [float("inf")] + base[1:]),
        (104, []), (105, [0.0] * dims), (106, [-0.0] * dims), (107, base), (107, base), (108, near),
        (None, near), (None, None), (109, [2 * x for x in base]), (110, [-x for x in base]), (3, near)]


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


# --- clustering ------------------------------------------------------------------------

@pytest.mark.parametrize("k,d,spread", [(1, 1, 3), (5, 1, 4), (8, 3, 2), (40, 2, 50), (8, 64, 300), (300, 2, 5000)])
def test_nearest_is_the_nearest(k, d, spread):
    draw = np.random.default_rng(k * d)
    c, x = draw.integers(-spread, spread, (k, d)), draw.integers(-spread, spread, (2500, d))
    all_of = np.square(x[:, None] - c).sum(2)
    who, best, exact = centroids.SortedLists(c).nearest(x)
    assert (who == all_of.argmin(1)).all() and (best == all_of.min(1)).all()  # ties: the smaller number
    assert exact <= len(x) * k
    if (k, d) == (300, 2):
        assert exact < len(x) * k / 4  # the walk ends early


def clusters_by_hand(rows, k, rounds, dims):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c[j] for j in range(len(c))]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, dist, j in found:
        inertia[j] += dist
    return sorted(str((i, j, dist, inertia[j], sum(inertia.values()), c[j])) for i, dist, j in found)


@pytest.mark.parametrize("k", [1, 4, 8, 60])
def test_clusters_equal_hand_made(spark, k):
    got = centroids.cluster(table(spark, hard()).repartition(3), k, 4).collect()
    assert sorted(str(tuple(r)) for r in got) == clusters_by_hand(hard(), k, 4, 64)


def test_too_large_components_stop(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(table(spark, [(1, [3e38] * 64)])).collect()


# --- near duplicates ---------------------------------------------------------------------

def near_by_hand(rows, cosine=0.9):
    good = {n: np.array(v, np.float32).astype(float) for n, (_, v) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {n: v / np.linalg.norm(v) for n, v in good.items()}
    links = collections.defaultdict(set)
    by_size = collections.defaultdict(list)
    for n, v in unit.items():
        by_size[len(v)].append(n)
    for same in by_size.values():
        dots = np.array([unit[n] for n in same]) @ np.array([unit[n] for n in same]).T
        for i, j in np.argwhere(dots >= cosine):
            if i != j:
                links[same[i]].add(same[j])
    label = {}
    for n in range(len(rows)):
        if n not in label:
            seen, todo = {n}, [n]
            while todo:
                for m in links[todo.pop()] - seen:
                    seen.add(m)
                    todo.append(m)
            ids = [rows[m][0] for m in seen if rows[m][0] is not None]
            label |= dict.fromkeys(seen, min(ids, default=None))
    return sorted(str((i, len(links[n]), label[n], i == label[n])) for n, (i, _) in enumerate(rows))


def got_near(df, **more):
    return sorted(str(tuple(r)) for r in caps.near_vectors(df, **more).collect())


@pytest.mark.parametrize("dims", [1, 2, 5, 64])
def test_hard_vectors(spark, dims):
    rows = hard(dims) + [(200, [1.0] * (dims + 1)), (201, [1.0] * (dims + 1)), (202, [0.5] * (dims + 2))]
    assert got_near(table(spark, rows).repartition(3)) == near_by_hand(rows)


def clustered(n, dims=64):
    """Unrelated vectors, pairs about the wanted cosine, chains, and one cluster of near copies."""
    draw = np.random.default_rng(11)
    x = draw.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = draw.standard_normal((n, dims)) / math.sqrt(dims)
    third = n // 3
    x[:third] = x[0] + 0.25 * noise[:third]
    x[third:2 * third] = x[2 * third:3 * third] + draw.uniform(0, 0.6, (third, 1)) * noise[third:2 * third]
    for i in range(third, third + 40):
        x[i + 1] = x[i] / np.linalg.norm(x[i]) + 0.4 * noise[i]
    return [(int(i) * 7 % 10_007, v) for i, v in enumerate(x.tolist())]


@pytest.mark.parametrize("piece", [2048, 100])
def test_clusters_of_near_copies(spark, monkeypatch, piece):
    """The hot cluster's filters are dealt into pieces when they are small."""
    monkeypatch.setattr(caps, "PIECE", piece)
    rows = clustered(1500)
    assert got_near(table(spark, rows)) == near_by_hand(rows)


def test_recall_at_the_cosine():
    """Pairs at exactly the cosine share a filter, at a size where filters are small."""
    draw = np.random.default_rng(1)
    for n, dims in ((51_282, 64), (1_000_000, 384)):
        p = caps.plan(n, dims, 0.9, 0.999999)
        x, y = draw.standard_normal((2, 1500, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        y = 0.9 * x + math.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
        lists = [set(zip(*(a.tolist() for a in caps.decode(caps.units(v), p)))) for v in (x, y)]
        assert len({r for r, _ in lists[0] & lists[1]}) >= 0.999 * len(x)
        assert len(lists[0]) < 80 * len(x) < p.filters * len(x) / 50


def test_decoding_finds_all_filters():
    p = caps.plan(5000, 24, 0.9, 0.99)
    unit = caps.units(np.random.default_rng(2).standard_normal((50, 24)))
    got = set(zip(*(a.tolist() for a in caps.decode(unit, p))))
    want, need = set(), math.ceil(p.threshold * (1 << 34))
    for c, (first, second) in enumerate(zip(*caps.code_words(p))):
        whole = np.rint(unit * (1 << 20))
        dots = (whole @ first.T)[:, :, None] + (whole @ second.T)[:, None, :]
        want |= {(r, (c * p.words + i) * p.words + j) for r, i, j in np.argwhere(dots >= need).tolist()}
    assert got == want
    assert {(r + 7, f) for r, f in zip(*(a.tolist() for a in caps.decode(unit[7:9], p)))} == {
        (r, f) for r, f in got if r in (7, 8)}  # whatever rows are around


# --- whitening -----------------------------------------------------------------------------

MATRICES = {
    "random": lambda r: np.cov(r.standard_normal((200, 12)), rowvar=False),
    "equal values": lambda r: 3 * np.eye(9),
    "two equal leaders": lambda r: np.diag([5.0, 1, 5, 2, 5, 0.5]),
    "one": lambda r: np.array([[4.0]]), "two": lambda r: np.array([[2.0, 1], [1, 2]]),
    "rank one": lambda r: np.outer(np.arange(1.0, 7), np.arange(1.0, 7)),
    "close": lambda r: (lambda q: q @ np.diag([1 + 1e-9, 1, 1 - 1e-9, 1e-3, 0, 0]) @ q.T)(np.linalg.qr(r.standard_normal((6, 6)))[0]),
    "scaled": lambda r: 1e-30 * np.cov(r.standard_normal((50, 70)), rowvar=False),
    "spread": lambda r: (lambda q: q @ np.diag(10.0 ** -np.arange(8)) @ q.T)(np.linalg.qr(r.standard_normal((8, 8)))[0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigen_of_small_matrices(name):
    v = MATRICES[name](np.random.default_rng(4))
    v = (v + v.T) / 2
    values, found = whitening.eigen(v, 4)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    want = want[want > 1e-11 * want[0]]
    assert values == pytest.approx(want, rel=1e-9, abs=1e-15 * want[0])
    assert np.abs(found @ found.T - np.eye(len(found))).max() < 1e-12
    assert np.abs(v @ found.T - found.T * values).max() < 1e-13 * np.abs(v).max() * len(v)


def test_sturm_counts():
    v = np.cov(np.random.default_rng(5).standard_normal((40, 15)), rowvar=False)
    diagonal, off, _ = whitening.tridiagonal(v)
    values, at = np.linalg.eigvalsh(v), np.linspace(-0.5, 4, 57)
    assert whitening.below(diagonal, off, at).tolist() == [int((values < a).sum()) for a in at]


def whitened_by_hand(rows, scale=256):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in kept)
    xs = [[math.floor(scale * float(np.float32(c))) for c in v] + [0] * (width - len(v)) for _, v in kept]
    fit = sorted(set(map(tuple, xs)))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    values, vectors = np.linalg.eigh(np.cov(np.array(fit, float), rowvar=False, bias=True))
    out = []
    for (i, _), x in zip(kept, xs):
        far = sum((n * a - b) ** 2 for a, b in zip(x, s))
        white = [float((np.array(x) - np.array(s) / n) @ vectors[:, -c] / math.sqrt(values[-c])) for c in range(1, 5)]
        out.append((i, n, far, white))
    return out, values[::-1][:4] / values.sum()


def test_whitening_equals_hand_made(spark):
    want, explained = whitened_by_hand(hard())
    got = collections.defaultdict(list)
    for r in whitening.whiten(table(spark, hard()).repartition(3)).collect():
        got[r.vec_id, r.n, int(r.deviation)].append(r)
    count = collections.Counter((i, n, far) for i, n, far, _ in want)
    assert {k: len(v) for k, v in got.items()} == {k: 4 * c for k, c in count.items()}
    signs = {}
    for i, n, far, white in want:
        for r in got[i, n, far]:
            sign = signs.setdefault(r.component, 1 if r.whitened * white[r.component - 1] >= 0 else -1)
            assert r.whitened == pytest.approx(sign * white[r.component - 1], rel=1e-8, abs=1e-9)
            assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
            assert r.identity_error < 1e-9


def test_whitened_copies_weigh_once(spark):
    draw = np.random.default_rng(8)
    rows = [(i, v) for i, v in enumerate(draw.standard_normal((60, 6)).tolist())]
    one = whitening.whiten(table(spark, rows)).collect()
    more = whitening.whiten(table(spark, rows + rows[:1] * 500)).collect()
    assert len(more) == len(one) + 4 * 500
    key = {(r.vec_id, r.component): abs(r.whitened) for r in one}
    assert all(abs(r.whitened) == pytest.approx(key[r.vec_id, r.component], rel=1e-9) for r in more)


@pytest.mark.parametrize("size", [1 << 3, 1 << 25, 1 << 36])
def test_deviations_are_exact(size):
    draw = np.random.default_rng(size)
    x = draw.integers(-size, size, (40, 64))
    for n in (40, 51_282, 1 << 33):
        model = whitening.Whitening(n, [int(v) * (n // 40) for v in x.sum(0)], np.empty((0, 64)), np.empty(0), 1.0)
        want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, model.sums)) for row in x]
        assert model.deviations(x) == want


def test_without_spread(spark):
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9))) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]


# --- all three -------------------------------------------------------------------------------

OPERATORS = {"clusters": centroids.cluster, "near": caps.near_vectors, "whitening": whitening.whiten}


@pytest.mark.parametrize("name", OPERATORS)
def test_tables_without_vectors(spark, name):
    f = OPERATORS[name]
    assert f(table(spark, [])).count() == 0
    nothing = f(table(spark, [(None, None)] * 3))
    assert nothing.count() == (3 if name == "near" else 0)
    assert nothing.columns == f(table(spark, hard())).columns


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns(spark, name):
    names = ["vector", "x", "low", "copies", "cid", "n", "filter", "cluster", "distance", "component", "sums", "label_"]
    from pyspark.sql import functions as F

    df = table(spark, hard())
    got = OPERATORS[name](cases.clashing(df).withColumns({c: F.lit("x") for c in names}))
    want = OPERATORS[name](df)
    if name == "whitening":  # sums of doubles may round differently
        got, want = got.drop("whitened", "identity_error", "explained"), want.drop("whitened", "identity_error", "explained")
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_embedding_near_dedup"])
def test_planted_rows_match_sql(spark, tmp_path, name):
    rows = hard() + [(i + 20_000, v) for i, v in clustered(400)]
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, str(tmp_path))
    assert oracle._rows(got.columns, got.collect()) == oracle._rows(columns, found.fetchall())
