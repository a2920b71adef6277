import numpy as np
import pytest

from riskspark.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, cid int, flt long, n int"


def brute(rows):
    ok = [(i, np.array(v, np.float64)) if v and all(x is not None and np.isfinite(x) for x in v) and any(v) else (i, None) for i, v in rows]
    links = [[] for _ in ok]
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if x is not None and y is not None and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links[a].append(b)
                links[b].append(a)
    out = []
    for a in range(len(ok)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [ok[b][0] for b in seen if ok[b][0] is not None]
        out.append((ok[a][0], len(links[a]), min(ids, default=None)))
    return out


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA).repartition(parts)
    got = embedding_dedup.digest(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(brute(rows), key=repr)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def cloud(draw, dim, groups, size, spread):
    out = []
    for c in draw.standard_normal((groups, dim)):
        c /= np.linalg.norm(c)
        for _ in range(size):
            e = draw.standard_normal(dim)
            out.append(((c + spread * e / np.linalg.norm(e)) * draw.uniform(0.1, 9)).astype(np.float32).tolist())
    return out


@pytest.mark.parametrize("dim", [2, 5, 16, 64])
def test_links_of_clouds(spark, dim):
    draw = np.random.default_rng(dim)
    vectors = cloud(draw, dim, 8, 12, 0.18) + cloud(draw, dim, 60, 1, 0)
    check(spark, list(enumerate(vectors)))


def test_odd_vectors(spark):
    draw = np.random.default_rng(1)
    v = cloud(draw, 8, 2, 4, 0.05)
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [1.0] * 7, v[0][:4], [x * 1e30 for x in v[0]], [x * 1e-30 for x in v[1]]]
    rows = list(enumerate(v + odd + [v[0], v[0]])) + [(3, v[3]), (None, v[5]), (None, None)]
    check(spark, rows)


@pytest.mark.parametrize("spread", [0.05, 0.1, 0.2])
def test_a_dense_group_in_split_buckets(spark, monkeypatch, spread):
    draw = np.random.default_rng(2)
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    vectors = cloud(draw, 32, 1, 260, spread) + cloud(draw, 32, 2, 60, spread) + cloud(draw, 32, 40, 1, 0)
    check(spark, list(enumerate(vectors + vectors[:5])))


@pytest.mark.parametrize("scale", [1e-300, 1e-200, 1.0, 1e200, 1e300])
@pytest.mark.parametrize("cell", [512, 30])
def test_doubles_of_extreme_scale(spark, monkeypatch, scale, cell):
    draw = np.random.default_rng(7)
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    vectors = [[x * scale for x in v] for v in cloud(draw, 24, 1, 90, 0.05) + cloud(draw, 24, 1, 60, 0.2) + cloud(draw, 24, 20, 1, 0)]
    vectors += [[-0.0, *vectors[0][1:]], [0.0, *vectors[0][1:]]]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.digest(df).collect())
    assert got == sorted(brute([(i, [x / scale for x in v]) for i, v in rows]))


def test_code_grows_with_the_table():
    draw = np.random.default_rng(4)
    u = draw.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    e = draw.standard_normal((4000, 64))
    e -= (e * u).sum(1, keepdims=True) * u
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    w = 0.95 * u + np.sqrt(1 - 0.95**2) * e
    for many in (500, 50_000, 1_000_000):
        words = embedding_dedup.words_for(many)
        a, b = (np.stack(embedding_dedup.decode(v, words)) for v in (u, w))
        met = np.unique(np.concatenate((np.unique(a, axis=1), np.unique(b, axis=1)), axis=1), axis=1, return_counts=True)
        assert len(np.unique(met[0][0][met[1] > 1])) >= 3994
        # pairs of random vectors that share a filter, at the size the code is made for: a few for each vector
        m = np.unique(a[1], return_counts=True)[1].astype(float)
        assert (m * (m - 1)).sum() / 4000**2 * many < 12


def test_equal_vectors_in_number(spark):
    draw = np.random.default_rng(8)
    v = cloud(draw, 16, 3, 3, 0.1)
    check(spark, [(i, v[0]) for i in range(700)] + [(700 + i, x) for i, x in enumerate(v)] + [(None, v[0])] * 5, 5)


def test_recall_of_filters():
    draw = np.random.default_rng(3)
    for dim in (16, 64, 200):
        u = draw.standard_normal((1500, dim))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        e = draw.standard_normal((1500, dim))
        e -= (e * u).sum(1, keepdims=True) * u
        e /= np.linalg.norm(e, axis=1, keepdims=True)
        w = 0.95 * u + np.sqrt(1 - 0.95**2) * e
        a, b = (set(zip(*(x.tolist() for x in embedding_dedup.decode(v)), strict=True)) for v in (u, w))
        assert len({r for r, _ in a & b}) >= 1498


def test_empty_table(spark):
    assert embedding_dedup.digest(spark.createDataFrame([], SCHEMA)).count() == 0
