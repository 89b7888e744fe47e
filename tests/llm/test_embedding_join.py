import numpy as np
import pytest

from voxloom.llm import embedding_join as E


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, node int").repartition(3)


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, kind=np.float32):
    unit = [E.unit(np.array([v], kind))[0] if usable(v) else None for _, v in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(find(i), []).append(d)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return sorted(((d, links[i], least[find(i)], least[find(i)] == d) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(n, groups, size, dim=16, noise=0.05, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = np.concatenate([rng.standard_normal(dim) + noise * rng.standard_normal((size, dim)) for _ in range(groups)])
    return np.concatenate((base, near)).astype(np.float32)


ODD = [
    (9000, None),
    (9001, []),
    (9002, [0.0] * 16),
    (9003, [1.0] * 15 + [None]),
    (9004, [1.0] * 15 + [float("nan")]),
    (9005, [1.0] * 15 + [float("inf")]),
    (9006, [1.0] * 16),
    (9007, [2.0] * 16),
    (9008, [-0.0] * 15 + [1.0]),
    (9009, [0.0] * 15 + [1.0]),
    (9010, [1.0] * 8),
    (9011, [1.0]),
    (9012, [-1.0]),
    (9013, [3.0]),
    (9014, [1e30] * 16),
    (9015, [1e-30] * 16),
    (None, [1.0] * 16),
    (None, [5.0, 1.0]),
    (9016, [0.0] * 15 + [1.0]),
    (9016, [0.0] * 15 + [1.0]),
]


def test_equals_brute_force(spark):
    x = vectors(300, 8, 6)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + ODD
    assert got(E.near_vectors(frame(spark, rows))) == brute(rows)


def test_double_vectors(spark):
    rows = [(int(i), v.astype(float).tolist()) for i, v in enumerate(vectors(50, 3, 5))]
    assert got(E.near_vectors(frame(spark, rows, "double"))) == brute(rows, np.float64)


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(E, "MEMBER_BLOCK", 7)
    monkeypatch.setattr(E, "VISITOR_BLOCK", 11)
    monkeypatch.setattr(E, "CELL_ROWS", 20)
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors(200, 2, 60, noise=0.03))]
    assert got(E.near_vectors(frame(spark, rows))) == brute(rows)


def test_recall_at_the_limit():
    """Pairs that are hardly similar enough are met as often as promised."""
    rng = np.random.default_rng(4)
    sample = E.unit(rng.standard_normal((4000, 64)))
    index = E.MultiIndex(sample, 12, 0.9, 0.98)
    x = E.unit(rng.standard_normal((3000, 64)))
    noise = rng.standard_normal(x.shape)
    noise = E.unit(noise - (noise * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * noise
    a, b = index.order(x, index.visits), index.order(y, index.visits)
    assert ((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean() >= 0.95
    assert index.visits < 144


def test_order_is_the_multi_sequence():
    rng = np.random.default_rng(6)
    index = E.MultiIndex(E.unit(rng.standard_normal((500, 8))), 6, 0.9, 0.9)
    x = E.unit(rng.standard_normal((20, 8)))
    d = [E._distances(p, c) for p, c in zip(index._halves(x), index.codes, strict=True)]
    total = (d[0][:, :, None] + d[1][:, None, :]).reshape(20, -1)
    for visits in (1, 3, 10, 36):
        cells = index.order(x, visits)
        assert np.allclose(np.sort(np.take_along_axis(total, cells, 1), 1), np.sort(total, 1)[:, :visits])
        assert all(len(set(r)) == visits for r in cells.tolist())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(5, [1.0, 2.0]), (3, [2.0, 4.0])]])
def test_small_tables(spark, rows):
    assert got(E.near_vectors(frame(spark, rows))) == brute(rows)


def test_recall_of_the_whole_query_on_a_grid(spark):
    """Pairs just over the limit, in a table large enough for a grid with the settings as they are."""
    rng = np.random.default_rng(4)
    base, x = rng.standard_normal((8000, 32)), E.unit(rng.standard_normal((1000, 32)))
    noise = rng.standard_normal(x.shape)
    noise = E.unit(noise - (noise * x).sum(1, keepdims=True) * x)
    all_ = np.concatenate((base, x, 0.9005 * x + np.sqrt(1 - 0.9005**2) * noise)).astype(np.float32)
    u = E.unit(all_)
    want = sum(int((u[a : a + 1000] @ u.T >= 0.9).sum()) for a in range(0, len(u), 1000)) - len(u)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(all_)])
    (index,) = E.fit(E.vectors(df).select("node", "vec"), 4).values()
    assert len(index.codes[0]) * len(index.codes[1]) == 9 and index.visits < 9
    found = sum(r["n_links"] for r in E.near_vectors(df).select("n_links").collect())
    assert want >= 2000 and want >= found >= E.RECALL * want
