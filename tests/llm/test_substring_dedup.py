import hashlib
import random

import numpy as np
import pytest

from voxloom.llm import substring_dedup as S

from .conftest import text


def brute(rows, length=50):
    order = lambda d: (d is None, d or 0)
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w not in first or order(d) < order(first[w]):
                first[w] = d
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if order(first[b[p : p + length]]) < order(d):
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    passages = [text(1000 + i, 20) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(10**6), rng.randrange(0, 40)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(40)
            parts.insert(rng.randrange(len(parts)), p[a:] if rng.random() < 0.5 else p)
        rows.append((rng.randrange(10**6), " é ".join(parts)))
    return rows


ODD = [
    (1, None),
    (2, ""),
    (3, "a" * 300),
    (4, "a" * 49),
    (5, "a" * 50),
    (6, "ab" * 200),
    (7, "x" + "ab" * 60),
    (8, "\0" * 80 + "b"),
    (9, "\0" * 120),
    (10, text(1, 50)),
    (10, text(1, 50)),
    (10, text(1, 40)),
    (11, text(1, 50)),
    (None, text(1, 50)),
    (None, text(2, 50)),
    (None, text(2, 50)),
    (12, "é" * 200),
    (13, text(3, 30_000)),
    (14, text(3, 30_000)[1000:90_000]),
]


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 2000, "bucket_bytes": 1500}, {"chunk_bytes": 2000, "bucket_bytes": 1500, "hot_runs": 3}, {"hot_runs": 0}])
def test_equals_brute_force(documents, sizes):
    rows = rows_of(4) + ODD
    assert got(S.without_repeats(documents(rows, clashing=True), **sizes)) == brute(rows)


def test_hot_gram_in_many_contexts(documents):
    """One gram in every document: its windows differ, but for some that two documents share; no bucket gets them all."""
    rows = [(i, text(i // 2 if i % 10 < 2 else 100 + i, 12) + " the very same phrase " + text(i // 2 if i % 10 < 2 else 500 + i, 12)) for i in range(100)]
    rows += [(200 + i, t) for i, t in rows[:4]]
    sizes = {"chunk_bytes": 1000, "bucket_bytes": 500}
    assert got(S.without_repeats(documents(rows), **sizes, hot_runs=20)) == got(S.without_repeats(documents(rows), **sizes)) == brute(rows)


def test_single_windows_spread_a_hot_name():
    data = np.frombuffer("".join(text(i, 9) + " the very same phrase " for i in range(300)).encode(), np.uint8)
    names, begin, stop, doc = S.runs(data, np.array([len(data)]))
    n_runs = np.unique(names, return_counts=True)
    hot = names == n_runs[0][n_runs[1].argmax()]
    assert hot.sum() > 20
    own, at, past, of = S._single_windows(data, hot, names, begin, stop, doc, 50)
    assert sorted(np.concatenate([np.arange(b, e) for b, e in zip(at, past, strict=True)])) == sorted(
        np.concatenate([np.arange(b, e) for b, e in zip(begin, stop, strict=True)])
    )
    fine = own[(~hot).sum() :]
    windows = [data[b : b + 50].tobytes() for b in at[(~hot).sum() :]]
    assert len(set(fine.tolist())) == len(set(windows)) == len({(n, w) for n, w in zip(fine.tolist(), windows, strict=True)})
    assert np.unique(fine, return_counts=True)[1].max() <= 2


def test_other_lengths(documents):
    rows = rows_of(5)
    assert got(S.without_repeats(documents(rows), 80)) == brute(rows, 80)


def test_empty_table(documents):
    assert S.without_repeats(documents(ODD).limit(0)).count() == 0


def test_windows_in_passes_and_parts(monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(97, 99, 4000).astype(np.uint8)
    data = np.concatenate((base, base[100:900], np.full(3000, 97, np.uint8), base))
    starts = np.arange(len(data) - 49)
    key = np.searchsorted([4000, 4800, 7800], starts, side="right") % 3
    first = {}
    for s, k in zip(starts.tolist(), key.tolist(), strict=True):
        w = data[s : s + 50].tobytes()
        first[w] = min(first.get(w, 9), k)
    want = [first[data[s : s + 50].tobytes()] < k for s, k in zip(starts.tolist(), key.tolist(), strict=True)]
    for windows in (10**6, 1000, 50):
        monkeypatch.setattr(S, "SORT_WINDOWS", windows)
        assert S.removed_windows(data, starts, key).tolist() == want


def test_equal_windows_have_equal_names():
    data = np.frombuffer((text(1, 3000) + text(1, 3000)).encode(), np.uint8)
    names = S.window_names(data)
    n = len(text(1, 3000))
    assert (names[: n - 49] == names[n : 2 * n - 49]).all()
