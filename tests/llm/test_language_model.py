import math
from collections import Counter

import pytest

from voxloom.llm import language_model as L
from voxloom.llm.common import words_of

from .conftest import text


def brute(rows, order=3, backoff=0.4, least=1):
    docs = [words_of((t or "").encode()) for _, t in rows]
    counts = Counter(tuple(w[i - n : i]) for w in docs for n in range(1, order + 1) for i in range(n, len(w) + 1))
    total = sum(map(len, docs))

    def score(gram):
        if len(gram) == 1:
            return math.log10(counts[gram] / total)
        if counts[gram] >= least:
            return math.log10(counts[gram] / counts[gram[:-1]])
        return math.log10(backoff) + score(gram[1:])

    out = []
    for (d, _), w in zip(rows, docs, strict=True):
        out.append((d, len(w), sum(score(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))))
    return sorted(out, key=repr)


ROWS = [(i, text(i % 7, 40 + i, 60)) for i in range(40)] + [
    (100, None),
    (101, ""),
    (102, "one"),
    (103, "one two"),
    (104, "--"),
    (105, "one"),
    (105, "one"),
    (None, "É é two"),
    (106, "the " * 20_000),
]


@pytest.mark.parametrize("kwargs", [{}, {"order": 1}, {"order": 2, "backoff": 0.1}, {"least_count": 2}, {"least_count": 3, "backoff": 0.2}, {"order": 4}])
def test_equals_brute_force(documents, kwargs):
    names = {"order": "order", "backoff": "backoff", "least_count": "least"}
    want = brute(ROWS, **{names[k]: v for k, v in kwargs.items()})
    got = sorted(map(tuple, L.backoff_scores(documents(ROWS, clashing=True), chunk_bytes=3000, bucket_bytes=2000, **kwargs).collect()), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-3 for g, w in zip(got, want, strict=True))


def test_empty_tables(documents):
    assert L.backoff_scores(documents(ROWS).limit(0)).count() == 0
    assert [tuple(r) for r in L.backoff_scores(documents([(1, None)])).collect()] == [(1, 0, 0.0)]


def test_every_ngram_counts(documents):
    """A word behind a context of its own is certain, one of two behind a context is even; no n-gram is pruned."""
    got = {r["doc_id"]: r["log10_score"] for r in L.backoff_scores(documents([(1, "a b c"), (2, "d e f"), (3, "d e g")])).collect()}
    assert got[1] == pytest.approx(math.log10(1 / 9), abs=1e-3)
    assert got[2] == got[3] == pytest.approx(math.log10(2 / 9) + math.log10(1 / 2), abs=1e-3)
