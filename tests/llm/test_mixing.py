from collections import Counter, defaultdict

from pyspark.sql import functions as F

from voxloom.llm import mixing as M

from .conftest import text


def rows_of(n, sources="abcde"):
    return [(i, text(i, 5 + i * 13 % 90), sources[min(i % 11, len(sources) - 1)]) for i in range(n)]


def water(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_budgets(documents):
    rows = rows_of(600)
    source = {i: s for i, _, s in rows}
    out = M.mix(documents(rows)).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    want = water(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * want[s]
        assert abs(taken[s] - want[s]) <= 0.5
        assert {r["source_size"] for r in out if source[r["doc_id"]] == s} == {sizes[s]}


def test_at_most_one_document_is_cut_and_reruns_agree(documents):
    rows = rows_of(400)
    one, two = (sorted(map(tuple, M.mix(documents(rows)).collect())) for _ in range(2))
    assert one == two
    cut = Counter(dict((i, s) for i, _, s in rows)[r[0]] for r in one if r[1] and r[4] % r[1])
    assert all(n == 1 for n in cut.values())


def test_odd_rows(documents):
    rows = [(None, None, None), (None, None, None), (1, "", "a"), (2, "one two", "a"), (2, "one two", "a"), (3, "x " * 50_000, None), (4, "\x1c a\x0bb", "b")]
    out = M.mix(documents(rows, clashing=True)).collect()
    assert sorted(r["size"] for r in out) == [0, 0, 0, 2, 2, 3, 50_000]
    assert M.mix(documents(rows).limit(0)).count() == 0
    empty = M.mix(documents([(1, None, "a"), (2, "", None)])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in empty} == {(0, 0.0, 0)}


def test_documents_of_the_mix(documents):
    rows = rows_of(400)
    docs = documents(rows, clashing=True)
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    copies = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    taken = {r["doc_id"]: r["taken"] / r["size"] for r in M.mix(docs).collect()}
    assert all(abs(copies[i] - t) <= 0.5 for i, t in taken.items())
    words = out.groupBy("source").agg(F.sum(M.word_count(F.col("text"))).alias("n")).collect()
    target = {r["source"]: r["target"] for r in M.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()}
    assert all(abs(r["n"] - target[r["source"]]) <= 50 for r in words)


def test_documents_of_the_mix_with_odd_rows(documents):
    rows = [(None, None, None), (1, "a b", "a"), (1, "a b", "a"), (2, "", "b")]
    assert M.mixed_documents(documents(rows)).count() >= 2
    assert M.mixed_documents(documents(rows).limit(0)).count() == 0
