from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from voxloom.llm import ngram_join as N
from voxloom.llm.common import words_of
from voxloom.llm.graph import components, forest

from .conftest import text


def linked(rows):
    """How many rows each is linked with, and the first row that it reaches by links."""
    sets = []
    for _, t in rows:
        w = words_of((t or "").encode())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            root[max(find(i), find(j))] = min(find(i), find(j))
    return links, [find(i) for i in range(len(rows))], sets


def brute(rows):
    links, root, _ = linked(rows)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        known = [x for x in (least[root[i]], d) if x is not None]
        least[root[i]] = min(known) if known else None
    return sorted(((d, least[root[i]], links[i], least[root[i]] == d) for i, (d, _) in enumerate(rows)), key=repr)


def brute_kept(rows):
    """One row of each class: its smallest id, None last, smallest shingle-set hash, smallest text; texts without words by id and text."""
    _, root, sets = linked(rows)
    best, kept = {}, []
    for i, (d, t) in enumerate(rows):
        if not sets[i]:
            if d is None or (d, t or "") not in best:
                best[d, t or ""] = None
                kept.append((d, t))
            continue
        node = N.node_of(N.shingle_sets([t.encode()])[0])
        rank = (d is None, d or 0, node, t.encode())
        if root[i] not in best or rank < best[root[i]][0]:
            best[root[i]] = rank, (d, t)
    return sorted(kept + [x[1] for x in best.values() if x], key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near(seed, words, changed):
    w = text(seed, words).split()
    for k in range(changed):
        w[(k * 97 + 31) % words] = f"changed{seed}{k}"
    return " ".join(w)


ROWS = (
    [(i, text(i, 60 + i)) for i in range(20)]
    + [(100 + i, text(i, 60 + i).upper() + "!") for i in range(5)]
    + [(200 + k, near(50, 200, 0) + f" tail{k}") for k in range(12)]
    + [(300 + k, near(60, 200, k)) for k in range(6)]
    + [(400, ""), (401, None), (402, " .,! "), (403, "one two"), (404, "One, two"), (405, "one")]
    + [(500, "line of words that all share here " + text(70 + k, 30)) for k in range(3)]
    + [(None, text(1, 61)), (None, text(99, 50)), (600, "word " * 30_000), (601, "word " * 20_000), (602, text(7, 67)), (602, text(7, 67))]
)


def test_equals_brute_force(documents):
    assert got(N.classes(documents(ROWS, clashing=True))) == brute(ROWS)


def test_equals_brute_force_with_small_buckets_and_blocks(documents):
    assert got(N.classes(documents(ROWS), small=3, block_shingles=500, block_nodes=3)) == brute(ROWS)


def test_empty_tables(documents):
    assert N.classes(documents(ROWS).limit(0)).count() == 0
    assert N.one_of_each(documents(ROWS).limit(0)).count() == 0
    alone = [(1, text(1, 50)), (2, text(2, 50))]
    assert got(N.classes(documents(alone))) == brute(alone)


def test_one_row_of_each_class_stays(documents):
    """One row for each class of rows: the three unrelated texts of id 500 all stay, the copy of id 1 without an id goes."""
    docs = documents(ROWS, clashing=True)
    out = N.one_of_each(docs)
    assert out.columns == docs.columns
    assert kept_rows(out) == brute_kept(ROWS)


def kept_rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_rows_of_one_id_with_different_texts_are_decided_each(documents):
    a, b, c, d = (text(900 + k, 60) for k in range(4))
    rows = [(3, b), (7, a), (7, b), (7, c), (7, c), (7, c.upper()), (8, a), (9, ""), (9, ""), (9, "..."), (9, d)]
    want = [(3, b), (7, a), (7, min(c, c.upper())), (9, ""), (9, "..."), (9, d)]
    for _ in range(2):
        assert kept_rows(N.one_of_each(documents(rows, clashing=True))) == sorted(want, key=repr)


def test_a_hot_id_of_different_texts_stays_whole(documents):
    rows = [(1, text(2000 + k, 40)) for k in range(40)] + [(10 + k, text(3000 + k, 40)) for k in range(20)] + [(90, text(2003, 40)), (91, text(3001, 40))]
    assert kept_rows(N.one_of_each(documents(rows))) == sorted(rows[:-2], key=repr)


def test_null_ids_are_decided_each(documents):
    a, b, c = (text(950 + k, 60) for k in range(3))
    rows = [(1, a), (None, a), (None, a), (None, b), (None, b), (None, b.title()), (None, c), (None, None), (None, " .")]
    want = [(1, a), (None, min(b, b.title())), (None, c), (None, None), (None, " .")]
    assert kept_rows(N.one_of_each(documents(rows))) == sorted(want, key=repr)


def test_recall_of_the_runs():
    """Pairs of similarity 0.8 meet in a bucket of the first level as often as the runs promise."""
    rng = np.random.default_rng(5)
    runs, met, n = N.runs_for(), 0, 300
    for _ in range(n):
        common = rng.integers(0, 2**63, 80).astype(np.uint64)
        pair = [np.unique(np.concatenate((common, rng.integers(0, 2**63, 10).astype(np.uint64)))) for _ in range(2)]
        a, b = ({p[0] for p in paths} for paths in N.chosen_paths(pair, runs, 0.8, N.DEPTH))
        met += bool(a & b)
    assert met / n >= N.RECALL


def test_recall_at_the_deepest_level():
    """Pairs of similarity 0.8, one within the other, so that they share one child of a common bucket on average and no more."""
    rng, runs, met, n = np.random.default_rng(8), N.runs_for(), 0, 2000
    for _ in range(n):
        longer = np.sort(rng.integers(0, 2**63, 100).astype(np.uint64))
        shorter = np.sort(rng.permutation(longer)[:80])
        a, b = ({p[2] for p in paths} - {None} for paths in N.chosen_paths([shorter, longer], runs, 0.8, N.DEPTH))
        met += bool(a & b)
    print(f"{runs} runs: {n - met} of {n} pairs missed at level 3")
    assert met / n >= 0.999


def test_links_where_all_buckets_are_large(documents):
    rows = []
    for k in range(400):
        words = text(5000 + k, 104, 10**6).split()
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:84]))]
    assert Counter(r["n_links"] for r in N.classes(documents(rows), small=1).collect()) == {1: 800}


def test_paths_deepen_together():
    same = np.sort(np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64))
    a, b = N.chosen_paths([same, same], 10, 0.8, 3)
    assert a == b and all(len(p) == 3 for p in a)


@pytest.mark.parametrize("chain", [2, 3, 17, 40])
def test_components_of_chains_and_stars(spark, chain):
    rows = [(i, i + 1) for i in range(chain - 1)] + [(1000, 1000 + i) for i in range(1, 30)] + [(5000, 5000), (None, 1)]
    got_ = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got_ == {i: 0 for i in range(chain)} | {1000 + i: 1000 for i in range(30)}


def test_forest():
    assert forest(5, [(3, 4), (1, 3)]) == [0, 1, 2, 1, 1]
