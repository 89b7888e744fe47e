import hashlib
import re

import pytest

from voxloom.llm import decontamination as D

from .conftest import text

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    windows = []
    for name, t in items:
        w = words(t)
        if w:
            n = min(13, len(w))
            windows += [(name, w[i : i + n]) for i in range(len(w) - n + 1)]
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, x in windows:
            for p in range(len(w) - len(x) + 1):
                if w[p : p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    names |= {str(name)} - {"None"}
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [
    (1, text(1, 30)),
    (2, text(2, 13)),
    (10, "Four Short words; HÉRE"),
    (11, "solo"),
    (12, None),
    (13, " .,! "),
    (14, text(1, 30)),
    (None, text(3, 20)),
    (15, "the " * 40),
]
DOCS = [
    (1, f"before {text(1, 30)} after"),
    (2, f"{text(5, 40)} {text(2, 13).upper()} {text(6, 2000)}"),
    (3, "four, short-words hére. Four short words HÉRE"),
    (4, None),
    (5, ""),
    (6, "the " * 30 + "end " + "the " * 12),
    (7, text(1, 12)),
    (8, text(8, 300) + " solo"),
    (8, text(8, 300) + " solo"),
    (None, text(2, 13)),
    (9, text(3, 20)),
    (10, " ".join(text(1, 30).split()[:14]) + " x " + " ".join(text(1, 30).split()[16:])),
]


def test_equals_brute_force(spark, documents):
    for clashing in (False, True):
        assert got(D.contamination(documents(DOCS, clashing), items_of(spark, ITEMS))) == brute(DOCS, ITEMS)


def test_blocks_of_items_add_up(spark, documents, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)
    assert got(D.contamination(documents(DOCS), items_of(spark, ITEMS))) == brute(DOCS, ITEMS)


def test_no_items_and_no_documents(spark, documents):
    none = items_of(spark, ITEMS).limit(0)
    assert got(D.contamination(documents(DOCS), none)) == brute(DOCS, [])
    assert D.contamination(documents(DOCS).limit(0), items_of(spark, ITEMS)).count() == 0


def test_a_lower_containment_finds_changed_windows(spark, documents):
    changed = text(1, 13).split()
    changed[0] = "other"
    docs = documents([(1, " ".join(changed)), (2, text(9, 50))])
    items = items_of(spark, [(1, text(1, 13))])
    assert {r["doc_id"]: r["n_hit"] for r in D.contamination(docs, items).collect()} == {1: 0, 2: 0}
    assert {r["doc_id"]: r["n_hit"] for r in D.contamination(docs, items, containment=0.8).collect()} == {1: 13, 2: 0}


def test_filter_keeps_clean_rows_whole(spark, documents):
    docs = documents(DOCS, clashing=True)
    out = D.without_contaminated(docs, items_of(spark, ITEMS))
    assert out.columns == docs.columns
    hits = brute(DOCS, ITEMS)
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted((r[0] for r in hits if not r[2]), key=repr)
    out = D.without_contaminated(docs, items_of(spark, ITEMS), least_share=0.05)
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted((r[0] for r in hits if not r[5]), key=repr)


def test_a_passage_in_a_long_document_is_enough(spark, documents):
    """One window among 5,000 words, far below a share of 5 %."""
    passage = " ".join(text(1, 30).split()[8:21])
    docs = documents([(1, f"{text(20, 2500)} {passage} {text(21, 2500)}"), (2, text(22, 5000)), (3, text(1, 12)), (4, None), (4, "")])
    assert sorted(r["doc_id"] for r in D.without_contaminated(docs, items_of(spark, [(1, text(1, 30))])).collect()) == [2, 3, 4, 4]


def test_filter_without_items_or_documents(spark, documents):
    none = items_of(spark, ITEMS).limit(0)
    assert D.without_contaminated(documents(DOCS), none).count() == len(DOCS)
    assert D.without_contaminated(documents(DOCS).limit(0), items_of(spark, ITEMS)).count() == 0


@pytest.mark.parametrize(("pairs", "n"), [([], 0), ([(0, 3), (2, 5)], 5), ([(0, 9), (1, 2), (9, 10)], 10), ([(4, 6), (0, 1)], 3)])
def test_covered(pairs, n):
    import numpy as np

    assert D.covered(np.array(pairs, np.int64).tobytes()) == n
