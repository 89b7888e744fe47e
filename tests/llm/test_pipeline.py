import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from voxloom.llm import quality, sharding
from voxloom.llm.common import table

from . import test_decontamination, test_mixing, test_ngram_join, test_quality
from .conftest import text

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        out.append((docs, docs := spark.read.parquet(f"{folder}/{name}")))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(stages):
    assert [n for n, _ in P.STAGES] == ["accept_quality", "one_of_near_copies", "decontaminate", "mix_sources", "shard"]
    assert all(out.columns == COLUMNS for _, out in stages[:-1])
    assert stages[-1][1].columns[:5] == COLUMNS


def test_quality_stage_against_a_naive_network(spark, stages):
    before, after = stages[0]
    net = quality.fit(before, table(spark, SF, "labels"))
    kept = [r for r in rows(before) if test_quality.naive_score(net, (r[1] or "").encode()) >= 0.3]
    assert sorted(rows(after), key=repr) == sorted(kept, key=repr) and 0 < len(kept) < before.count()


def test_near_copies_stage_against_brute_force(stages):
    before, after = map(rows, stages[1])
    assert sorted(after, key=repr) == test_ngram_join.brute_kept(before) and len(after) < len(before)


def test_decontamination_stage_against_brute_force(spark, stages):
    before, after = map(rows, stages[2])
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    windows = {tuple(w[i : i + 13]) for _, t in items for w in [test_decontamination.words(t)] for i in range(max(0, len(w) - 12))}
    assert windows and all(len(test_decontamination.words(t)) >= 13 for _, t in items)

    def hit(t):
        w = test_decontamination.words(t)
        return any(tuple(w[i : i + 13]) in windows for i in range(len(w) - 12))

    assert sorted(after, key=repr) == sorted((r for r in before if not hit(r[1])), key=repr) and len(after) < len(before)


def test_mixing_stage_against_water_filling(stages):
    before, after = stages[3]
    sizes, most = Counter(), Counter()
    for r in before.select("source", "text").collect():
        n = len((r["text"] or "").split())
        sizes[r["source"]] += n
        most[r["source"]] = max(most[r["source"]], n)
    taken = Counter()
    for r in after.select("source", "text").collect():
        taken[r["source"]] += len((r["text"] or "").split())
    want = test_mixing.water(sizes)
    assert all(abs(taken[s] - want[s]) <= most[s] for s in sizes)
    assert max(Counter(i for i, _ in rows(after)).values()) <= 2 and set(rows(after)) <= set(rows(before))


def test_sharding_stage_against_plain_sums(stages):
    before, after = stages[4]
    assert sorted(rows(before), key=repr) == sorted(rows(after), key=repr)
    sizes, slots = Counter(), defaultdict(set)
    for r in after.select("doc_id", "text", "shard", "virtual_slot").collect():
        sizes[r["shard"]] += len((r["text"] or "").encode()) + 1
        slots[r["virtual_slot"]].add(r["shard"])
    assert set(sizes) == set(range(16)) and all(len(s) == 1 for s in slots.values())
    heaviest = max(after.groupBy("virtual_slot").agg(F.sum(sharding.record_size(F.col("text"))).alias("b")).select("b").collect())[0]
    assert max(sizes.values()) - min(sizes.values()) <= heaviest


def test_run_gives_the_last_stage(spark, stages):
    one, two = (sorted(map(tuple, df.select("doc_id", "shard").collect())) for df in (P.run(spark, SF), stages[-1][1]))
    assert one == two


def test_odd_documents_go_through_all_stages(spark, documents, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, an empty table, clashing columns."""
    rng = random.Random(4)
    odd = [(None, None, None), (None, None, None), (1, "", "a"), (2, None, "a"), (3, text(3, 60), None), (3, text(3, 60), None), (None, text(3, 60), "b")]
    odd += [(4, text(4, 40_000), "a"), (5, " .,! ", "b")] + [(100 + i, text(i, rng.randrange(20, 90)), rng.choice("ab")) for i in range(60)]
    passage = " ".join(r["text"] for r in table(spark, SF, "benchmark").limit(1).collect())
    odd += [(300, f"{text(900, 3000)} {passage} {text(901, 3000)}", "a")]
    for k, docs in enumerate((documents(odd, clashing=True), documents(odd, clashing=True).limit(0))):
        names, before = docs.columns, docs.count()
        for name, stage in P.STAGES:
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
            if name != "shard":
                assert docs.columns == names
            if name == "decontaminate":
                assert docs.where("doc_id = 300").count() == 0
                assert docs.count() <= before
        assert set(names) <= set(docs.columns) and (docs.count() > 0) == (k == 0)
