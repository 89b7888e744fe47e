import random

import pytest

from voxloom.config import MERGE
from voxloom.operators import resume, split, transcripts, transfer, verify


def entries(spark, n, per=2):
    rows = [(f"r{i}_{j:04d}", "speech", 3, 100, f"features/r{i}_{j:04d}.pt") for i in range(n) for j in range(per)]
    return spark.createDataFrame(rows, "segment_id string, dataset string, num_tokens bigint, duration_frames bigint, feature_path string")


@pytest.mark.parametrize(("n", "train"), [(1, 0), (20, 19), (100, 95)])
@pytest.mark.parametrize("how", [split.by_hash, split.by_shuffle])
def test_split_sizes_and_disjointness(spark, n, train, how):
    rows = entries(spark, n)
    found = how(split.with_recordings(rows), MERGE)
    by = {r["recording_id"]: (r["pos"], r["split"]) for r in found.collect()}
    assert sorted(p for p, _ in by.values()) == list(range(n))
    assert sum(s == "train" for _, s in by.values()) == train
    assigned = split.assigned(rows, found)
    assert assigned.count() == 2 * n
    assert split.shared_recordings(assigned.where("split = 'train'"), assigned.where("split = 'val'")).count() == 0


def test_exact_split_follows_the_seeded_shuffle(spark):
    ids = sorted(f"r{i}" for i in range(30))
    random.Random(42).shuffle(ids)
    found = split.by_shuffle(split.with_recordings(entries(spark, 30)), MERGE).orderBy("pos")
    assert [r["recording_id"] for r in found.collect()] == ids


def test_empty_manifest(spark):
    rows = entries(spark, 1).limit(0)
    assigned = split.assigned(rows, split.by_hash(split.with_recordings(rows), MERGE))
    assert assigned.count() == 0
    features = spark.createDataFrame([], "segment_id string, token_ids array<bigint>, encoder_features array<array<float>>, positions array<bigint>, f_before array<bigint>, f_after array<bigint>")
    checks = verify.results(verify.checked(assigned, features, MERGE), assigned)
    assert [(r["check"], r["passed"]) for r in checks.collect()] == [("disjoint", True)]
    assert verify.overall(checks).first()["passed"] is True
    assert verify.overall(checks.limit(0)).first()["passed"] is True


def test_failed_checks(spark):
    settings = MERGE.with_(feature_width=2)
    rows = spark.createDataFrame([("train", "a_1"), ("train", "b_1"), ("val", "c_1"), ("val", "d_1")], "split string, segment_id string")
    one = [1], [[0.0, 0.0]], [0], [0], [0]
    features = spark.createDataFrame(
        [("a_1", *one), ("b_1", *one), ("c_1", [1], [[0.0]], [0], None, [0])],
        "segment_id string, token_ids array<bigint>, encoder_features array<array<float>>, positions array<bigint>, f_before array<bigint>, f_after array<bigint>",
    )
    got = {r["segment_id"]: (r["found"], r["missing"], r["shaped"], r["passed"]) for r in verify.checked(rows, features, settings).collect()}
    assert got["a_1"] == (True, [], True, True)
    assert got["c_1"] == (True, ["f_before"], False, False)
    assert got["d_1"][0] is False and got["d_1"][3] is False
    assigned = rows.selectExpr("split", "segment_id", "10L duration_frames")
    checks = verify.results(verify.checked(rows, features, settings), assigned)
    assert {r["check"]: r["passed"] for r in checks.collect()} == {"train_keys": True, "val_keys": False, "disjoint": True}
    with pytest.raises(verify.VerificationError):
        verify.require(checks)


def test_sample_is_bounded_and_repeats(spark):
    rows = split.assigned(entries(spark, 100), split.by_hash(split.with_recordings(entries(spark, 100)), MERGE))
    one, two = (sorted(verify.sample(rows, MERGE).select("split", "segment_id").collect()) for _ in range(2))
    assert one == two and len(one) == 10


def test_download_plan(spark):
    remote = spark.createDataFrame([("p/a_1.mp3", 5), ("p/b.mp3", 6), ("p/c_2.mp3", 7)], "key string, size bigint")
    local = spark.createDataFrame([("a_1.mp3", 5), ("b.mp3", 60)], "name string, size bigint")
    assert {(r["name"], r["recording_id"]) for r in transfer.download_plan(remote, local).collect()} == {("b.mp3", "b.mp3"), ("c_2.mp3", "c")}
    assert tuple(transfer.download_summary(remote, local).first())[2:] == (2, 1)


def test_upload_plan(spark):
    manifest = spark.createDataFrame([("features/a.pt",), ("features/b.pt",), ("features/gone.pt",)], "feature_path string")
    existing = spark.createDataFrame([("features/a.pt", 3), ("features/b.pt", 4), ("features/c.pt", 5)], "local string, size bigint")
    files = spark.createDataFrame([("manifest.json", 9), ("notes.txt", 1)], "local string, local_size bigint")
    remote = spark.createDataFrame([("processed/features/a.pt", 3), ("processed/features/b.pt", 5)], "key string, size bigint")
    plan = transfer.upload_plan(transfer.upload_candidates(files, manifest, existing, MERGE), remote)
    assert {tuple(r) for r in plan.collect()} == {
        ("manifest.json", "processed/manifest.json", 9),
        ("features/b.pt", "processed/features/b.pt", 4),
    }


def test_transfers_are_tried_three_times(spark):
    def copy(row):
        if row["key"] == "bad":
            raise OSError("no")
        return "skip" if row["key"] == "old" else None

    plan = spark.createDataFrame([("bad",), ("old",), ("new",)], "key string")
    out = transfer.execute(plan, copy, MERGE, pause=lambda s: None)
    assert {(r["key"], r["status"], r["attempts"], r["error"]) for r in out.collect()} == {("bad", "error", 3, "no"), ("old", "skip", 1, None), ("new", "ok", 1, None)}
    assert tuple(transfer.outcome_counts(out).first()) == (1, 1, 1)


def test_resume(spark):
    files = spark.createDataFrame([("a_1.mp3",), ("a_2.mp3",), ("b.mp3",)], "name string")
    done = spark.createDataFrame([("a", 3), (None, 1)], "recording_id string, n_segments bigint")
    assert [r["name"] for r in resume.to_process(files, done).collect()] == ["b.mp3"]
    assert [tuple(r) for r in resume.collisions(files).collect()] == [("a", 2)]
    assert tuple(resume.done_totals(done).first()) == (2, 4)
    features = spark.createDataFrame([("a_0001",), ("ab_0001",), ("a_b_0001",)], "segment_id string")
    todo = spark.createDataFrame([("a",)], "recording_id string")
    assert [r["segment_id"] for r in resume.stale_segments(features, todo).collect()] == ["a_0001"]


def test_a_missing_text_takes_no_other(spark):
    segments = spark.createDataFrame([("r", 0), ("r", 1), ("r", 2)], "recording_id string, idx bigint")
    texts = spark.createDataFrame([("r", 0, " \t"), ("r", 2, " c ")], "recording_id string, idx bigint, raw_text string")
    assert [(r["idx"], r["text"]) for r in transcripts.attached(segments, texts, ["recording_id", "idx"]).collect()] == [(2, "c")]
