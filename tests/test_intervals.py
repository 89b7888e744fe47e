"""Goldens, and plans against plain restatements of the rules on random intervals."""

import random

import pytest

from voxloom.config import MERGE, PACK
from voxloom.operators import intervals as I


def frame(spark, by_recording):
    rows = [(r, i, float(s), float(e)) for r, xs in by_recording.items() for i, (s, e) in enumerate(xs)]
    return spark.createDataFrame(rows, "recording_id string, seq bigint, s double, e double")


def listed(df, order="idx"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["recording_id"], r[order])):
        out.setdefault(r["recording_id"], []).append((r["s"], r["e"]))
    return out


def cut(s, e, target):
    n = max(1, round((e - s) / target))
    return [(s + i * ((e - s) / n), s + (i + 1) * ((e - s) / n)) for i in range(n)]


def merge_rule(xs):
    joined = []
    for s, e in xs:
        if joined and s - joined[-1][1] < 0.5:
            joined[-1] = (joined[-1][0], e)
        else:
            joined.append((s, e))
    out = []
    for s, e in joined:
        out += [p for p in ([(s, e)] if e - s <= 30 else cut(s, e, 25.0)) if p[1] - p[0] >= 1]
    return out


def pack_rule(xs):
    packs = []
    for s, e in xs:
        if packs and e - packs[-1][0] <= 20:
            packs[-1] = (packs[-1][0], e)
        else:
            packs.append((s, e))
    parts = [p for s, e in packs for p in ([(s, e)] if e - s <= 30 else cut(s, e, 15.0))]
    out = []
    for s, e in parts:
        if e - s >= 5:
            out.append((s, e))
        elif out and e - out[-1][0] <= 30:
            out[-1] = (out[-1][0], e)
    return out


def random_recordings(n, seed):
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        t, xs = 0.0, []
        for _ in range(rng.randint(1, 40)):
            t += rng.choice([0.1, 0.4, 0.5, 0.6, 3.0, 12.0]) * rng.choice([1, 1, rng.random()])
            d = rng.choice([0.3, 2.0, 5.0, 12.0, 26.0, 35.0, 62.5, 90.0]) * rng.choice([1, rng.random()])
            xs.append((round(t, 3), round(t + d, 3)))
            t = xs[-1][1]
        out[f"r{i:04d}"] = xs
    return out


@pytest.mark.parametrize(("settings", "rule"), [(MERGE, merge_rule), (PACK, pack_rule)])
def test_plan_equals_the_rule_on_random_recordings(spark, settings, rule):
    given = random_recordings(300, 17)
    got = listed(I.segments_of(frame(spark, given), settings))
    assert got == {r: out for r, xs in given.items() if (out := rule(xs))}


def test_a_gap_of_half_a_second_is_not_merged(spark):
    got = I.merge_gaps(frame(spark, {"a": [(0, 1), (1.5, 2), (2.25, 3)]}), 0.5)
    assert listed(got, "seq") == {"a": [(0, 1), (1.5, 3)]}


def test_a_merged_end_is_the_latest_not_the_largest(spark):
    got = I.merge_gaps(frame(spark, {"a": [(0, 10), (2, 4)]}), 0.5)
    assert listed(got, "seq") == {"a": [(0, 4)]}


@pytest.mark.parametrize(("dur", "parts"), [(35.0, [35.0]), (62.5, [31.25, 31.25]), (30.0, [30.0]), (0.9, [])])
def test_split_under_the_merge_policy(spark, dur, parts):
    got = listed(I.segments_of(frame(spark, {"a": [(0, dur)]}), MERGE)).get("a", [])
    assert [e - s for s, e in got] == parts


def test_a_pack_of_exactly_twenty_seconds(spark):
    got = I.pack_greedy(frame(spark, {"a": [(0, 8), (9, 20), (20.1, 21)]}), 20.0)
    assert listed(got, "seq") == {"a": [(0, 20), (20.1, 21)]}


def test_runts(spark):
    leading = [(0, 4), (30, 40)]
    reaching = [(0, 20), (21, 30)]
    late = [(0, 20), (27, 31)]
    got = listed(I.segments_of(frame(spark, {"leading": leading, "reaching": [(0, 20), (26, 30)], "late": late}), PACK))
    assert got == {"leading": [(30, 40)], "reaching": [(0, 30)], "late": [(0, 20)]}
    assert reaching


def test_truncation_can_drop_a_kept_interval(spark):
    rows = I.segments_of(frame(spark, {"a": [(0.004, 5.004)], "b": [(0, 6), (40, 46)]}), PACK)
    lengths = spark.createDataFrame([("a", 10**7), ("b", 24000 * 45)], "recording_id string, n_samples bigint")
    got = {(r["segment_id"], r["idx"], r["dur_s"]) for r in I.slice_offsets(rows, lengths, PACK).collect()}
    assert got == {("b_000000", 0, 6.0), ("b_000001", 1, 5.0)}


def test_slices(spark):
    offsets = spark.createDataFrame([("a_0000", "a", 2, 5)], "segment_id string, recording_id string, start_sample bigint, end_sample bigint")
    waves = spark.createDataFrame([("a", [0.0, 1.0, 2.0, 3.0, 4.0, 5.0])], "recording_id string, samples array<float>")
    assert I.sliced(offsets, waves).first()["samples"] == [2.0, 3.0, 4.0]


def test_empty_and_null_intervals(spark):
    rows = spark.createDataFrame([("a", 0, None, 1.0), (None, 0, 0.0, 2.0)], "recording_id string, seq bigint, s double, e double")
    for settings in (MERGE, PACK):
        assert I.segments_of(rows, settings).count() == 0
        assert I.segments_of(rows.limit(0), settings).count() == 0
