import pytest
from pyspark.sql import functions as F

from voxloom.config import MERGE, PACK
from voxloom.functions import arrays, durations, names, text
from voxloom.operators import batches, quality


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("got", "expected"),
    [
        (lambda: names.basename(F.lit("a/b/c_d.mp3")), "c_d.mp3"),
        (lambda: names.recording_of_file(F.lit("abc_x_y.mp3")), "abc"),
        (lambda: names.recording_of_file(F.lit("abc.mp3")), "abc.mp3"),
        (lambda: names.recording_of_segment(F.lit("a_b_0001")), "a_b"),
        (lambda: names.segment_id(F.lit("r"), F.lit(12345), 4), "r_12345"),
        (lambda: names.segment_id(F.lit("r"), F.lit(7), 6), "r_000007"),
        (lambda: names.stem(F.lit("a.b.done")), "a.b"),
        (lambda: names.stem(F.lit("dotless")), "dotless"),
        (lambda: names.stem(F.lit(".hidden")), ".hidden"),
        (lambda: names.is_feature_name(F.lit("_private")), False),
        (lambda: names.is_feature_name(F.lit("a.done")), False),
        (lambda: names.is_feature_name(F.lit("a_0001")), True),
        (lambda: text.stripped(F.lit("  \t a b  \n")), "a b"),
        (lambda: text.stripped(F.lit(None).cast("string")), ""),
        (lambda: durations.total_frames(F.lit(13920), 24000, 50), 28),
        (lambda: durations.sample_at(F.lit(28.99999), 1), 28),
        (lambda: durations.percentage(F.lit(1), F.lit(0)), 0.0),
        (lambda: durations.percentage(F.lit(1), F.lit(4)), 25.0),
        (lambda: durations.megabytes(F.lit(1048576)), 1.0),
        (lambda: durations.hours_of_frames(F.lit(180000), 50), 1.0),
        (lambda: durations.human(F.lit(3723.9)), "1h 2m 3s"),
        (lambda: durations.human(F.lit(123)), "2m 3s"),
        (lambda: durations.human(F.lit(3)), "3s"),
        (lambda: durations.remaining(F.lit(10.0), F.lit(0.25)), 30.0),
        (lambda: durations.remaining(F.lit(10.0), F.lit(0.0)), None),
    ],
)
def test_scalars(spark, got, expected):
    assert one(spark, got()) == expected


def longs(*xs):
    return F.array(*[F.lit(x).cast("bigint") for x in xs]) if xs else F.array().cast("array<bigint>")


@pytest.mark.parametrize(
    ("positions", "total", "before", "after"),
    [((), 9, [], []), ((4,), 9, [4], [4]), ((2, 2, 5), 9, [2, 0, 2], [0, 2, 3]), ((5, 3), 2, [5, 0], [0, 0])],
)
def test_gaps(spark, positions, total, before, after):
    assert one(spark, arrays.gaps_before(longs(*positions))) == before
    assert one(spark, arrays.gaps_after(longs(*positions), F.lit(total).cast("bigint"))) == after


@pytest.mark.parametrize(
    ("positions", "run"), [((), False), ((5,), False), ((5, 5, 5), False), ((5, 5, 5, 5), True), ((1, 5, 5, 5, 5, 9), True), ((5, 5, 5, 6, 6, 6), False)]
)
def test_runs(spark, positions, run):
    assert one(spark, arrays.has_run(longs(*positions), 3)) is run


def test_array_functions(spark):
    assert one(spark, arrays.steps(longs(1, 4, 2))) == [3, -2]
    assert one(spark, arrays.steps(longs(1))) == []
    assert one(spark, arrays.largest_step(longs(1))) is None
    assert one(spark, arrays.trimmed(longs(1, 2, 3), F.lit(2))) == [1, 2]
    assert one(spark, arrays.trimmed(longs(1, 2, 3), F.lit(None).cast("int"))) == [1, 2, 3]
    assert one(spark, arrays.padded(longs(1), F.lit(3), F.lit(9).cast("bigint"))) == [1, 9, 9]
    assert one(spark, arrays.channel_mean(F.array(longs(1, 3), longs(3, 5)))) == [2.0, 4.0]
    assert one(spark, arrays.channel_mean(F.array(longs(1, 3)))) == [1.0, 3.0]
    assert one(spark, arrays.snake(F.array(F.lit(0.0), F.lit(1.0)), F.lit(0.0))) == [0.0, 1.0]
    features = F.array(F.array_repeat(F.lit(0.0), 4), F.array_repeat(F.lit(0.0), 3))
    assert one(spark, arrays.has_shape(features, longs(1, 2), 4)) is False
    assert one(spark, arrays.has_shape(F.array(F.array_repeat(F.lit(0.0), 4)), longs(1), 4)) is True


def reason(spark, positions, frames, settings):
    rows = spark.createDataFrame([(positions, frames)], "positions array<bigint>, duration_frames bigint")
    return quality.judged(rows, settings).first()["reason"]


@pytest.mark.parametrize(
    ("positions", "frames", "settings", "expected"),
    [
        ([], 500, MERGE, "empty_tokens"),
        ([1], 49, MERGE, "too_short"),
        ([1], 50, MERGE, None),
        ([1], 249, PACK, "too_short"),
        ([1], 1500, MERGE, None),
        ([1], 1501, MERGE, "too_long"),
        ([5, 5, 5], 100, MERGE, None),
        ([5, 5, 5, 5], 100, MERGE, "consecutive_frames"),
        ([0, 150], 200, MERGE, None),
        ([0, 151], 200, MERGE, "large_gap"),
        ([5, 5, 5, 5, 400], 500, MERGE, "consecutive_frames"),
        (None, 100, MERGE, "load_error"),
    ],
)
def test_the_first_reason_counts(spark, positions, frames, settings, expected):
    assert reason(spark, positions, frames, settings) == expected


def test_reasons_add_up(spark):
    rows = spark.createDataFrame([([], 10), ([1], 100), ([2], 100), (None, None)], "positions array<bigint>, duration_frames bigint")
    got = {r["reason"]: (r["n"], r["pct"], r["total"]) for r in quality.rejection_counts(quality.judged(rows, MERGE)).collect()}
    assert got == {"kept": (2, 50.0, 4), "empty_tokens": (1, 25.0, 4), "load_error": (1, 25.0, 4)}


def test_batches(spark):
    rows = spark.createDataFrame([("a", f"a_{i:04d}", [1] * (i % 3)) for i in range(5)], "recording_id string, segment_id string, t array<bigint>")
    got = batches.padded_batches(rows, "t", F.lit(0).cast("bigint"), 2).orderBy("segment_id").collect()
    assert [(r["batch"], r["t"]) for r in got] == [(0, [0]), (0, [1]), (1, [1, 1]), (1, [0, 0]), (2, [1])]
