import json
import wave

import numpy as np
import pytest

from voxloom.config import MERGE, PACK
from voxloom.functions.audio import decode_wav, decoder_for, mono, resampled
from voxloom.operators import inference
from voxloom.plans import pipeline
from voxloom.sinks import tables as sinks
from voxloom.sources import files, settings, tables
from voxloom.streaming import intervals as streaming

RATE = 2400
SETTINGS = MERGE.with_(sample_rate=RATE, asr_sample_rate=RATE, feature_width=4, batch_size=2)


def write_wav(path, pattern, channels=1, rate=RATE):
    """pattern: (seconds, loud) pairs."""
    x = np.concatenate([np.full(int(s * rate), 8000 if loud else 0, "<i2") for s, loud in pattern])
    with wave.open(str(path), "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.repeat(x, channels).tobytes())


def backends(encoder=lambda: inference.EvenEncoder(4)):
    return pipeline.Backends(decode_wav, inference.EnergyVoiceActivity, inference.CountingTranscriber, encoder)


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_wav(folder / "one_a.wav", [(1, 0), (4, 1), (2, 0), (40, 1), (1, 0)])
    write_wav(folder / "two_a.wav", [(6, 1)], channels=2)
    (folder / "bad_a.wav").write_bytes(b"nonsense")
    (folder / "notes.txt").write_text("x")
    return str(folder)


def test_run_and_resume(spark, raw, tmp_path):
    root = str(tmp_path / "out")
    report = pipeline.run(spark, raw, root, SETTINGS, backends(), "*.wav")
    features = {r["segment_id"] for r in tables.features(spark, f"{root}/features").collect()}
    assert {"one_0000", "two_0000"} <= features
    done = {r["recording_id"]: (r["n_segments"], r["status"]) for r in tables.done_table(spark, f"{root}/done").collect()}
    assert set(done) == {"one", "two", "bad"} and done["bad"][0] == 0 and done["bad"][1] != "ok"
    assert sum(n for n, _ in done.values()) == len(features)
    assert sum(r["n"] for r in report.rejections.collect()) == len(features)
    assert pipeline.new_segments(spark, root, 0) == len(features)
    assert {r["check"]: r["passed"] for r in report.checks.collect()}["disjoint"] is True
    assert pipeline.process(spark, raw, root, SETTINGS, backends(), "*.wav") == 0
    write_wav(f"{raw}/three_a.wav", [(3, 1)])
    assert pipeline.process(spark, raw, root, SETTINGS, backends(), "*.wav") == 1
    assert {r["segment_id"] for r in tables.features(spark, f"{root}/features").collect()} == features | {"three_0000"}


LEFT = "segment_id string, recording_id string, token_ids array<bigint>, encoder_features array<array<float>>, positions array<bigint>, f_before array<bigint>, f_after array<bigint>, duration_frames bigint"


def test_a_broken_run_is_done_again_without_leftovers(spark, raw, tmp_path):
    """Leftovers of recordings that yield segments now, of one that yields none, and of one whose file is gone."""
    root = str(tmp_path / "out")
    write_wav(f"{raw}/quiet_a.wav", [(3, 0)])
    left = [(f"{r}_9999", r, [1], [[0.0] * 4], [1], [1], [1], 100) for r in ("two", "quiet", "bad", "old")]
    sinks.write_features(spark.createDataFrame(left, LEFT), f"{root}/features", "broken")
    pipeline.process(spark, raw, root, SETTINGS, backends(), "*.wav")
    assert not (tmp_path / "out" / "features" / "run=broken").exists()
    sinks.write_features(spark.createDataFrame(left, LEFT), f"{root}/features", "later")
    report = pipeline.finish(spark, root, SETTINGS)
    ids = {r["segment_id"] for r in spark.read.parquet(f"{root}/manifest").collect()}
    assert "two_0000" in ids and not any(i.endswith("9999") for i in ids)
    done = {r["recording_id"]: r["n_segments"] for r in tables.done_table(spark, f"{root}/done").collect()}
    assert done["quiet"] == done["bad"] == 0 and set(done) == {"one", "two", "bad", "quiet"}
    assert sum(r["n"] for r in report.rejections.collect()) == sum(done.values())


def test_unreadable_features_are_in_the_statistics(spark, raw, tmp_path):
    root = str(tmp_path / "out")
    pipeline.process(spark, raw, root, SETTINGS, backends(), "*.wav")
    (folder,) = (tmp_path / "out" / "features").glob("run=*")
    (folder / "broken.parquet").write_bytes(b"PAR1nonsense")
    report = pipeline.finish(spark, root, SETTINGS)
    assert {r["reason"]: r["n"] for r in report.rejections.collect()}["load_error"] == 1


def test_the_first_of_several_files_of_a_recording_counts(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_wav(folder / "one_b.wav", [(3, 1)])
    write_wav(folder / "one_a.wav", [(9, 1)])
    root = str(tmp_path / "out")
    assert pipeline.process(spark, str(folder), root, SETTINGS, backends(), "*.wav") == 1
    assert [r["duration_frames"] for r in tables.features(spark, f"{root}/features").collect()] == [450]


def test_a_run_with_a_store(spark, raw, tmp_path):
    """Recordings come from the store, manifests and the feature files they name go back, and a second run copies nothing."""
    import shutil
    from pathlib import Path

    away, here, root = tmp_path / "store", tmp_path / "here", str(tmp_path / "out")
    (away / "audio").mkdir(parents=True)
    here.mkdir()
    for f in Path(raw).glob("*.wav"):
        shutil.copy(f, away / "audio" / f.name)

    def listing(session, prefix):
        rows = [(str(f.relative_to(away)), f.stat().st_size) for f in (away / prefix).rglob("*") if f.is_file()]
        return session.createDataFrame(rows, "key string, size long")

    def fetch(row, away=str(away), here=str(here)):
        shutil.copy(f"{away}/{row['key']}", f"{here}/{row['name']}")

    def put(row, away=str(away), root=root):
        Path(f"{away}/{row['key']}").parent.mkdir(parents=True, exist_ok=True)
        shutil.copy(f"{root}/{row['local']}", f"{away}/{row['key']}")

    store = pipeline.Store(listing, fetch, put)
    pipeline.run(spark, str(here), root, SETTINGS, backends(), "*.wav", store=store, prefix="audio")
    names = {r["feature_path"] for r in spark.read.parquet(f"{root}/manifest").collect()}
    assert names and all(Path(f"{root}/{n}").is_file() for n in names)
    sent = {str(f.relative_to(away / SETTINGS.output_prefix)) for f in (away / SETTINGS.output_prefix).rglob("*") if f.is_file()}
    assert {"manifest.json", "manifest_train.json", "manifest_val.json"} < sent
    assert {f"features/{n.rpartition('/')[2]}" for n in names} == {n for n in sent if n.startswith("features/")}
    assert tuple(pipeline.download(spark, store, "audio", str(here), root, SETTINGS).first()) == (0, 0, 0)
    assert tuple(pipeline.upload(spark, store, root, SETTINGS).first()) == (0, 0, 0)


def test_no_decoder_is_told_at_the_start(spark, raw, tmp_path):
    with pytest.raises(RuntimeError, match="no decoder"):
        pipeline.process(spark, raw, str(tmp_path / "out"), SETTINGS, pipeline.Backends(None, *[None] * 3), "*.mp3")
    assert decoder_for("*.wav") is decode_wav


def test_no_recordings(spark, tmp_path):
    assert files.recordings(spark, str(tmp_path / "nowhere")).count() == 0
    assert files.listing(spark, str(tmp_path / "nowhere")).count() == 0
    assert pipeline.process(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"), SETTINGS, backends()) == 0


class Fragile:
    """Fails on batches that hold b, and on b alone."""

    def encode(self, waveforms, texts, sample_rate):
        if "b" in texts:
            raise RuntimeError("no")
        return inference.EvenEncoder(4).encode(waveforms, texts, sample_rate)


def test_failed_batches_are_tried_one_by_one(spark):
    rows = spark.createDataFrame([(f"r_{t}", "r", [0.1] * RATE, t) for t in "abcd"], "segment_id string, recording_id string, samples array<float>, text string")
    out = inference.encoded(rows.coalesce(1), Fragile, SETTINGS).collect()
    assert sorted((r["segment_id"], r["way"]) for r in out) == [("r_a", "alone"), ("r_c", "batch"), ("r_d", "batch")]
    assert {r["duration_frames"] for r in out} == {50}


def test_text_steps_before_the_encoder(spark):
    """Texts are normalised, then become ids by a tokeniser that is loaded once; the encoder gets ids in place of texts."""
    rows = spark.createDataFrame([(f"r_{i}", "r", [0.1] * RATE, "A  bc") for i in range(3)], "segment_id string, recording_id string, samples array<float>, text string")

    def tokeniser():
        return lambda t: [ord(c) for c in t]

    out = inference.encoded(rows.coalesce(1), lambda: inference.EvenEncoder(4), SETTINGS, lambda t: " ".join(t.lower().split()), tokeniser).collect()
    assert [r["token_ids"] for r in out] == [[97, 32, 98, 99]] * 3
    assert inference.trimmed({"token_ids": [1, 2, 3], "positions": [0, 1, 2], "encoder_features": [[1], [2], [3]], "length": 2}) == {
        "token_ids": [1, 2],
        "positions": [0, 1],
        "encoder_features": [[1], [2]],
    }


def test_a_model_is_loaded_once_for_each_worker(spark, tmp_path):
    """Eight tasks, and no more loads than workers."""
    folder = str(tmp_path / "loads")
    (tmp_path / "loads").mkdir()

    def load():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return inference.CountingTranscriber()

    rows = spark.createDataFrame([(i, [0.1] * RATE) for i in range(64)], "segment_id int, samples array<float>").repartition(16)
    assert inference.transcribed(rows, load, SETTINGS).count() == 64
    loads = [f.name.partition("-")[0] for f in (tmp_path / "loads").iterdir()]
    assert len(loads) == len(set(loads)) < 16


def test_waveforms_are_views():
    import pyarrow as pa

    column = pa.array([[1.0, 2.0], None, [], [3.0]], pa.list_(pa.float32()))
    assert [x.tolist() for x in inference.waveforms_of(column)] == [[1.0, 2.0], [], [], [3.0]]
    assert [x.tolist() for x in inference.waveforms_of(column.slice(2))] == [[], [3.0]]


class Odd:
    def texts(self, waveforms, sample_rate):
        class Wrapped:
            text = " hi "

        return [(Wrapped(),), None, 7][: len(waveforms)] if len(waveforms) > 1 else [("x",)]


def test_results_are_unwrapped_and_empty_ones_go(spark):
    rows = spark.createDataFrame([(i, [0.1]) for i in range(3)], "segment_id int, samples array<float>").coalesce(1)
    out = inference.transcribed(rows, Odd, SETTINGS.with_(batch_size=64)).collect()
    assert [(r["segment_id"], r["text"]) for r in out] == [(0, "hi")]


def test_audio():
    assert mono(np.array([[0.0, 2.0], [2.0, 4.0]])).tolist() == [1.0, 3.0]
    assert len(resampled(np.zeros(2400, np.float32), 2400, 1600)) == 1600
    assert np.allclose(resampled(np.full(500, 0.5, np.float32), 44100, 16000), 0.5, atol=1e-6)


@pytest.mark.parametrize(("rate", "to"), [(24000, 16000), (44100, 24000), (16000, 24000), (8000, 16000)])
def test_resampling_keeps_low_tones_and_drops_what_would_alias(rate, to):
    low = np.sin(2 * np.pi * 1000 * np.arange(rate) / rate)
    want = np.sin(2 * np.pi * 1000 * np.arange(to) / to)
    assert np.abs(resampled(low, rate, to) - want)[200:-200].max() < 0.01
    if to < rate:
        high = np.sin(2 * np.pi * (to / 2 + 1800) * np.arange(rate) / rate)
        assert np.abs(resampled(high, rate, to))[200:-200].max() < 0.02


def test_markers_manifests_and_settings(spark, tmp_path):
    folder = tmp_path / "done"
    folder.mkdir()
    (folder / "a.done").write_text('{"n_segments": 3}')
    (folder / "b.done").write_text('{"n_seg')
    (folder / "c.done").write_text('{"n_segments": 0}')
    assert sorted(map(tuple, tables.done_markers(spark, str(folder)).collect())) == [("a", 3), ("c", 0)]
    rows = spark.createDataFrame([("b_1", "speech", 2, 60, "features/b_1.pt"), ("a_1", "speech", 1, 50, "x")], "segment_id string, dataset string, num_tokens bigint, duration_frames bigint, feature_path string")
    assert sinks.export_json(rows, tmp_path / "manifest.json") == 2
    assert [r["segment_id"] for r in json.loads((tmp_path / "manifest.json").read_text())] == ["a_1", "b_1"]
    assert sorted(tables.manifest(spark, str(tmp_path / "manifest.json")).collect()) == sorted(rows.collect())
    assert sinks.export_json(rows.limit(0), tmp_path / "none.json") == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    (tmp_path / ".env").write_text("# x\nA = 1\nB=\n=c\nnothing\nC=x=y\n")
    env = {"A": "0"}
    settings.read_env(tmp_path / ".env", env)
    assert env == {"A": "0", "C": "x=y"}


def test_unreadable_feature_files_are_told(spark, tmp_path):
    root = str(tmp_path / "features")
    one = spark.createDataFrame([("a_1", "a", [1], [[0.0]], [1], [1], [1], 100), ("_p", "a", [1], [[0.0]], [1], [1], [1], 100)], "segment_id string, recording_id string, token_ids array<bigint>, encoder_features array<array<float>>, positions array<bigint>, f_before array<bigint>, f_after array<bigint>, duration_frames bigint")
    sinks.write_features(one, root, "r1")
    (tmp_path / "features" / "run=r1" / "broken.parquet").write_bytes(b"PAR1nonsense")
    assert [r["segment_id"] for r in tables.features(spark, root).collect()] == ["a_1"]
    assert [r["name"] for r in tables.unreadable_files(spark, root).collect()] == ["broken.parquet"]


def test_stream_of_interval_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    kinds = "recording_id string, seq bigint, s double, e double"
    spark.createDataFrame([("a", 0, 0.0, 8.0), ("a", 1, 9.0, 18.0)], kinds).coalesce(1).write.mode("append").parquet(folder)
    out, at = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    streaming.run_available(streaming.incoming(spark, folder), out, at, PACK)
    assert [(r["s"], r["e"]) for r in spark.read.parquet(out).collect()] == [(0.0, 18.0)]
    spark.createDataFrame([("b", 0, 0.0, 6.0), ("a", 2, 18.5, 19.0), ("a", 3, 40.0, 46.0)], kinds).coalesce(1).write.mode("append").parquet(folder)
    streaming.run_available(streaming.incoming(spark, folder), out, at, PACK)
    found = sorted((r["recording_id"], r["s"], r["e"]) for r in spark.read.parquet(out).collect())
    assert found == [("a", 0.0, 19.0), ("a", 40.0, 46.0), ("b", 0.0, 6.0)]
