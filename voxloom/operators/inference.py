"""Voice activity, transcription and encoding by pluggable models.

A backend is loaded once for each worker, before its first row, and stays for
the tasks that follow. A batch that fails is tried again one by one; what still
fails has an error or is left out, as the operator says, and a column tells which
way a result came. Waveforms are read as views of Arrow's buffers, in batches
bounded in bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame

from voxloom import schemas
from voxloom.config import Settings
from voxloom.shipping import ship


class VoiceActivity(Protocol):
    def intervals(self, samples, sample_rate: int) -> list[tuple[float, float]]: ...


class Transcriber(Protocol):
    def texts(self, waveforms: list, sample_rate: int) -> list: ...


class FeatureEncoder(Protocol):
    """Each result has positions, encoder_features and, unless texts come as token ids, token_ids.

    A result with `length` is trimmed to so many tokens, else it is taken as it is.
    """

    def encode(self, waveforms: list, texts: list, sample_rate: int) -> list[dict]: ...


#: The way that a result came: with its batch, alone after the batch failed, or not at all.
BATCH, ALONE, FAILED = "batch", "alone", "failed"

_LOADED: dict[str, object] = {}


def loaded(key: str, load: Callable[[], object]):
    """What load gives, once for each worker and key."""
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]


def batch_or_each(run: Callable[[list], list], items: list, missing) -> tuple[list, list[str]]:
    """run(items), or item by item where that fails, and the way of each; an item that fails alone is `missing`."""
    try:
        out = list(run(items))
        if len(out) == len(items):
            return out, [BATCH] * len(items)
    except Exception:  # tried again below
        pass
    out, ways = [], []
    for item in items:
        try:
            out.append(list(run([item]))[0])
            ways.append(ALONE)
        except Exception:
            out.append(missing)
            ways.append(FAILED)
    return out, ways


def waveforms_of(column) -> list:
    """Each list of an Arrow column as a view of its numbers; null as empty."""
    import numpy as np
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    ends = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


#: Bytes of a batch of waveforms; a longer one is a batch of its own.
BATCH_BYTES = 64 << 20


def _map(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow with batches of BATCH_BYTES, unless the session bounds them itself."""
    ship(df.sparkSession)
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def _text(x) -> str:
    """The text of a result, which may be wrapped in a tuple or an object."""
    while isinstance(x, (tuple, list)):
        x = x[0] if x else ""
    x = getattr(x, "text", x)
    return x.strip() if isinstance(x, str) else ""


def voice_activity(waveforms: DataFrame, load: Callable[[], VoiceActivity]) -> DataFrame:
    """recording_id, seq, s, e of each waveform that could be decoded; a model's error fails the task."""

    key = uuid.uuid4().hex

    def run(batches):
        import pyarrow as pa

        model = loaded(key, load)
        for batch in batches:
            rows = []
            for name, x, rate in zip(batch.column(0).to_pylist(), waveforms_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                rows += [{"recording_id": name, "seq": i, "s": float(s), "e": float(e)} for i, (s, e) in enumerate(model.intervals(x, rate))]
            kinds = pa.schema([("recording_id", pa.string()), ("seq", pa.int64()), ("s", pa.float64()), ("e", pa.float64())])
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return _map(waveforms.where("error is null").select("recording_id", "samples", "sample_rate"), run, schemas.INTERVAL)


def transcribed(slices: DataFrame, load: Callable[[], Transcriber], settings: Settings) -> DataFrame:
    """slices with `text` and `text_way`, in batches; texts stay with their segments, a failure or a missing one is empty and goes."""
    size, rate, to, key = settings.batch_size, settings.sample_rate, settings.asr_sample_rate, uuid.uuid4().hex

    def run(batches):
        import pyarrow as pa

        from voxloom.functions.audio import resampled

        model = loaded(key, load)
        for batch in batches:
            waves = waveforms_of(batch.column(batch.schema.get_field_index("samples")))
            texts: list[str] = []
            ways: list[str] = []
            for i in range(0, len(waves), size):
                found, own = batch_or_each(lambda w: model.texts(w, to), [resampled(x, rate, to) for x in waves[i : i + size]], "")
                texts += map(_text, found)
                ways += own
            keep = [i for i, t in enumerate(texts) if t]
            out = batch.take(pa.array(keep, pa.int64()))
            more = [pa.array([x[i] for i in keep], pa.string()) for x in (texts, ways)]
            yield pa.RecordBatch.from_arrays([*out.columns, *more], [*out.schema.names, "text", "text_way"])

    return _map(slices, run, f"{_ddl(slices)}, text string, text_way string")


def encoded(
    segments: DataFrame,
    load: Callable[[], FeatureEncoder],
    settings: Settings,
    normalise: Callable[[str], str] | None = None,
    tokeniser: Callable[[], Callable[[str], list[int]]] | None = None,
) -> DataFrame:
    """segment_id, recording_id, token_ids, encoder_features, positions, duration_frames, way; items that fail are left out.

    Batches hold up to batch_size segments; duration_frames is what the slice's
    samples give. normalise rewrites each text first; what tokeniser loads, once
    for each worker, turns it into the token ids that the encoder gets in place
    of texts.
    """
    from pyspark.sql import functions as F

    from voxloom.functions.durations import total_frames

    size, rate, key = settings.batch_size, settings.sample_rate, uuid.uuid4().hex
    frames = total_frames(F.size("samples"), rate, settings.frame_rate).alias("duration_frames")
    rows = segments.select("segment_id", "recording_id", "samples", "text", frames)

    def run(batches):
        import pyarrow as pa

        model = loaded(key, load)
        tokens = loaded(f"{key}-tokens", tokeniser) if tokeniser else None
        kinds = pa.schema(
            [
                ("segment_id", pa.string()),
                ("recording_id", pa.string()),
                ("token_ids", pa.list_(pa.int64())),
                ("encoder_features", pa.list_(pa.list_(pa.float32()))),
                ("positions", pa.list_(pa.int64())),
                ("duration_frames", pa.int64()),
                ("way", pa.string()),
            ]
        )

        def encode(items: list) -> list[dict]:
            texts = [normalise(t) if normalise else t for _, t in items]
            ids = [list(tokens(t)) for t in texts] if tokens else None
            found = list(model.encode([w for w, _ in items], ids or texts, rate))
            return [trimmed({"token_ids": ids[i]} | f if ids else f) for i, f in enumerate(found)]

        for batch in batches:
            names, recordings, _, texts, lengths = (c.to_pylist() if i != 2 else None for i, c in enumerate(batch.columns))
            waves = waveforms_of(batch.column(2))
            for i in range(0, len(names), size):
                found, ways = batch_or_each(encode, list(zip(waves[i : i + size], texts[i : i + size], strict=True)), None)
                out = [
                    {"segment_id": names[i + k], "recording_id": recordings[i + k], "duration_frames": lengths[i + k], "way": ways[k]} | f
                    for k, f in enumerate(found)
                    if f is not None
                ]
                yield pa.RecordBatch.from_pylist(out, kinds)

    return _map(
        rows,
        run,
        "segment_id string, recording_id string, token_ids array<bigint>, encoder_features array<array<float>>, positions array<bigint>, duration_frames bigint, way string",
    )


def trimmed(result: dict) -> dict:
    """A result's three lists, cut to its length if it tells one."""
    n = result.get("length")
    return {k: result[k] if n is None else result[k][:n] for k in ("token_ids", "encoder_features", "positions")}


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


class EnergyVoiceActivity:
    """A deterministic stand-in: stretches of windows whose mean level is above a threshold."""

    def __init__(self, level: float = 0.01, window: float = 0.1):
        self.level, self.window = level, window

    def intervals(self, samples, sample_rate: int) -> list[tuple[float, float]]:
        import numpy as np

        n = max(1, int(self.window * sample_rate))
        loud = [bool(np.abs(samples[i : i + n]).mean() > self.level) for i in range(0, len(samples), n)]
        out: list[tuple[float, float]] = []
        for i, on in enumerate(loud):
            if on:
                end = min((i + 1) * n, len(samples)) / sample_rate
                out.append((out.pop()[0], end) if out and i and loud[i - 1] else (i * n / sample_rate, end))
        return out


class CountingTranscriber:
    """A deterministic stand-in: a word for each half second."""

    def texts(self, waveforms: list, sample_rate: int) -> list[str]:
        return [" ".join(f"w{i}" for i in range(int(2 * len(w) / sample_rate))) for w in waveforms]


class EvenEncoder:
    """A deterministic stand-in: a token for each word, evenly placed, with constant features."""

    def __init__(self, width: int = 512, frame_rate: int = 50):
        self.width, self.frame_rate = width, frame_rate

    def encode(self, waveforms: list, texts: list[str], sample_rate: int) -> list[dict]:
        out = []
        for w, text in zip(waveforms, texts, strict=True):
            ids = [len(t) for t in text.split()] if isinstance(text, str) else text
            n = len(ids)
            frames = int(len(w) / sample_rate * self.frame_rate)
            out.append(
                {
                    "token_ids": ids,
                    "positions": [i * frames // max(n, 1) for i in range(n)],
                    "encoder_features": [[float(i)] * self.width for i in range(n)],
                }
            )
        return out
