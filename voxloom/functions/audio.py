"""Waveforms in numpy, and a decoder for PCM WAV."""

from __future__ import annotations

import io
import wave

import numpy as np


def mono(channels: np.ndarray) -> np.ndarray:
    """The mean of (channels, samples); one row is taken as it is."""
    x = np.atleast_2d(channels)
    return x[0] if len(x) == 1 else x.mean(axis=0)


def resampled(x: np.ndarray, rate: int, to: int, zeros: int = 16) -> np.ndarray:
    """Band-limited: a windowed sinc of `zeros` zero crossings on each side, cut off at the lower of the two Nyquist rates.

    At either end the weights of the samples that exist are made to sum to 1.
    """
    if rate == to or not len(x):
        return x
    step = np.gcd(rate, to)
    up, down = to // step, rate // step
    scale = min(1.0, up / down)
    half = int(np.ceil(zeros / scale))
    t = np.arange(-half, half + 1)[None] - np.arange(up)[:, None] / up
    taps = np.sinc(scale * t) * np.cos(np.pi * np.clip(t / (half + 1), -1, 1) / 2) ** 2
    n = len(x) * to // rate
    out = np.empty(n, np.float32)
    data, there = (np.pad(v, (half, half + 1)) for v in (np.asarray(x, np.float64), np.ones(len(x))))
    data, there = (np.lib.stride_tricks.sliding_window_view(v, 2 * half + 1) for v in (data, there))
    for i in range(0, n, 1 << 14):
        place = np.arange(i, min(n, i + (1 << 14))) * down
        own, first = taps[place % up], place // up
        inner = first[0] >= half and first[-1] + half < len(x)
        total = own.sum(1) if inner else (own * there[first]).sum(1)
        out[i : i + len(place)] = np.einsum("ij,ij->i", own, data[first]) / total
    return out


def decoder_for(pattern: str):
    """A decoder for the files that a pattern names; raises at once where none is installed for them."""
    kind = pattern.rpartition(".")[2].lower()
    if kind == "wav":
        return decode_wav
    try:
        import soundfile
    except ImportError:
        raise RuntimeError(f"no decoder for {pattern}: install soundfile, or pass a function from bytes to (channels x samples, rate)") from None

    def decode(content: bytes) -> tuple[np.ndarray, int]:
        found, rate = soundfile.read(io.BytesIO(content), dtype="float32", always_2d=True)
        return found.T, rate

    return decode


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(channels x samples, rate) of 16-bit PCM."""
    with wave.open(io.BytesIO(content)) as f:
        if f.getsampwidth() != 2:
            raise ValueError("only 16-bit PCM")
        x = np.frombuffer(f.readframes(f.getnframes()), "<i2").astype(np.float32) / 32768
        return x.reshape(-1, f.getnchannels()).T, f.getframerate()
