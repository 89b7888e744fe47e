"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of WIDTH bytes slide over the whole text in
steps of STEP and are max-pooled in overlapping chunks of two blocks. One fixed
feature stands beside them, the share of a chunk's bytes that repeat what is up
to LAGS before (see `echoes`). A small layer makes a logit of each chunk, and
the mean, largest and least logit of a document are combined into one
probability. Training reads whole texts of a bounded sample of labelled rows;
scoring reads every byte of every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, release, slices, text_bytes

#: Bound of the training sample: documents, half of them of each label if there are as many.
TRAIN_ROWS = 3000
#: Bytes of the sample and of a document in it; what is beyond isn't trained on.
TRAIN_BYTES, LONGEST = 64 << 20, 1 << 20
#: Chunks that training holds at a time.
GROUP_CHUNKS = 256
FOLDS = 5
THRESHOLD = 0.3
BLOCK, WIDTH, STEP = 128, 8, 4
EMBED, FILTERS, HIDDEN = 8, 24, 12
#: Zeros that end each text, so that no filter reaches from one text into another.
LAGS = 32
#: Bytes that the dilated filters compare at once.
ECHO = 4
STEPS, BATCH, RATE = 400, 32, 0.01
_GROUP = STEP * EMBED
_PER_BLOCK = BLOCK // STEP


def fold(doc_id):
    """crc32 of the id as text, modulo FOLDS; fold 0 is held out. A null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def n_blocks(length: int) -> int:
    """Blocks of a text: its bytes and LAGS zeros at least, two blocks at least."""
    return max(2, -(-(length + LAGS) // BLOCK))


def echoes(data: np.ndarray) -> np.ndarray:
    """For each row of LAGS + n bytes the share of its last n that end ECHO bytes which also end 2 to LAGS bytes before.

    Zeros stand for no byte; shares of few bytes are damped.
    """
    width = data.shape[1]
    there = data[:, LAGS:] != 0
    any_lag = np.zeros(there.shape, bool)
    for lag in range(2, LAGS - ECHO + 2):
        same = data[:, LAGS - ECHO + 1 :] == data[:, LAGS - ECHO + 1 - lag : width - lag]
        two = same[:, 1:] & same[:, :-1]
        any_lag |= two[:, 2:] & two[:, :-2]
    any_lag &= there
    return (np.count_nonzero(any_lag, axis=1) / (np.count_nonzero(there, axis=1) + 8.0)).astype(np.float32)


class ByteNet:
    """The network: parameters, forward pass over whole texts, and training on chunks."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def start(*shape):
            return (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)

        self.p = {
            "embed": (rng.standard_normal((256, EMBED)) * 0.5).astype(np.float32),
            "filters": start(2 * _GROUP, FILTERS),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": start(FILTERS + 1, HIDDEN),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": start(HIDDEN, 1)[:, 0],
            "out_bias": np.zeros(1, np.float32),
            "pool": np.array([1.0, 0.0, 0.0, 0.0], np.float32),
        }

    def chunk_logits(self, pooled: np.ndarray) -> np.ndarray:
        p = self.p
        return np.maximum(pooled @ p["hidden"] + p["hidden_bias"], 0) @ p["out"] + p["out_bias"][0]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """A probability for each text; what else is in the list makes no difference."""
        p, blocks = self.p, np.array([n_blocks(len(t)) for t in texts], np.int64)
        data = np.frombuffer(b"".join(t.ljust(n * BLOCK, b"\0") for t, n in zip(texts, blocks.tolist(), strict=True)), np.uint8)
        ends = np.cumsum(blocks)
        best = np.empty((len(data) // BLOCK, FILTERS), np.float32)
        echo = np.empty(len(best), np.float32)
        led = np.concatenate((np.zeros(LAGS, np.uint8), data))
        run = 2048
        for at in range(0, len(best), run):
            to = min(len(best), at + run)
            rows = np.lib.stride_tricks.sliding_window_view(led[at * BLOCK : to * BLOCK + LAGS], LAGS + BLOCK)[::BLOCK]
            echo[at:to] = echoes(np.ascontiguousarray(rows))
            part = data[at * BLOCK : to * BLOCK + STEP]
            part = np.concatenate((part, np.zeros((to - at) * BLOCK + STEP - len(part), np.uint8)))
            x = p["embed"][part].reshape(-1, _GROUP)
            out = x[:-1] @ p["filters"][:_GROUP]
            out += x[1:] @ p["filters"][_GROUP:]
            out = out.reshape(to - at, _PER_BLOCK, FILTERS)
            last = ends[(ends > at) & (ends <= to)] - 1 - at  # the last window of a text's last block reaches into the next text
            out[last, -1] = out[last, -2]
            out.max(axis=1, out=best[at:to])
        best = np.concatenate((np.maximum(best + p["bias"], 0), echo[:, None]), axis=1)
        starts = ends - blocks
        chunk = np.ones(len(best), bool)
        chunk[ends - 1] = False
        first = np.flatnonzero(chunk)
        logits = self.chunk_logits(np.maximum(best[first], best[first + 1])).astype(np.float64)
        at = starts - np.arange(len(texts))
        mean = np.add.reduceat(logits, at) / (blocks - 1)
        z = np.stack([mean, np.maximum.reduceat(logits, at), np.minimum.reduceat(logits, at)], 1) @ p["pool"][:3] + p["pool"][3]
        return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)

    def train(self, texts: list[bytes], labels: np.ndarray, seed: int = 11) -> ByteNet:
        """Adam over balanced batches of whole texts."""
        docs = list(map(chunks_of, texts))
        echo = [chunk_echoes(d) for d in docs]
        rng, p = np.random.default_rng(seed), self.p
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
        by_label = [np.flatnonzero(labels == v) for v in (0, 1)]
        for step in range(1, STEPS + 1):
            pick = np.concatenate([rng.choice(own, BATCH // 2) for own in by_label])
            grads = self._gradients([docs[i] for i in pick], np.concatenate([echo[i] for i in pick]), labels[pick].astype(np.float32))
            rate = RATE * min(1, step / 20) * (1 - 0.95 * step / STEPS)
            for k, g in grads.items():
                m, v = moments[k]
                g = np.clip(g, -1, 1) + (1e-4 * p[k] if k != "pool" else 0)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, docs: list[np.ndarray], echo: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over documents; group by group of chunks, forward and then back."""
        p, counts = self.p, np.array([len(d) for d in docs])
        n, at = int(counts.sum()), np.concatenate(([0], np.cumsum(counts)[:-1]))
        of = np.repeat(np.arange(len(docs)), counts)
        groups = list(_groups(docs))
        where, peak = np.empty((n, FILTERS), np.int64), np.empty((n, FILTERS), p["bias"].dtype)
        done = 0
        for own in groups:
            own = np.concatenate(own)[:, LAGS:]
            x = p["embed"][own].reshape(len(own), -1, _GROUP)
            out = x[:, :-1] @ p["filters"][:_GROUP]
            out += x[:, 1:] @ p["filters"][_GROUP:]
            best = out.argmax(axis=1)
            where[done : done + len(own)] = best
            peak[done : done + len(own)] = np.take_along_axis(out, best[:, None], axis=1)[:, 0] + p["bias"]
            done += len(own)
        pooled = np.concatenate((np.maximum(peak, 0), echo[:, None]), axis=1)
        pre = pooled @ p["hidden"] + p["hidden_bias"]
        hid = np.maximum(pre, 0)
        logit = hid @ p["out"] + p["out_bias"][0]
        mean = np.add.reduceat(logit, at) / counts
        top, low = np.maximum.reduceat(logit, at), np.minimum.reduceat(logit, at)
        feats = np.stack([mean, top, low, np.ones_like(mean)], 1)
        z = np.clip(feats @ p["pool"], -30, 30)
        dz = (1 / (1 + np.exp(-z)) - y) / len(docs)
        dl = (dz * p["pool"][0] / counts)[of]
        dl += (logit == top[of]) * (dz * p["pool"][1])[of] + (logit == low[of]) * (dz * p["pool"][2])[of]
        dh = np.outer(dl, p["out"]) * (pre > 0)
        dp = (dh @ p["hidden"][:FILTERS].T) * (peak > 0)
        d_filters, d_embed, done = np.zeros_like(p["filters"]), np.zeros(p["embed"].shape), 0
        for own in groups:
            own = np.concatenate(own)[:, LAGS:]
            part = slice(done, done + len(own))
            read = own[np.arange(len(own))[:, None, None], (where[part] * STEP)[:, :, None] + np.arange(WIDTH)]
            at_peak = p["embed"][read].reshape(len(own), FILTERS, -1)
            d_filters += np.einsum("ncg,nc->gc", at_peak, dp[part])
            d_wide = (dp[part][:, :, None] * p["filters"].T[None]).reshape(-1, EMBED)
            d_embed += np.stack([np.bincount(read.ravel(), d_wide[:, j], 256) for j in range(EMBED)], 1)
            done += len(own)
        return {
            "embed": d_embed.astype(p["embed"].dtype),
            "filters": d_filters,
            "bias": dp.sum(0),
            "hidden": pooled.T @ dh,
            "hidden_bias": dh.sum(0),
            "out": hid.T @ dl,
            "out_bias": np.array([dl.sum()], np.float32),
            "pool": feats.T @ dz,
        }


def _groups(docs: list[np.ndarray]):
    """The chunks of all documents in a row, in lists of GROUP_CHUNKS at most."""
    held, size = [], 0
    for d in docs:
        while len(d):
            held.append(d[: GROUP_CHUNKS - size])
            size += len(held[-1])
            d = d[len(held[-1]) :]
            if size == GROUP_CHUNKS:
                yield held
                held, size = [], 0
    if held:
        yield held


def chunks_of(text: bytes) -> np.ndarray:
    """All chunks of a text, as the scoring cuts them, each led by the LAGS bytes before it; a view of the text, not copies."""
    blocks = n_blocks(len(text))
    data = np.frombuffer(b"\0" * LAGS + text.ljust(blocks * BLOCK + STEP, b"\0"), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, LAGS + 2 * BLOCK + STEP)[::BLOCK][: blocks - 1]


def chunk_echoes(chunks: np.ndarray) -> np.ndarray:
    """The larger of the echoes of a chunk's two blocks."""
    parts = [chunks[i : i + GROUP_CHUNKS] for i in range(0, len(chunks), GROUP_CHUNKS)]
    return np.concatenate([np.maximum(echoes(c[:, : LAGS + BLOCK]), echoes(c[:, BLOCK : LAGS + 2 * BLOCK])) for c in parts])


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[bytes], np.ndarray]:
    """Whole texts and labels of `rows` labelled documents at most that aren't held out, chosen by a hash of the id.

    Half of them are of each label if there are as many; texts longer than
    LONGEST are left out, and so are those with which the sample, in order of
    the hash, would have more than TRAIN_BYTES. Repeated labels of one id are
    averaged; ids and qualities that are null are left out; of repeated document
    rows the one with the least text counts.
    """
    told = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .withColumn("rank", F.xxhash64("doc_id"))
    )
    halves = [told.where(F.col("label") == v).orderBy("rank", "doc_id").limit(rows // 2) for v in (0, 1)]
    chosen = materialize(halves[0].unionByName(halves[1]).select("doc_id", "label", "rank"), "quality-chosen")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).where(F.octet_length("text") <= LONGEST)
    own = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "rank").agg(F.min("text").alias("text"))
    sample = materialize(own, "quality-sample")
    size = F.sum(F.octet_length("text")).over(Window.orderBy("rank", "doc_id"))
    within = sample.select("doc_id", (size <= TRAIN_BYTES).alias("within")).where("within")
    found = sample.join(F.broadcast(within), "doc_id").select("rank", "doc_id", "label", "text").toArrow()
    found = found.sort_by([("rank", "ascending"), ("doc_id", "ascending")])
    return found.column("text").to_pylist(), found.column("label").to_numpy().astype(np.int64)


class Constant:
    """Where there is nothing to learn from: the share of label 1, or a half."""

    def __init__(self, labels: np.ndarray):
        self.score = float(labels.mean()) if len(labels) else 0.5

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.score)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ByteNet | Constant:
    """The network trained on the sample; with labels of one kind or none, a constant."""
    sample, y = training_sample(docs, labels, rows)
    net = ByteNet().train(sample, y) if 0 < y.sum() < len(y) else Constant(y)
    del sample
    release()
    return net


def _scores(model, batch, name: str = "text") -> np.ndarray:
    out = np.zeros(batch.num_rows)
    for at, texts in slices(batch, name):
        out[at : at + len(texts)] = model.scores(texts)
    return out


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of docs.

    Scores depend on the text alone; null counts as empty, which has a score as
    any text; repeated rows have equal scores. Without labels of both kinds all
    scores are the share of label 1, or 0.5. Other columns are not looked at.
    """
    model = fit(docs, labels)

    def score(batches):
        for batch in batches:
            s = _scores(model, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return map_batches(rows, score, "doc_id long, held_out boolean, score double, predicted int")


def without_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns.

    A row is judged by its text alone, null as empty, so repeated rows stay or go
    together; an empty table gives no rows. Without labels of both kinds all rows
    have one score and stay or go together.
    """
    model = fit(docs, labels)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch) >= threshold))

    return map_batches(docs, keep, docs.schema)
