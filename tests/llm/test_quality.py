import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import quality as Q

from .conftest import text


def junk(i):
    kinds = [lambda: text(i, 30).upper().replace(" ", "!! "), lambda: " | ".join(text(i, 30).split()), lambda: " ".join(w for w in text(i, 8).split() for _ in range(12))]
    return kinds[i % 3]()


def table_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


ROWS = [(i, junk(i) if i % 4 == 0 else text(i, 20 + i % 90)) for i in range(400)]
LABELS = [(i, int(i % 4 != 0), 0) for i in range(400)]


@pytest.fixture(scope="module")
def scored(spark, documents):
    odd = [(1000, None), (1001, ""), (1002, "x"), (1003, text(3, 40_000)), (None, text(4, 30)), (1004, text(5, 30)), (1004, text(5, 30))]
    labels = [*LABELS, (None, 1, 0), (5, None, 0), (7, 1, 0), (7, 1, 1)]
    return Q.quality(documents(ROWS + odd, clashing=True), table_of(spark, labels)).collect()


def test_held_out_accuracy(scored):
    held = [r for r in scored if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in scored if r["doc_id"] is not None)
    assert len(held) > 40
    assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 4 != 0) for r in held]) >= 0.95


def test_every_row_has_a_score(scored):
    assert len(scored) == len(ROWS) + 7
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)
    by = {}
    for r in scored:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[1004]) == 1 and by[1000] == by[1001]


def test_a_score_depends_on_the_text_alone():
    net = Q.ByteNet().train([t.encode() for _, t in ROWS[:40]], np.array([y for _, y, _ in LABELS[:40]]))
    texts = [t.encode() for _, t in ROWS[:30]] + [b"", b"a" * 127, b"a" * 128, b"b" * 129, text(1, 3000).encode()]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=2e-6)
    assert np.allclose(together[::-1], net.scores(texts[::-1]), atol=2e-6)


def test_the_end_of_a_long_text_counts():
    net = Q.ByteNet().train([t.encode() for _, t in ROWS[:100]], np.array([y for _, y, _ in LABELS[:100]]))
    clean = text(1, 3000)
    assert net.scores([(clean + " " + junk(0) * 300).encode()])[0] < net.scores([clean.encode()])[0]


def test_gradients(monkeypatch):
    net = Q.ByteNet(3)
    docs = [Q.chunks_of(t.encode()) for _, t in ROWS[:6]]
    monkeypatch.setattr(Q, "GROUP_CHUNKS", 7)
    echo = np.concatenate([Q.chunk_echoes(d) for d in docs])
    y = np.array([y for _, y, _ in LABELS[:6]], np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["pool"] = np.array([0.7, 0.2, 0.1, 0.05])

    def loss():
        texts = [t.encode() for _, t in ROWS[:6]]
        s = np.clip(net_scores(net, docs, echo), 1e-9, 1 - 1e-9)
        assert len(texts) == len(s)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = net._gradients(docs, echo, y)
    rng = np.random.default_rng(0)
    for name in ("filters", "hidden", "out", "pool", "bias", "hidden_bias", "out_bias", "embed"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        for k in rng.choice(len(flat), min(4, len(flat)), replace=False):
            keep, eps = flat[k], 1e-5
            flat[k] = keep + eps
            up = loss()
            flat[k] = keep - eps
            down = loss()
            flat[k] = keep
            assert abs((up - down) / (2 * eps) - g[k]) < 1e-4 + 0.02 * abs(g[k]), name


def net_scores(net, docs, echo):
    p, out, at = net.p, [], 0
    for d in docs:
        x = p["embed"][d[:, Q.LAGS :]].reshape(len(d), -1, Q._GROUP)
        peak = (np.concatenate((x[:, :-1], x[:, 1:]), axis=2) @ p["filters"] + p["bias"]).max(axis=1)
        logits = net.chunk_logits(np.concatenate((np.maximum(peak, 0), echo[at : at + len(d), None]), axis=1))
        at += len(d)
        z = np.array([logits.mean(), logits.max(), logits.min(), 1]) @ p["pool"]
        out.append(1 / (1 + np.exp(-z)))
    return np.array(out)


def test_without_labels_of_both_kinds(spark, documents):
    docs = documents(ROWS[:20])
    assert {r["score"] for r in Q.quality(docs, table_of(spark, [])).collect()} == {0.5}
    assert {r["score"] for r in Q.quality(docs, table_of(spark, [(i, 1, 0) for i in range(20)])).collect()} == {1.0}
    assert Q.quality(docs.limit(0), table_of(spark, LABELS)).count() == 0


def test_filter_keeps_rows_whole(spark, documents):
    docs = documents(ROWS, clashing=True)
    out = Q.without_rejected(docs, table_of(spark, LABELS))
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert sum(i % 4 != 0 for i in kept) >= 295 and sum(i % 4 == 0 for i in kept) <= 5


def test_fold(spark):
    got = spark.range(50).select("id", Q.fold(F.col("id")).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def naive_score(net, t):
    """The network window by window and byte by byte, for one text."""
    if isinstance(net, Q.Constant):
        return net.score
    p, n = net.p, max(2, -(-(len(t) + Q.LAGS) // Q.BLOCK))
    data = b"\0" * Q.LAGS + t + b"\0" * (n * Q.BLOCK + Q.STEP - len(t))
    blocks = []
    for b in range(n):
        at, peaks = Q.LAGS + b * Q.BLOCK, []
        for s in range(0, Q.BLOCK, Q.STEP):
            if b < n - 1 or s + Q.WIDTH <= Q.BLOCK:
                window = [p["embed"][c] for c in data[at + s : at + s + Q.WIDTH]]
                peaks.append(np.concatenate(window) @ p["filters"] + p["bias"])
        own = [i for i in range(at, at + Q.BLOCK) if data[i]]
        same = [any(data[i - 3 : i + 1] == data[i - 3 - lag : i + 1 - lag] for lag in range(2, Q.LAGS - Q.ECHO + 2)) for i in own]
        blocks.append(np.append(np.maximum(np.max(peaks, axis=0), 0), sum(same) / (len(own) + 8)))
    logits = []
    for one, two in zip(blocks, blocks[1:], strict=False):
        hid = np.maximum(np.maximum(one, two) @ p["hidden"] + p["hidden_bias"], 0)
        logits.append(float(hid @ p["out"] + p["out_bias"][0]))
    z = np.array([np.mean(logits), max(logits), min(logits), 1]) @ p["pool"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def test_scores_equal_a_naive_forward_pass():
    net = Q.ByteNet().train([t.encode() for _, t in ROWS[:60]], np.array([y for _, y, _ in LABELS[:60]]))
    texts = [t.encode() for _, t in ROWS[:12]] + [b"", b"x", b"ab" * 200, b"\xc3\xa9" * 90, text(1, 700).encode(), *[bytes([97 + k % 26 for k in range(n)]) for n in (95, 96, 97, 127, 128, 129, 224, 225, 256)]]
    assert np.allclose(net.scores(texts), [naive_score(net, t) for t in texts], atol=1e-4)


def test_the_sample_is_bounded_and_whole(spark, documents, monkeypatch):
    rows = [(i, text(i, 10 + i)) for i in range(40)] + [(40, text(40, 5000)), (3, "zz"), (5, "")]
    labels = table_of(spark, [(i, i % 2, 0) for i in range(41)])
    texts, y = Q.training_sample(documents(rows), labels)
    want = {}
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5:
            want[i] = min(want.get(i, t), t)
    assert sorted(texts) == sorted(t.encode() for t in want.values()) and len(y) == len(texts)
    assert len(Q.training_sample(documents(rows), labels, 10)[0]) == 10
    monkeypatch.setattr(Q, "LONGEST", 10_000)
    assert max(map(len, Q.training_sample(documents(rows), labels)[0])) < 10_000
    monkeypatch.setattr(Q, "TRAIN_BYTES", 2000)
    assert 0 < sum(map(len, Q.training_sample(documents(rows), labels)[0])) <= 2000


def test_all_chunks_are_trained_on():
    t = text(1, 3000).encode()
    chunks = Q.chunks_of(t)
    assert len(chunks) == Q.n_blocks(len(t)) - 1 and b"".join(c[Q.LAGS : Q.LAGS + Q.BLOCK].tobytes() for c in chunks) == t[: len(chunks) * Q.BLOCK]
