"""Benchmark decontamination by a prefix-filtered set join.

Each item is cut into windows of consecutive words and each window into
shingles. A first pass over the documents counts the items' shingles, which
gives the order from rare to frequent. Of a window with n shingles of which
`need` must be contained, the n - need + 1 rarest are its prefix: an occurrence
holds one of them at least. A second pass looks up prefix shingles only, bounds
each candidate by the document's length and the shingle's place in the window,
and verifies the window word by word.

The items are the stated query set. They are taken in blocks of BLOCK_WORDS
words at most, so what a task holds is bounded; the documents are never moved.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_batches, materialize, slices, words_of

WINDOW = 13
SHINGLE = 5
CONTAINMENT = 1.0
BLOCK_WORDS = 500_000
#: A document is contaminated if this many times its hit words are no fewer than its words.
HIT_RATIO = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _shingle_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash for each start of k ids; ids are positive."""
    n = len(ids) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out *= _BASE
        out += ids[j : j + n].astype(np.uint64)
    return out ^ (out >> np.uint64(29))


class ItemBlock:
    """Windows and shingles of one block of items, and what finds them in texts."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int, shingle: int, containment: float):
        self.containment, self.vocabulary, self.names = containment, {}, []
        windows: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if words:
                length = min(window, len(words))
                for i in range(len(words) - length + 1):
                    windows.setdefault(tuple(words[i : i + length]), set()).add(len(self.names))
                self.names.append(name)
        self.windows = [(np.array(w, np.int64), sorted(of)) for w, of in windows.items()]
        self.shingles: dict[int, np.ndarray] = {}
        of_k: dict[int, list[np.ndarray]] = {}
        for w, _ in self.windows:
            k = min(shingle, len(w))
            of_k.setdefault(k, []).append(_shingle_hashes(w, k))
        self.shingle = shingle
        self.shingles = {k: np.unique(np.concatenate(v)) for k, v in of_k.items()}
        self.prefix: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]] = {}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Chooses each window's prefix: its rarest shingles, ties by hash."""
        self.lengths = np.array([len(w) for w, _ in self.windows], np.int64)
        self.wanted = np.zeros((len(self.windows), self.lengths.max(initial=0)), np.int64)
        for i, (w, _) in enumerate(self.windows):
            self.wanted[i, : len(w)] = w
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, (w, _) in enumerate(self.windows):
            k = min(self.shingle, len(w))
            own = _shingle_hashes(w, k).tolist()
            need = max(1, -int(-self.containment * len(own) // 1))
            ranked = sorted(range(len(own)), key=lambda j: (counts.get((k, own[j]), 0), own[j], j))
            for j in ranked[: len(own) - need + 1]:
                found.setdefault(k, {}).setdefault(own[j], []).append((i, j))
        for k, by in found.items():
            keys = np.array(sorted(by), np.uint64)
            self.prefix[k] = (keys, [by[int(x)] for x in keys])

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all texts in a row, 0 for words of no item, and where each text ends."""
        words: list[bytes] = []
        ends = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            words += words_of(text)
            ends[i] = len(words)
        return np.array(list(map(self.vocabulary.get, words, repeat(0))), np.int64), ends

    def found(self, ids: np.ndarray, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of shingles that are among the sorted keys, and which key each is."""
        if len(ids) < k or not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.cumsum(np.concatenate(([0], ids == 0)))
        starts = np.flatnonzero(known[k:] == known[: len(ids) - k + 1])
        hashes = _shingle_hashes(ids, k)[starts]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = keys[at] == hashes
        return starts[hit], at[hit]

    def count(self, texts: list[bytes], into: dict[int, np.ndarray]) -> None:
        ids, _ = self.read(texts)
        for k, keys in self.shingles.items():
            _, at = self.found(ids, k, keys)
            into[k] += np.bincount(at, minlength=len(keys))

    def match(self, texts: list[bytes]):
        """For each text its number of words, and over all texts the verified (text, start, end, window), in words of the text."""
        ids, ends = self.read(texts)
        begins = np.concatenate(([0], ends[:-1]))
        spans = []
        for k, (keys, entries) in self.prefix.items():
            starts, at = self.found(ids, k, keys)
            if not len(starts):
                continue
            fan = np.array([len(e) for e in entries])
            flat = np.array([x for e in entries for x in e], np.int64)
            first = np.concatenate(([0], np.cumsum(fan)[:-1]))
            n = fan[at]
            pick = np.repeat(first[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            win, begin = flat[pick, 0], np.repeat(starts, n) - flat[pick, 1]
            text = np.searchsorted(ends, np.repeat(starts, n), side="right")
            length = self.lengths[win]
            fits = (begin >= begins[text]) & (begin + length <= ends[text])
            win, begin, text, length = win[fits], begin[fits], text[fits], length[fits]
            for size in np.unique(length):
                sel = length == size
                w, b, t = win[sel], begin[sel], text[sel]
                same = np.ones((len(w), size - k + 1), bool)
                wanted = self.wanted[:, :size]
                for part in range(0, len(w), 100_000):
                    rows = slice(part, part + 100_000)
                    equal = ids[b[rows, None] + np.arange(size)] == wanted[w[rows]]
                    for j in range(k):
                        same[rows] &= equal[:, j : j + size - k + 1]
                need = max(1, -int(-self.containment * (size - k + 1) // 1))
                ok = same.sum(1) >= need
                spans.append(np.stack([t[ok], b[ok] - begins[t[ok]], b[ok] - begins[t[ok]] + size, w[ok]], 1))
        found = np.unique(np.concatenate(spans), axis=0) if spans else np.zeros((0, 4), np.int64)
        return ends - begins, found


def _counts(docs: DataFrame, block: ItemBlock) -> dict[tuple[int, int], int]:
    """How often each shingle of the block occurs in all documents; as many numbers as the block has shingles."""

    def count(batches):
        into = {k: np.zeros(len(v), np.int64) for k, v in block.shingles.items()}
        for batch in batches:
            for _, texts in slices(batch):
                block.count(texts, into)
        for k, n in into.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int64)), pa.array(n[some])], ["k", "nth", "n"]
            )

    rows = map_batches(docs.select("text"), count, "k int, nth long, n long").groupBy("k", "nth").agg(F.sum("n").alias("n")).collect()
    return {(r["k"], int(block.shingles[r["k"]][r["nth"]])): r["n"] for r in rows}


def _blocks(items: DataFrame, window: int, shingle: int, containment: float):
    """Blocks of items; a null text has no words. At least one block, which may be empty."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    held, size, any_yet = [], 0, False
    for r in rows.where("text is not null").orderBy("item_id", "text").toLocalIterator():
        text = bytes(r["text"])
        n = len(words_of(text))
        if held and size + n > BLOCK_WORDS:
            yield ItemBlock(held, window, shingle, containment)
            held, size, any_yet = [], 0, True
        held.append((r["item_id"], text))
        size += n
    if held or not any_yet:
        yield ItemBlock(held, window, shingle, containment)


def matched(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """docs and, last, its number of words, spans as binary (int64 pairs: from word, to word) and items as array<string>."""
    names = docs.columns
    words, spans, found = fresh(names, "_n_words", "_spans", "_items")
    out = docs.withColumns({words: F.lit(0).cast("long"), spans: F.lit(b""), found: F.array().cast("array<string>")})
    blocks = iter(_blocks(items, window, shingle, containment))
    block = next(blocks)
    while block:
        block.order(_counts(docs, block))
        out = map_batches(out, _matcher(block, len(names)), out.schema)
        if block := next(blocks, None):
            out = materialize(out, "matched")
    return out


def _matcher(block: ItemBlock, n: int):
    def match(batches):
        for batch in batches:
            lengths = np.zeros(batch.num_rows, np.int64)
            spans, items = batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist()
            for at, texts in slices(batch):
                lengths[at : at + len(texts)], found = block.match(texts)
                cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
                for i in np.flatnonzero(np.diff(cuts)):
                    rows = found[cuts[i] : cuts[i + 1]]
                    own = {block.names[x] for w in np.unique(rows[:, 3]) for x in block.windows[w][1]} - {None}
                    spans[at + i] += np.ascontiguousarray(rows[:, 1:3]).tobytes()
                    items[at + i] = sorted(own.union(items[at + i]))
            columns = [*batch.columns[:n], pa.array(lengths), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return match


def covered(spans: bytes) -> int:
    """Words inside any of the spans."""
    pairs = np.frombuffer(spans, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reached = np.concatenate(([0], np.maximum.accumulate(pairs[:, 1])[:-1])) if len(pairs) else pairs[:, 0]
    return int(np.maximum(0, pairs[:, 1] - np.maximum(pairs[:, 0], reached)).sum())


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items: a row for each row of docs.

    Null and empty texts have no words and are clean; repeated rows each have
    their row; items without words never occur, equal items with different ids
    all do, and an item without an id hits words but isn't among the items
    listed; with no items all documents are clean. Other columns of either table
    are not looked at.
    """
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"

    def digest(batches):
        for batch in batches:
            n_words = batch.column(2).to_numpy()
            n_hit = np.array([covered(x) if x else 0 for x in batch.column(3).to_pylist()], np.int64)
            items = batch.column(4).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n_hit),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                    pa.array((n_hit > 0) & (HIT_RATIO * n_hit >= n_words)),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
            )

    found = matched(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items, window, shingle, containment)
    return map_batches(found, digest, schema)


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = CONTAINMENT, least_share: float = 0.0
) -> DataFrame:
    """The rows of docs that hold no window of any item, with all their columns.

    With a least_share above 0 a document goes only if its hit words are at least
    that share of its words. Null and empty texts stay, as do all documents if
    there are no items; repeated rows fare alike, and ids aren't looked at, of
    documents or of items.
    """
    n = len(docs.columns)

    def keep(batches):
        for batch in batches:
            n_words = batch.column(n).to_numpy()
            n_hit = np.array([covered(x) if x else 0 for x in batch.column(n + 1).to_pylist()], np.int64)
            clean = pa.RecordBatch.from_arrays(batch.columns[:n], batch.schema.names[:n])
            yield clean.filter(pa.array(~((n_hit > 0) & (n_hit >= least_share * n_words))))

    return map_batches(matched(docs, items, window, shingle, containment), keep, docs.schema)
