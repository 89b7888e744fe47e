"""Removal of repeated byte strings by longest-previous-factor arrays.

A position's longest previous factor is the longest string that starts both
there and in an earlier document. In suffix order it is shared with the nearest
suffix of an earlier document on one of the two sides, so the previous and next
smaller values over that order decide whether it reaches LENGTH bytes.

No machine holds the suffixes of the corpus, and few of them matter, so:

0. Of texts that are equal byte for byte (by SHA-256) all but those of the
   smallest document are settled at once; only they are moved.
1. The other texts are packed into chunks of about CHUNK bytes, one table row
   each; the table is in buckets, so what later meets it doesn't move it.
2. Each window of LENGTH bytes is named by the least hash among its GRAM-byte
   grams. Windows of one name in a row are a run; equal windows have equal
   names. Chunks send the names they hold and how many runs have each, packed,
   to buckets, which answer with two bits for each: does another document have
   it, and do more runs have it than one task should hold? Runs of such a hot
   name are cut into single windows, each named by all its bytes, which spreads
   them over the buckets by the same rule in every chunk.
3. Runs of names that other documents have go to the buckets with their bytes.
   Runs of equal bytes within a chunk are settled there, whatever their number,
   so a bucket gets each at most once from each chunk.
4. A bucket settles runs of equal bytes by the smallest document, puts the
   windows of all others of one name in suffix order and takes the previous and
   next smaller documents there. Chunks get back the bytes to remove.

All strings are compared as bytes; hashes only decide what meets where.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import LAST, chunks, pack_numbers, pack_sorted, read_chunk, unpack_numbers, unpack_sorted
from .common import bucketed, by_bitmap, groups, lookup, map_batches, materialize, n_partitions, text_bytes

LENGTH = 50
GRAM = 16
CHUNK = 4 << 20
#: Text bytes for each bucket.
BUCKET = 8 << 20
#: Bits of a name; more documents may seem to share one with fewer, which costs time only.
NAME_BITS = 52
#: A name of more runs is hot: about half of what a bucket of text has of all names.
HOT_RUNS = 1 << 18
#: Windows that are put in order at a time.
SORT_WINDOWS = 200_000
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a number; zeros follow the data."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    out = np.empty(len(data) + 8, np.uint64)
    for o in range(8):
        part = out[o::8]
        part[:] = np.frombuffer(padded, "<u8", count=len(part), offset=o)
    return out[: len(data)]


def window_names(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each start of `length` bytes the least hash of the grams inside; gram is a multiple of 8."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    width, step = length - gram + 1, 1 << 16
    for at in range(0, n, step):
        to = min(n, at + step)
        w = _words(data[at : to + length - 1])
        grams = to - at + width - 1
        h = w[:grams] * _A
        for j, c in zip(range(8, gram, 8), (_B, _C, _D, _A), strict=False):
            h ^= w[j : j + grams] * c
            h ^= h >> np.uint64(31)
        h *= _D
        h ^= h >> np.uint64(32)
        h *= _B
        span = 1
        while span * 2 <= width:
            h = np.minimum(h[:-span], h[span:])
            span *= 2
        rest = width - span
        out[at:to] = np.minimum(h[: to - at], h[rest : rest + to - at]) if rest else h[: to - at]
    out *= _A  # the least of many hashes is small: spread evenly again
    out ^= out >> np.uint64(29)
    out *= _D
    return out >> np.uint64(64 - NAME_BITS)


def runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, past the last window, document) of all runs in texts that follow each other up to `ends`."""
    names = window_names(data, length)
    if not len(names):
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    begins = np.concatenate(([0], ends[:-1]))
    cuts = np.unique(np.concatenate((np.flatnonzero(names[1:] != names[:-1]) + 1, begins, np.maximum(ends - length + 1, begins))))
    cuts = cuts[cuts < len(names)]
    stops = np.append(cuts[1:], len(names))
    doc = np.searchsorted(ends, cuts, side="right")
    inside = cuts + length <= ends[np.minimum(doc, len(ends) - 1)]
    return names[cuts[inside]], cuts[inside], stops[inside], doc[inside]


def _merged(pairs: np.ndarray) -> np.ndarray:
    """Intervals (n, 2) as disjoint ones in order; those that touch become one."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] > reach[:-1])))
    return np.stack([pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]], 1)


def _send_names(length: int, bits: int):
    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys, ends, data = read_chunk(batch, i)
                names, _, _, doc = runs(data, ends, length)
                if not len(names):
                    continue
                order = np.argsort(names)
                names, key = names[order], keys[doc[order]]
                first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
                several = np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first)
                n = np.diff(np.append(first, len(names)))
                names = names[first]
                bucket = (names >> np.uint64(NAME_BITS - bits)).astype(np.int64)
                cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
                some = np.flatnonzero(np.diff(cuts)).tolist()
                chunk = batch.column(0)[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array([chunk] * len(some), pa.int64()),
                        pa.array([pack_sorted(names[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
                        pa.array([np.packbits(several[cuts[b] : cuts[b + 1]]).tobytes() for b in some], pa.binary()),
                        pa.array([pack_numbers(n[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
                    ],
                    ["bucket", "chunk", "names", "several", "runs"],
                )

    return send


def _answer(hot_runs: int):
    """Two bits for each name that a chunk has sent: do several documents have it, and do more than hot_runs runs?"""

    def answer(batches):
        for t in groups(batches, "bucket"):
            names = [unpack_sorted(x) for x in t.column("names").to_pylist()]
            sizes = [len(n) for n in names]
            several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(t.column("several").to_pylist(), sizes, strict=True)])
            n_runs = np.concatenate([unpack_numbers(x) for x in t.column("runs").to_pylist()])
            names = np.concatenate(names)
            order = np.argsort(names)
            first = np.flatnonzero(np.concatenate(([True], names[order[1:]] != names[order[:-1]])))
            count = np.diff(np.append(first, len(names)))
            shared, hot = np.empty(len(names), bool), np.empty(len(names), bool)
            shared[order] = np.repeat((count > 1) | (np.maximum.reduceat(several[order], first) > 0), count)
            hot[order] = np.repeat(np.add.reduceat(n_runs[order], first) > hot_runs, count)
            ends = np.cumsum(sizes).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(t.column("chunk").to_pylist(), pa.int64()),
                    pa.array(t.column("bucket").to_pylist(), pa.int32()),
                    *(
                        pa.array([np.packbits(x[e - n : e]).tobytes() if x[e - n : e].any() else None for n, e in zip(sizes, ends, strict=True)], pa.binary())
                        for x in (shared, hot)
                    ),
                ],
                ["chunk", "bucket", "shared", "hot"],
            )

    return answer


def _single_windows(data: np.ndarray, hot: np.ndarray, names, begin, stop, doc, length: int):
    """Runs, those that are hot as one for each of their windows, named by its bytes."""
    if not hot.any():
        return names, begin, stop, doc
    n = (stop - begin)[hot]
    at = np.repeat(begin[hot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    words, h = _words(data), np.zeros(len(at), np.uint64)
    for o in (*range(0, length - 8, 8), length - 8):
        h = (h ^ words[at + o]) * _A
        h ^= h >> np.uint64(29)
    h = h * _D >> np.uint64(64 - NAME_BITS)
    pairs = ((names, h), (begin, at), (stop, at + 1), (doc, np.repeat(doc[hot], n)))
    return tuple(np.concatenate((of[~hot], own)) for of, own in pairs)


def _send_runs(length: int, bits: int):
    """Runs of shared names: settled where the chunk can, sent once for each string of bytes otherwise."""

    def send(batches):
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            answers = batch.column(batch.schema.get_field_index("answers"))
            for i in range(batch.num_rows):
                answer = answers[i].as_py()
                if not answer:
                    continue
                keys, ends, data = read_chunk(batch, i)
                names, begin, stop, doc = runs(data, ends, length)
                held = np.unique(names)
                bucket = (held >> np.uint64(NAME_BITS - bits)).astype(np.int64)
                shared, hot = np.zeros(len(held), bool), np.zeros(len(held), bool)
                for a in answer:
                    lo, hi = np.searchsorted(bucket, [a["bucket"], a["bucket"] + 1])
                    for bit, told in ((shared, a["shared"]), (hot, a["hot"])):
                        if told is not None:
                            bit[lo:hi] = np.unpackbits(np.frombuffer(told, np.uint8), count=hi - lo)
                at = np.searchsorted(held, names)
                keep = shared[at]
                names, begin, stop, doc = _single_windows(data, hot[at[keep]], names[keep], begin[keep], stop[keep], doc[keep], length)
                stop, key = stop + length - 1, keys[doc]
                order = np.lexsort((begin, key))
                raw = data.tobytes()
                seen: dict[bytes, int] = {}
                first: list[int] = []
                ref: list[int] = []
                at: list[int] = []
                settled: list[int] = []
                for j, b, e, k in zip(order.tolist(), begin[order].tolist(), stop[order].tolist(), key[order].tolist(), strict=True):
                    n = seen.setdefault(raw[b:e], len(first))
                    if n == len(first):
                        first.append(j)
                    elif k > key[first[n]]:
                        settled.append(j)
                        continue
                    ref.append(n)
                    at.append(b)
                chunk = batch.column(0)[i].as_py()
                pairs = _merged(np.stack([begin[settled], stop[settled]], 1)).astype(np.int32)
                own = np.array(first, np.int64)
                to = (names[own] >> np.uint64(NAME_BITS - bits)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                cuts = np.searchsorted(to[by], np.arange((1 << bits) + 1))
                refs, places = np.array(ref, np.int64), np.array(at, np.int32)
                rank = np.empty(len(own), np.int64)
                rank[by] = np.arange(len(own))
                refs = rank[refs]
                order = np.argsort(refs, kind="stable")
                refs, places = refs[order], places[order]
                rows = []
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    mine = own[by[cuts[b] : cuts[b + 1]]]
                    lo, hi = np.searchsorted(refs, [cuts[b], cuts[b + 1]])
                    rows.append(
                        {
                            "bucket": b,
                            "chunk": chunk,
                            "names": names[mine].tobytes(),
                            "keys": key[mine].tobytes(),
                            "sizes": (stop[mine] - begin[mine]).astype(np.int32).tobytes(),
                            "data": z.compress(b"".join([raw[x:y] for x, y in zip(begin[mine].tolist(), stop[mine].tolist(), strict=True)])),
                            "refs": (refs[lo:hi] - cuts[b]).astype(np.int32).tobytes(),
                            "places": places[lo:hi].tobytes(),
                            "settled": None,
                        }
                    )
                rows.append(dict.fromkeys(rows[0] if rows else _RUNS.names) | {"bucket": chunk % (1 << bits), "chunk": chunk, "settled": pairs.tobytes()})
                yield pa.RecordBatch.from_pylist(rows, _RUNS)

    return send


_RUNS = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64())]
    + [(k, pa.binary()) for k in ("names", "keys", "sizes", "data", "refs", "places", "settled")]
)


def removed_windows(data: np.ndarray, starts: np.ndarray, key: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the window at each start has a longest previous factor of `length` bytes: an equal one of a smaller key.

    Windows are put in suffix order, as deep as matters; in each stretch of equal
    ones the running minimum of the keys from the left finds the previous
    smaller, that from the right the next smaller. Windows are taken in passes by
    a hash of their first 8 bytes, which keeps equal ones together.
    """
    out = np.zeros(len(starts), bool)
    passes = -(-len(starts) // SORT_WINDOWS)
    turn = (_words(data)[starts] * _A >> np.uint64(33)) % np.uint64(max(passes, 1))
    for p in range(passes):
        sel = np.flatnonzero(turn == p)
        for part in _by_first_bytes(data, starts, sel, length):
            w = np.lib.stride_tricks.sliding_window_view(data, length)[starts[part]].view(f"S{length}").ravel()
            order = np.argsort(w, kind="stable")
            same = w[order[1:]] == w[order[:-1]]
            stretch = np.concatenate(([0], np.cumsum(~same)))
            k = key[part][order]
            rank = np.unique(k, return_inverse=True)[1]
            wide = np.int64(rank.max(initial=0) + 1)
            left = stretch[-1:] * 0 if not len(k) else np.minimum.accumulate(rank - stretch * wide) + stretch * wide
            back = stretch[::-1].max(initial=0) - stretch[::-1]
            right = (np.minimum.accumulate(rank[::-1] - back * wide) + back * wide)[::-1]
            out[part[order]] = (left < rank) | (right < rank)
    return out


def _by_first_bytes(data: np.ndarray, starts: np.ndarray, sel: np.ndarray, length: int):
    """sel as it is; where one pass is far too large since many windows start alike, in parts by deeper bytes."""
    depth = 8
    parts = [sel]
    while depth + 8 <= length and max((len(p) for p in parts), default=0) > 4 * SORT_WINDOWS:
        split = []
        for p in parts:
            if len(p) <= 4 * SORT_WINDOWS:
                split.append(p)
                continue
            turn = (_words(data)[starts[p] + depth] * _B >> np.uint64(33)) % np.uint64(8)
            split += [p[turn == i] for i in range(8)]
        parts, depth = split, depth + 8
    return [p for p in parts if len(p)]


def _settle(length: int):
    """For each chunk the intervals to remove, as int32 pairs."""

    def settle(batches):
        for t in groups(batches, "bucket"):
            rows = t.to_pylist()
            removed: dict[int, list[np.ndarray]] = {}
            number: dict[bytes, int] = {}
            least: list[int] = []
            name_of: list[int] = []
            sent = []
            for r in rows:
                if r["settled"] is not None:
                    removed.setdefault(r["chunk"], []).append(np.frombuffer(r["settled"], np.int32).reshape(-1, 2))
                    continue
                names, keys = np.frombuffer(r["names"], np.uint64).tolist(), np.frombuffer(r["keys"], np.int64)
                sizes, raw = np.frombuffer(r["sizes"], np.int32), zstandard.ZstdDecompressor().decompress(r["data"])
                ids = np.empty(len(sizes), np.int64)
                b = 0
                for i, (size, k) in enumerate(zip(sizes.tolist(), keys.tolist(), strict=True)):
                    n = ids[i] = number.setdefault(raw[b : b + size], len(least))
                    b += size
                    if n == len(least):
                        least.append(k)
                        name_of.append(names[i])
                    elif k < least[n]:
                        least[n] = k
                refs, places = np.frombuffer(r["refs"], np.int32), np.frombuffer(r["places"], np.int32)
                sent.append((r["chunk"], ids, keys, sizes.astype(np.int64), refs, places.astype(np.int64)))
            first, lo, hi = _partial(list(number), np.array(least, np.int64), np.array(name_of, np.uint64), length)
            floor = np.array(least, np.int64)
            for chunk, ids, keys, sizes, refs, places in sent:
                whole = (keys > floor[ids])[refs]
                pairs = [np.stack([places[whole], places[whole] + sizes[refs[whole]]], 1)]
                rest = np.flatnonzero(~whole)
                n = first[ids[refs[rest]] + 1] - first[ids[refs[rest]]]
                pick = np.arange(n.sum()) + np.repeat(first[ids[refs[rest]]] - (np.cumsum(n) - n), n)
                shift = np.repeat(places[rest], n)
                pairs.append(np.stack([shift + lo[pick], shift + hi[pick]], 1))
                removed.setdefault(chunk, []).append(np.concatenate(pairs))
            out = {c: _merged(np.concatenate(v)).astype(np.int32) for c, v in removed.items()}
            out = {c: v for c, v in out.items() if len(v)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int64()), pa.array([v.tobytes() for v in out.values()], pa.binary())], ["chunk", "removed"]
            )

    return settle


def _partial(texts: list[bytes], key: np.ndarray, names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For different strings of one name: where the intervals to remove of each begin, and all these intervals."""
    count = np.zeros(len(texts), np.int64)
    if not len(texts):
        return np.zeros(1, np.int64), count, count
    _, at, n = np.unique(names, return_inverse=True, return_counts=True)
    some = np.flatnonzero(n[at] > 1)
    data = np.frombuffer(b"".join([texts[i] for i in some]), np.uint8)
    sizes = np.array([len(texts[i]) for i in some], np.int64)
    ends = np.cumsum(sizes)
    windows = sizes - length + 1
    starts = np.arange(windows.sum()) + np.repeat(ends - sizes - (np.cumsum(windows) - windows), windows)
    gone = starts[removed_windows(data, starts, np.repeat(key[some], windows), length)] if len(starts) else starts
    mark = np.zeros(len(data) + 1, np.int32)
    np.add.at(mark, gone, 1)
    np.add.at(mark, gone + length, -1)
    mask = np.cumsum(mark[:-1]) > 0
    edge = np.ones(len(data), bool)
    if len(data):
        edge[1:] = mask[1:] != mask[:-1]
        edge[(ends - sizes)] = True
    cut = np.flatnonzero(edge)
    stop = np.append(cut[1:], len(data))
    cut, stop = cut[mask[cut]], stop[mask[cut]]
    owner = np.searchsorted(ends, cut, side="right")
    count[some] = np.bincount(owner, minlength=len(some))
    base = (ends - sizes)[owner]
    return np.concatenate(([0], np.cumsum(count))), cut - base, stop - base


def _cut(batches):
    """The documents of each chunk without the removed intervals."""
    for batch in batches:
        removed = batch.column(batch.schema.get_field_index("removed"))
        for i in range(batch.num_rows):
            keys, ends, data = read_chunk(batch, i)
            begins = ends - np.diff(ends, prepend=0)
            mark = np.zeros(len(data) + 1, np.int32)
            for part in removed[i].as_py() or []:
                pairs = np.frombuffer(part, np.int32).reshape(-1, 2)
                np.add.at(mark, pairs[:, 0], 1)
                np.add.at(mark, pairs[:, 1], -1)
            gone = np.cumsum(mark[:-1]) > 0
            total = np.concatenate(([0], np.cumsum(gone)))
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            rise[begins[begins < ends]] = gone[begins[begins < ends]]
            spans = np.concatenate(([0], np.cumsum(rise)))
            kept = []
            raw = data.tobytes()
            for b, e, n in zip(begins.tolist(), ends.tolist(), (total[ends] - total[begins]).tolist(), strict=True):
                left = raw[b:e] if not n else b"" if n == e - b else data[b:e][~gone[b:e]].tobytes()
                kept.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, mask=keys == LAST),
                    pa.array(ends - begins),
                    pa.array(total[ends] - total[begins]),
                    pa.array(spans[ends] - spans[begins]),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def without_repeats(
    docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK, bucket_bytes: int = BUCKET, hot_runs: int = HOT_RUNS
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: a row for each row of docs.

    Each byte is removed that lies in a string of `length` bytes which also
    starts in a document with a smaller doc_id. Null texts are empty; a null id
    counts as larger than any other, and documents of one id (or none) don't
    remove each other, so repeated rows fare alike; texts shorter than `length`
    stay whole. An empty table gives no rows. Other columns are not looked at.
    hot_runs bounds what a task holds of one name and doesn't change the result.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), text_bytes().alias("text"))
    firsts, copies = _copies(rows)
    n_tasks = n_partitions(docs)
    packed = bucketed(chunks(firsts.select(F.col("key").alias("doc_id"), "text"), chunk_bytes), "chunk", "chunks", n_tasks)
    size = packed.agg(F.sum("size").alias("n")).first()["n"] or 0
    bits = max(0, (max(1, size // bucket_bytes) - 1).bit_length())
    chunk = packed.select("chunk", "keys", "ends", "data")
    names = map_batches(chunk, _send_names(length, bits), "bucket int, chunk long, names binary, several binary, runs binary")
    answers = map_batches(names.repartitionById(n_tasks, "bucket").sortWithinPartitions("bucket"), _answer(hot_runs), "chunk long, bucket int, shared binary, hot binary")
    answers = answers.repartition(n_tasks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "shared", "hot")).alias("answers"))
    told = chunk.hint("merge").join(answers, "chunk")
    kinds = "bucket int, chunk long, names binary, keys binary, sizes binary, data binary, refs binary, places binary, settled binary"
    sent = map_batches(told, _send_runs(length, bits), kinds)
    removed = map_batches(sent.repartitionById(n_tasks, "bucket").sortWithinPartitions("bucket"), _settle(length), "chunk long, removed binary")
    removed = removed.repartition(n_tasks, "chunk").groupBy("chunk").agg(F.collect_list("removed").alias("removed"))
    whole = chunk.hint("merge").join(removed, "chunk", "left")
    cut = map_batches(whole, _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    n, gone = F.octet_length("text").cast("long"), F.octet_length("text") >= length
    return cut.unionByName(
        copies.select(
            F.nullif("key", F.lit(LAST)).alias("doc_id"),
            n.alias("n_bytes"),
            F.when(gone, n).otherwise(F.lit(0).cast("long")).alias("n_removed"),
            gone.cast("long").alias("n_spans"),
            F.sha2(F.when(gone, F.lit(b"")).otherwise(F.col("text")), 256).alias("kept_sha256"),
        )
    )


def _copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (key, text) that are the first of their text, and those that repeat the text of a smaller key."""
    digest = F.sha2("text", 256).alias("digest")
    told = materialize(rows.select("key", digest), "digests")
    firsts = told.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = lookup(told, "digest", firsts, "n").where("key > _found.first").select(F.col("key").alias("copy"), F.col("digest").alias("of"))
    later = materialize(later.distinct(), "copies")
    seen = by_bitmap(rows, "key", later.select("copy"))
    maybe = seen.where("_maybe").select("key", "text", digest)
    same = (F.col("key") == F.col("copy")) & (F.col("digest") == F.col("of"))
    alone = seen.where("not _maybe").select("key", "text")
    return (
        alone.unionByName(maybe.join(later.hint("merge"), same, "left_anti").select("key", "text")),
        maybe.join(later.hint("merge"), same, "left_semi").select("key", "text"),
    )
