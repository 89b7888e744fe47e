"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

The plan is relational: n-grams exploded from the documents are counted in
tables partitioned by the hash of the n-gram, the counts are joined back to the
exploded n-grams, and log scores are summed per document. Relations are kept
packed, since as rows they are many times the text: a chunk is about CHUNK bytes
of documents, and the n-grams that it sends to one partition of the count tables
are one row, a column of sorted n-grams and one of their numbers in the chunk.
That is also the map-side aggregation: an n-gram, however frequent, comes once
from each chunk. The partition adds the chunks up and answers with the counts of
all documents in the same order.

Every n-gram counts, from one occurrence on. least_count prunes rarer ones of
two and more words, so that a word whose context isn't known backs off; in the
corpus itself every n-gram is known.

N-grams are named by hashes of 24 bits more than the number of the corpus's
words has (64 at most), so about one in 2^24 shares its count with another,
alike at any size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import LAST, chunks, pack_numbers, pack_sorted, read_chunk, unpack_numbers, unpack_sorted
from .common import bucketed, groups, map_batches, n_partitions, words_of

ORDER = 3
BACKOFF = 0.4
LEAST_COUNT = 1
CHUNK = 4 << 20
#: Text bytes for each partition of the count tables.
BUCKET = 16 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that follow each other, and each text's number of words."""
    raw, begin = data.tobytes(), 0
    words: list[bytes] = []
    counts = np.zeros(len(ends), np.int64)
    for i, end in enumerate(ends.tolist()):
        own = words_of(raw[begin:end])
        words += own
        counts[i] = len(own)
        begin = end
    return np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64), counts


def ngrams(words: np.ndarray, counts: np.ndarray, order: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n from 1 to order: names of the n-grams within texts, and the places of their last words."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    out, h = [], np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        at = np.flatnonzero(place >= n - 1)
        h = np.concatenate((np.zeros(1, np.uint64), h[:-1])) if n > 1 else h
        h = _mix(h * _MUL + words + np.uint64(n))
        out.append((h[at] >> np.uint64(64 - bits), at))
    return out


def _send(order: int, bits: int, bucket_bits: int):
    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, ends, data = read_chunk(batch, i)
                grams = ngrams(*word_hashes(data, ends), order, bits)
                names, n = np.unique(np.concatenate([g for g, _ in grams]), return_counts=True)
                bucket = (names >> np.uint64(bits - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(names), np.int64)
                cuts = np.searchsorted(bucket, np.arange((1 << bucket_bits) + 1))
                some = np.flatnonzero(np.diff(cuts)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array([batch.column(0)[i].as_py()] * len(some), pa.int64()),
                        pa.array([pack_sorted(names[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
                        pa.array([pack_numbers(n[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
                    ],
                    ["bucket", "chunk", "names", "counts"],
                )

    return send


def _count(batches):
    """The count table of each bucket, joined back to what each chunk has sent."""
    for t in groups(batches, "bucket"):
        names = [unpack_sorted(x) for x in t.column("names").to_pylist()]
        sizes = [len(x) for x in names]
        n = np.concatenate([unpack_numbers(x) for x in t.column("counts").to_pylist()])
        names = np.concatenate(names)
        order = np.argsort(names)
        first = np.flatnonzero(np.concatenate(([True], names[order[1:]] != names[order[:-1]])))
        total = np.add.reduceat(n[order], first)
        known = np.empty(len(names), np.int64)
        known[order] = np.repeat(total, np.diff(np.append(first, len(names))))
        ends = np.cumsum(sizes).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(t.column("chunk").to_pylist(), pa.int64()),
                pa.array(t.column("bucket").to_pylist(), pa.int32()),
                pa.array([pack_numbers(known[e - s : e]) for s, e in zip(sizes, ends, strict=True)], pa.binary()),
            ],
            ["chunk", "bucket", "counts"],
        )


def _score(order: int, bits: int, total: int, backoff: float, least: int):
    def score(batches):
        for batch in batches:
            answers = batch.column(batch.schema.get_field_index("answers"))
            for i in range(batch.num_rows):
                keys, ends, data = read_chunk(batch, i)
                words, counts = word_hashes(data, ends)
                grams = ngrams(words, counts, order, bits)
                _, at = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
                answer = sorted((a["bucket"], a["counts"]) for a in answers[i].as_py() or [])
                known = np.concatenate([unpack_numbers(x) for _, x in answer] or [np.zeros(0, np.int64)])[at]
                logs = np.zeros(len(words))
                before = np.zeros(len(words), np.int64)
                done = 0
                for n, (g, places) in enumerate(grams, 1):
                    c = known[done : done + len(g)]
                    done += len(g)
                    here = np.zeros(len(words), np.int64)
                    here[places] = c
                    if n == 1:
                        logs = np.log10(c / total) if len(c) else logs
                    else:
                        seen = c >= least
                        logs[places] += math.log10(backoff)
                        logs[places[seen]] = np.log10(c[seen] / before[places[seen] - 1])
                    before = here
                of = np.repeat(np.arange(len(counts)), counts)
                sums = np.bincount(of, weights=logs, minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=keys == LAST), pa.array(counts), pa.array(np.round(sums, 4) + 0.0)], ["doc_id", "n_words", "log10_score"]
                )

    return score


def backoff_scores(
    docs: DataFrame,
    order: int = ORDER,
    backoff: float = BACKOFF,
    least_count: int = LEAST_COUNT,
    chunk_bytes: int = CHUNK,
    bucket_bytes: int = BUCKET,
) -> DataFrame:
    """doc_id, n_words, log10_score: a row for each row of docs.

    The score is the sum over a document's words of log10 of count(n-gram) /
    count(its first words) for the longest n-gram that ends there, if it occurs
    least_count times, else of backoff times the same for one word fewer, down
    to count(word) / all words; to 4 decimals. Null texts and texts without words
    score 0. Repeated rows are documents of their own and count as often as they
    stand. An empty table gives no rows. Other columns are not looked at.
    """
    n_tasks = n_partitions(docs)
    packed = bucketed(chunks(docs, chunk_bytes, count_words=True), "chunk", "lm_chunks", n_tasks)
    size = packed.agg(F.sum("size").alias("n"), F.sum("words").alias("words")).first()
    total, bucket_bits = size["words"] or 0, max(0, (max(1, (size["n"] or 0) // bucket_bytes) - 1).bit_length())
    bits = min(64, 24 + int(total).bit_length())
    cols = ["chunk", "keys", "ends", "data"]
    sent = map_batches(packed.select(*cols), _send(order, bits, bucket_bits), "bucket int, chunk long, names binary, counts binary")
    answers = map_batches(sent.repartitionById(n_tasks, "bucket").sortWithinPartitions("bucket"), _count, "chunk long, bucket int, counts binary")
    answers = answers.repartition(n_tasks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    told = packed.select(*cols).hint("merge").join(answers, "chunk", "left")
    return map_batches(told, _score(order, bits, total, backoff, least_count), "doc_id long, n_words long, log10_score double")
