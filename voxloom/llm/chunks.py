"""Documents packed into chunks, one row each, and sorted numbers packed into bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, words_of

#: Stands for a null id: no document comes after it.
LAST = (1 << 63) - 1


def pack_sorted(names: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, byte plane by byte plane."""
    steps = np.diff(names, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_numbers(x: np.ndarray) -> bytes:
    """Small numbers, compressed byte plane by byte plane."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def chunks(docs: DataFrame, chunk_bytes: int, count_words: bool = False) -> DataFrame:
    """chunk, keys, ends, data, size, words: documents packed in order of arrival.

    Texts are compressed, ids and text ends int64, size is the texts' bytes and
    words their number of words, if count_words asks for it. Read it only from
    where it was written: a chunk's number means nothing for another run.
    """

    def pack(batches):
        from pyspark import TaskContext

        part, number, z = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        keys: list[int] = []
        texts: list[bytes] = []
        size = words = 0

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number], pa.int64()),
                    pa.array([np.array(keys, np.int64).tobytes()], pa.binary()),
                    pa.array([np.cumsum([len(t) for t in texts], dtype=np.int64).tobytes()], pa.binary()),
                    pa.array([z.compress(b"".join(texts))], pa.binary()),
                    pa.array([size], pa.int64()),
                    pa.array([words], pa.int64()),
                ],
                ["chunk", "keys", "ends", "data", "size", "words"],
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, some in slices(batch, limit=chunk_bytes):
                for i, text in enumerate(some):
                    keys.append(ids[at + i])
                    texts.append(text)
                    size += len(text)
                    words += len(words_of(text)) if count_words else 0
                    if size >= chunk_bytes:
                        yield row()
                        keys, texts, size, words, number = [], [], 0, 0, number + 1
        if keys:
            yield row()

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key")
    return map_batches(docs.select(key, "text"), pack, "chunk long, keys binary, ends binary, data binary, size long, words long")


def read_chunk(batch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, ends, data = (batch.column(batch.schema.get_field_index(k))[i].as_py() for k in ("keys", "ends", "data"))
    return np.frombuffer(keys, np.int64), np.frombuffer(ends, np.int64), np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
