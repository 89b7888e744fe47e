"""What the operators of this package share: inputs, the shared folder, tables that cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.shipping import ship

#: Words of a text: runs of ASCII digits, lower-case letters and everything beyond ASCII.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Where it is unset, a folder of our own is made and becomes the checkpoint
    folder, but only for a local master: executors elsewhere couldn't reach it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="voxloom-")
            spark.sparkContext.setCheckpointDir(_OWN[app])
        found = _OWN[app]
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/voxloom/{name}-{uuid.uuid4().hex}"


#: What has been written within each `temporary` that is open: folders, and names of tables.
_MADE: list[list[tuple[str, str | None]]] = []


@contextlib.contextmanager
def temporary(spark: SparkSession):
    """Deletes at its end what the operators have written within; their results must have been written elsewhere by then."""
    _MADE.append([])
    try:
        yield
    finally:
        for path, table_name in _MADE.pop():
            if table_name:
                spark.sql(f"drop table if exists `{table_name}`")
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _made(path: str, table_name: str | None = None) -> str:
    if _MADE:
        _MADE[-1].append((path, table_name))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends there, lost executors cost nothing before it."""
    spark = df.sparkSession
    path = _made(shared_path(spark, name))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Stored bytes of an input for each partition of what is shuffled of it.
PARTITION_BYTES = 32 << 20


def n_partitions(df: DataFrame) -> int:
    """Shuffle partitions for what follows the size of an input: by its stored bytes, and the session's number at least."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return least if stored > UNKNOWN_BYTES else max(least, -(-stored // PARTITION_BYTES))


#: Inputs without statistics, such as local rows, count as larger than any table.
UNKNOWN_BYTES = 1 << 60


def bucketed(df: DataFrame, key: str, name: str, n: int) -> DataFrame:
    """df written to the shared folder as a table in n buckets of the key: joins on it move the other side only."""
    spark = df.sparkSession
    table_name = f"voxloom_{name}_{uuid.uuid4().hex}"
    df.write.option("path", _made(shared_path(spark, name), table_name)).bucketBy(n, key).saveAsTable(table_name)
    return spark.table(table_name)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names that none of the columns has, in any case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


#: Bytes of an Arrow batch, whose rows may be long; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) with small batches, in workers that give back what a task has held.

    Workers live on from task to task and two or more share an executor's memory
    with its JVM. Where the session doesn't bound the bytes of a batch itself,
    BATCH_BYTES is set: plans run later than they are made, so it stays set.
    """
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def trimmed(batches):
        yield from run(batches)
        release()

    return df.mapInArrow(trimmed, schema)


def release() -> None:
    """Gives unused memory back to the system, where the C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(name: str = "text"):
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def slices(batch, name: str = "text", limit: int = 4 << 20):
    """(first row, UTF-8 texts) of a record batch, in runs of about `limit` bytes; a longer text is a run of its own."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield at, [x or b"" for x in column.slice(at, to - at).to_pylist()]
        at = to


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


#: A key of more than this share of all rows is hot; there are at most 1 / share of them.
HOT_SHARE = 0.001


def lookup(rows: DataFrame, key: str, found: DataFrame, weight: str) -> DataFrame:
    """rows with `_found`: the struct of found's other columns for the row's key, or null.

    found has one row for each key and how many of rows hold it (`weight`). Keys
    of more than HOT_SHARE of the total go by broadcast, 1 / HOT_SHARE of them
    at most; all others by shuffle, where rows of hot keys and of none are spread
    at random.
    """
    fields = F.struct(*[c for c in found.columns if c not in (key, weight)])
    total = found.agg(F.sum(weight).alias("_total"))
    split = found.crossJoin(F.broadcast(total)).select(
        F.col(key).alias("_key"), fields.alias("_found"), (F.col(weight) > F.col("_total") * HOT_SHARE).alias("_is_hot")
    )
    hot = split.where("_is_hot").select(F.col("_key").alias("_hot_key"), F.col("_found").alias("_hot"), F.lit(True).alias("_is_hot"))
    cold = split.where("not _is_hot").select(F.col("_key").cast("string").alias("_cold_key"), F.col("_found").alias("_cold"))
    names = rows.columns
    seen = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    # a row of a hot key has a key of its own here: a mere second column would be folded into a condition
    spread = F.concat(F.lit("\u0000hot"), F.hex(F.xxhash64(*names)))
    seen = seen.withColumn("_own_key", F.when(F.col("_is_hot") | F.col(key).isNull(), spread).otherwise(F.col(key).cast("string")))
    both = seen.join(cold.hint("merge"), F.col("_own_key") == F.col("_cold_key"), "left")
    return both.select(*names, F.coalesce("_hot", "_cold").alias("_found"))


#: Bits of a bitmap of ids, whatever their number: 2 MB.
BITMAP_BITS = 1 << 24


def by_bitmap(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """rows with `_maybe`: false if the key surely isn't among ids (one column of the key's type).

    The bitmap is broadcast; its size is fixed. Many ids make it less telling,
    never wrong. A null key is a key like any other.
    """

    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS)) + 1

    own = ids.select(place(F.col(ids.columns[0])).alias("_place"))
    maps = own.groupBy(F.bitmap_bucket_number("_place").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")
    )
    seen = rows.withColumn("_place", place(F.col(key))).withColumn("_own_part", F.bitmap_bucket_number("_place"))
    both = seen.join(F.broadcast(maps), F.col("_own_part") == F.col("_part"), "left")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return both.select(*rows.columns, found.alias("_maybe"))


def groups(batches, key: str):
    """Tables of consecutive rows with one key, from batches that are sorted by it."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key))
        codes = pc.dictionary_encode(column).indices.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            now = column[a].as_py()
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def drop_intermediates(spark: SparkSession) -> None:
    """Deletes what the operators have written to the shared folder; results that weren't written yet can't be read afterwards."""
    for t in spark.catalog.listTables():
        if t.name.startswith("voxloom_"):
            spark.sql(f"drop table `{t.name}`")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/voxloom")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
