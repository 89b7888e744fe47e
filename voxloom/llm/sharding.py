"""Sharding by fixed virtual slots.

Every record is hashed into one of `n_slots` virtual slots, for good: by id and
text, so that many rows of one id or none don't fill one slot. Bytes are
added up per slot, a map deals the slots out to shards, and the map is stored as
numbered versions in the shared folder. Rebalancing edits the map; records never
change their slot. Only `n_slots` numbers ever reach the driver.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, shared_path

N_SLOTS = 4096
ROWS_PER_BUCKET = 50_000


def slot_of(doc_id, text, n_slots: int = N_SLOTS):
    """The virtual slot of a record, by its id and text; records without an id are spread by their place in the input, too."""
    place = F.when(doc_id.isNull(), F.monotonically_increasing_id())
    return F.pmod(F.xxhash64(doc_id.cast("string"), text, place), F.lit(n_slots)).cast("int")


def record_size(text):
    """UTF-8 bytes plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_weights(records: DataFrame) -> dict[int, int]:
    """Bytes of each slot in use: at most n_slots numbers."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect()
    return {r["virtual_slot"]: r["b"] for r in rows}


def deal(weights: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """A first map: the heaviest slot next to the lightest shard; slots without bytes go round-robin."""
    shards = [(0, s) for s in range(n_shards)]
    out = [slot % n_shards for slot in range(n_slots)]
    for slot in sorted(weights, key=lambda k: (-weights[k], k)):
        load, shard = heapq.heappop(shards)
        out[slot] = shard
        heapq.heappush(shards, (load + weights[slot], shard))
    return out


def rebalance(slot_map: list[int], weights: dict[int, int], n_shards: int, tolerance: float = 0.02) -> list[int]:
    """An edited map for n_shards: slots of shards that are gone and slots above the mean move, all others stay.

    With one more shard, slots move only into it. Slots are taken from the
    heaviest shard, largest first that still fits, until every shard is within
    the tolerance of the mean or no move helps.
    """
    out = list(slot_map)
    load = [0] * n_shards
    held: list[list[int]] = [[] for _ in range(n_shards)]
    homeless = []
    for slot, shard in enumerate(out):
        if shard >= n_shards:
            homeless.append(slot)
        else:
            load[shard] += weights.get(slot, 0)
            held[shard].append(slot)
    for slot in sorted(homeless, key=lambda k: (-weights.get(k, 0), k)):
        to = min(range(n_shards), key=lambda s: (load[s], s))
        out[slot] = to
        load[to] += weights.get(slot, 0)
        held[to].append(slot)
    mean = sum(load) / n_shards
    grown = set(range(n_shards)) - {s for s in slot_map if s < n_shards}
    for s in held:
        s.sort(key=lambda k: (weights.get(k, 0), k))
    for _ in range(len(out)):
        frm = max(range(n_shards), key=lambda s: (load[s], -s))
        to = min(grown or range(n_shards), key=lambda s: (load[s], s))
        if load[frm] <= mean * (1 + tolerance) and load[to] >= mean * (1 - tolerance):
            break
        room = min(load[frm] - load[to], mean - load[to] + tolerance * mean)
        fits = [k for k in held[frm] if 0 < weights.get(k, 0) < room]
        if not fits:
            break
        slot = fits[-1]
        held[frm].remove(slot)
        held[to].append(slot)
        out[slot] = to
        load[frm] -= weights[slot]
        load[to] += weights[slot]
    return out


class SlotMaps:
    """Numbered versions of a slot map in one folder of any store that Spark writes."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root or shared_path(spark, "slot-map")

    def write(self, version: int, slot_map: list[int]) -> None:
        text = json.dumps([{"slot": k, "shard": v} for k, v in enumerate(slot_map)])
        rows = self.spark.range(1, numPartitions=1).select(
            F.explode(F.from_json(F.lit(text), "array<struct<slot:int,shard:int>>")).alias("x")
        )
        rows.select("x.slot", "x.shard").write.parquet(f"{self.root}/version={version}")

    def read(self, version: int) -> DataFrame:
        """slot and shard: n_slots rows, whatever the records."""
        return self.spark.read.schema("slot int, shard int").parquet(f"{self.root}/version={version}")

    def as_list(self, version: int) -> list[int]:
        return [r["shard"] for r in self.read(version).orderBy("slot").collect()]

    def latest(self) -> int:
        """The largest version that was written to its end; 0 if there is none."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.root)
        store = path.getFileSystem(context._jsc.hadoopConfiguration())
        if not store.exists(path):
            return 0
        names = [f.getPath() for f in store.listStatus(path) if f.getPath().getName().startswith("version=")]
        done = [p for p in names if store.exists(context._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return max((int(p.getName().partition("=")[2]) for p in done), default=0)

    def next(self, weights: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> int:
        """Writes the next version and returns its number: the latest one rebalanced, or a first map."""
        last = self.latest()
        if last:
            old = self.as_list(last)
            if len(old) != n_slots:
                raise ValueError(f"the stored map has {len(old)} slots, not {n_slots}")
            self.write(last + 1, rebalance(old, weights, n_shards))
        else:
            self.write(1, deal(weights, n_shards, n_slots))
        return last + 1


def assign(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, maps: SlotMaps | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version: a row for each row of docs.

    `slot` is the record's place in its shard: 0, 1, 2, ... in order of bucket,
    doc_id, size and checksum. Law: bytes, which holds for groups of equal texts
    of any size: copies under different ids are records of their own, spread over
    all shards and not kept together. Rows of one id and one text share a slot, and
    each has a place of its own. A null text counts as empty, rows without an id
    are spread, and which of equal ones lies where follows the input's files; an
    empty table gives no rows; other columns of docs are not looked at. If maps has
    a version already, it is rebalanced and written as the next.
    """
    spark = docs.sparkSession
    text = F.col("text")
    records = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            record_size(text).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            slot_of(F.col("doc_id"), text, n_slots).alias("virtual_slot"),
        ),
        "slotted",
    )
    maps = maps or SlotMaps(spark)
    version = maps.next(slot_weights(records), n_shards, n_slots)
    n = records.count()
    n_buckets = max(8, -(-n // (n_shards * ROWS_PER_BUCKET)))
    placed = records.join(
        F.broadcast(maps.read(version).withColumnRenamed("slot", "virtual_slot")), "virtual_slot"
    ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "virtual_slot"), F.lit(n_buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select(
        "shard",
        "bucket",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    return (
        placed.withColumn("nth", F.row_number().over(own))
        .join(before, ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(version).alias("map_version"),
        )
    )


def with_shards(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, maps: SlotMaps | None = None) -> DataFrame:
    """docs with `shard` and `virtual_slot`; the rows themselves, not joined by id, so repeated and null ids are safe.

    Columns of docs with these names (in any case) are replaced. If maps has a
    version already, it is rebalanced and written as the next.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c.lower() not in ("shard", "virtual_slot")]
    own = slot_of(F.col("doc_id"), F.col("text"), n_slots).alias("virtual_slot")
    slotted = docs.select(*keep, own)
    maps = maps or SlotMaps(spark)
    sizes = docs.select(own, record_size(F.col("text")).alias("size"))
    version = maps.next(slot_weights(sizes), n_shards, n_slots)
    slot_map = maps.read(version).withColumnRenamed("slot", "virtual_slot")
    return slotted.join(F.broadcast(slot_map), "virtual_slot").select(*keep, "shard", "virtual_slot")
