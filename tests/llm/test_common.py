import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.llm import common as C


def test_lookup_with_hot_keys_nulls_and_missing_ones(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(3000)] + [(-1, None), (-2, "unknown")], "i long, k string")
    found = rows.where("k <> 'unknown'").groupBy("k").agg(F.count("*").alias("n"), F.upper(F.first("k")).alias("up"))
    out = {r["i"]: r["_found"] and r["_found"]["up"] for r in C.lookup(rows, "k", found, "n").collect()}
    assert len(out) == 3002
    assert all(out[i] == ("HOT" if i % 2 else f"K{i}") for i in range(3000))
    assert out[-1] is None and out[-2] is None


@pytest.mark.parametrize("ids", [[], [1, 5, None], list(range(0, 5000, 3))])
def test_bitmap_never_misses(spark, ids):
    rows = spark.createDataFrame([(i,) for i in range(5000)] + [(None,)], "id long")
    maybe = {r["id"]: r["_maybe"] for r in C.by_bitmap(rows, "id", spark.createDataFrame([(i,) for i in ids], "x long")).collect()}
    assert len(maybe) == 5001
    assert all(maybe[i] for i in ids)
    assert sum(maybe.values()) <= len(ids) + 10


def test_groups_over_batches():
    batches = [pa.RecordBatch.from_pydict({"k": k, "v": v}) for k, v in [(["a", "a", "b"], [1, 2, 3]), (["b"], [4]), (["b", "c"], [5, 6])]]
    assert [t.column("v").to_pylist() for t in C.groups(iter(batches), "k")] == [[1, 2], [3, 4, 5], [6]]
    assert list(C.groups(iter([]), "k")) == []


def test_slices_of_long_and_null_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "é" * 50, "", "b"]})
    assert [(a, t) for a, t in C.slices(batch, limit=12)] == [(0, [b"a" * 10, b""]), (2, ["é".encode() * 50]), (3, [b"", b"b"])]


def test_fresh_names():
    assert C.fresh(["A", "b", "b_"], "a", "B", "c") == ["a_", "B__", "c"]


def test_words():
    assert C.words_of("It's ÉTÉ—42 a_b\x00c".encode()) == [b"it", b"s", "ÉtÉ—42".encode(), b"a", b"b", b"c"]


def test_intermediates_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "shared_dir", lambda s: f"file://{tmp_path}")
    assert C.materialize(spark.range(5), "x").count() == C.bucketed(spark.range(5), "id", "y", 3).count() == 5
    C.drop_intermediates(spark)
    assert not (tmp_path / "voxloom").exists()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("voxloom_")]


def test_own_folder_where_none_is_set():
    class Context:
        applicationId = "app"
        master = "local[2]"
        made = None

        def setCheckpointDir(self, path):
            self.made = path

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: None)

    one, two = C.shared_dir(Session), C.shared_dir(Session)
    assert one == two == Session.sparkContext.made and one.startswith("file://")
    Session.sparkContext.master = "spark://elsewhere:7077"
    with pytest.raises(ValueError, match="share"):
        C.shared_dir(Session)


def test_partitions_follow_stored_bytes(spark, tmp_path, monkeypatch):
    spark.range(100_000).selectExpr("id", "uuid() t").write.parquet(f"{tmp_path}/t")
    df, least = spark.read.parquet(f"{tmp_path}/t"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert C.n_partitions(df) == C.n_partitions(spark.createDataFrame([(1, "x")], "id long, t string").repartition(2)) == least
    monkeypatch.setattr(C, "PARTITION_BYTES", 100_000)
    stored = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert C.n_partitions(df) == -(-stored // 100_000) > least


def test_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    df = spark.range(60, numPartitions=1).selectExpr("repeat('x', 500000) t")
    found = [r["n"] for r in C.map_batches(df, sizes, "n long").collect()]
    assert len(found) >= 7 and max(found) <= C.BATCH_BYTES + 600_000


def test_what_is_written_within_is_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "shared_dir", lambda s: f"file://{tmp_path}")
    kept = C.materialize(spark.range(7), "kept")
    with C.temporary(spark):
        C.materialize(spark.range(5), "x")
        C.bucketed(spark.range(5), "id", "y", 2)
        assert len(list((tmp_path / "voxloom").iterdir())) == 3
    assert kept.count() == 7 and len(list((tmp_path / "voxloom").iterdir())) == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("voxloom_y")]
