"""Near-duplicate embeddings by an inverted multi-index.

The two halves of a unit vector have codebooks of their own; their product is a
grid of cells, and every vector lies in one. A vector visits the cells whose
summed distance to it is least, in that order, as many as the target recall
needs: that number is measured on pairs that are exactly as similar as the
limit. A pair is met if either of the two visits the other's cell. What is met
is verified by cosine in double precision. Cells are cut into blocks, so no task
holds more than two of them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import groups, lookup, map_batches, materialize
from .graph import components, forest

SIMILARITY = 0.9
RECALL = 0.98
#: The codebooks are fitted on so many vectors at most; every vector is indexed.
FIT_ROWS = 8192
#: Vectors that a cell holds on average, as far as MOST_CODES allows it.
CELL_ROWS = 1024
MOST_CODES = 1024
MEMBER_BLOCK, VISITOR_BLOCK = 2048, 16384
ROUNDS = 12


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square over- or underflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (codes * codes).sum(1)[None] - 2 * x @ codes.T, 0)


def codebook(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """n centres by Lloyd's rounds; an empty one moves to the point that is farthest from its own."""
    rng = np.random.default_rng(seed)
    n = max(1, min(n, len(x)))
    codes = x[rng.choice(len(x), n, replace=False)].copy()
    for _ in range(ROUNDS):
        d = _distances(x, codes)
        own = d.argmin(1)
        far = np.argsort(-d[np.arange(len(x)), own], kind="stable")
        for j in range(n):
            codes[j] = x[own == j].mean(0) if (own == j).any() else x[far[j % len(x)]]
    return codes


class MultiIndex:
    """Codebooks of the two halves and the number of cells to visit, for vectors of one length."""

    def __init__(self, sample: np.ndarray, n_codes: int, similarity: float, recall: float, seed: int = 3):
        self.half = sample.shape[1] // 2
        self.codes = [codebook(part, n_codes, seed + i) for i, part in enumerate(self._halves(sample))]
        self.visits = 1
        self.visits = self._visits_for(sample[:1000], similarity, recall, seed)

    def _halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.half], x[:, self.half :]]

    def order(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The first cells of each vector's multi-sequence: (n, visits) numbers of cells by rising distance.

        The (i + 1)(j + 1) - 1 combinations of nearer codes all come before that
        of the i-th and j-th nearest, so the first `visits` are among those with
        (i + 1)(j + 1) <= visits.
        """
        near, dist = [], []
        for part, codes in zip(self._halves(x), self.codes, strict=True):
            d = _distances(part, codes)
            by = np.argsort(d, axis=1, kind="stable")[:, :visits]
            near.append(by)
            dist.append(np.take_along_axis(d, by, axis=1))
        a, b = near[0].shape[1], near[1].shape[1]
        i, j = np.array([(i, j) for i in range(a) for j in range(min(b, visits // (i + 1)))], np.int64).T
        total = dist[0][:, i] + dist[1][:, j]
        first = np.argsort(total, axis=1, kind="stable")[:, :visits]
        return near[0][np.arange(len(x))[:, None], i[first]] * len(self.codes[1]) + near[1][np.arange(len(x))[:, None], j[first]]

    def _visits_for(self, sample: np.ndarray, similarity: float, recall: float, seed: int) -> int:
        """Least number of cells with which a pair exactly as similar as the limit is met with the wanted probability."""
        cells = len(self.codes[0]) * len(self.codes[1])
        if cells == 1 or sample.shape[1] < 2:
            return cells
        noise = np.random.default_rng(seed).standard_normal(sample.shape)
        noise = unit(noise - (noise * sample).sum(1, keepdims=True) * sample)
        other = similarity * sample + math.sqrt(1 - similarity**2) * noise
        visits = 1
        while True:
            one, two = self.order(sample, visits), self.order(other, visits)
            met = (one == two[:, :1]).any(1) | (two == one[:, :1]).any(1)
            if visits >= cells or met.mean() >= recall:
                return min(visits, cells)
            visits = max(visits + 1, visits * 5 // 4)


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id, node, vec: node names equal vectors; null for those that link with nothing."""
    kind = "float" if rows.schema["embedding"].dataType == T.ArrayType(T.FloatType(), rows.schema["embedding"].dataType.containsNull) else "double"

    def pack(batches):
        for batch in batches:
            column = batch.column(1)
            lists = column.to_pylist() if column.null_count or column.flatten().null_count else None
            nodes, vecs = [], []
            if lists is None:
                flat, ends = column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy())
                lists = np.split(flat, ends[:-1])
            for x in lists:
                if x is not None and len(x) and not any(v is None for v in x):
                    x = np.asarray(x, np.float32 if kind == "float" else np.float64) + 0
                    if np.isfinite(x).all() and x.any():
                        vecs.append(x.astype(np.float64).tobytes() if kind == "double" else x.tobytes())
                        nodes.append(hashlib.blake2b(vecs[-1], digest_size=16).digest())
                        continue
                nodes.append(None)
                vecs.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "node", "vec"])

    picked = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return map_batches(picked, pack, "vec_id long, node binary, vec binary").withColumn("width", F.lit(4 if kind == "float" else 8))


def _matrix(column, width: int) -> np.ndarray:
    """Vectors of one length as rows."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.float32 if width == 4 else np.float64)
    return x.reshape(len(column), -1) if len(column) else x.reshape(0, 1)


def fit(nodes: DataFrame, width: int, similarity: float = SIMILARITY, recall: float = RECALL) -> dict[int, MultiIndex]:
    """An index for each length of vector in a sample of FIT_ROWS vectors, chosen by hash."""
    picked = nodes.select("node", "vec").orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).collect()
    by: dict[int, list[bytes]] = {}
    for r in picked:
        by.setdefault(len(r["vec"]), []).append(bytes(r["vec"]))
    counts = nodes.count()
    out = {}
    for size, own in by.items():
        sample = unit(np.frombuffer(b"".join(own), np.float32 if width == 4 else np.float64).reshape(len(own), -1))
        expected = counts * len(own) / len(picked)
        n_codes = max(1, min(MOST_CODES, round(math.sqrt(expected / CELL_ROWS)), len(own) // 8))
        out[size] = MultiIndex(sample, n_codes, similarity, recall)
    return out


def _placer(index: dict[int, MultiIndex], width: int):
    """cell and visits of each node; a length that the sample missed is one cell."""

    def place(batches):
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy()
            cells: list[int] = [0] * batch.num_rows
            visits: list[list[int]] = [[]] * batch.num_rows
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                if size in index:
                    x = unit(_matrix(batch.column(1).take(pa.array(at)), width))
                    order = index[size].order(x, index[size].visits) + (size << 32)
                else:
                    order = np.full((len(at), 1), size << 32)
                for i, row in zip(at.tolist(), order.tolist(), strict=True):
                    cells[i], visits[i] = row[0], row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int64()), pa.array(visits, pa.list_(pa.int64()))], [*batch.schema.names, "cell", "visits"]
            )

    return place


def _verifier(similarity: float, width: int):
    """Links between the members and the visitors of a cell's blocks; a pair that both ways meet counts once."""

    def verify(batches):
        for t in groups(batches, "task"):
            visitor = t.column("visitor").to_numpy(zero_copy_only=False)
            rows = [np.flatnonzero(~visitor), np.flatnonzero(visitor)]
            if not len(rows[0]) or not len(rows[1]):
                continue
            parts = [t.take(pa.array(r)) for r in rows]
            nodes = [p.column("node").to_pylist() for p in parts]
            x = [unit(_matrix(p.column("vec").combine_chunks(), width)) for p in parts]
            copies = [p.column("copies").to_numpy() for p in parts]
            names = sorted({*nodes[0], *nodes[1]})
            number = {name: i for i, name in enumerate(names)}
            ids = [np.array([number[n] for n in own]) for own in nodes]
            cells = parts[1].column("cell").to_numpy()
            visited = parts[0].column("visits").to_pylist()
            most = max(map(len, visited))
            visited = np.array([v + [-1] * (most - len(v)) for v in visited], np.int64)
            links = np.zeros(len(names), np.int64)
            pairs = []
            for a in range(0, len(ids[1]), 1024):
                here = slice(a, a + 1024)
                i, j = np.nonzero(x[1][here] @ x[0].T >= similarity)
                i += a
                once = ids[1][i] != ids[0][j]
                both = np.zeros(len(i), bool)
                for k in range(most):
                    both |= visited[j, k] == cells[i]
                once &= ~both | (ids[1][i] < ids[0][j])
                i, j = i[once], j[once]
                np.add.at(links, ids[1][i], copies[0][j])
                np.add.at(links, ids[0][j], copies[1][i])
                pairs += zip(ids[1][i].tolist(), ids[0][j].tolist(), strict=True)
                if len(pairs) > 200_000:
                    pairs = [(n, r) for n, r in enumerate(forest(len(names), pairs)) if n != r]
            root = forest(len(names), pairs)
            some = [n for n in range(len(names)) if links[n]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[n] for n in some], pa.binary()), pa.array(links[some]), pa.array([names[root[n]] for n in some], pa.binary())],
                ["node", "links", "root"],
            )

    return verify


def near_vectors(rows: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row of rows.

    n_links counts the other rows with a cosine of `similarity` or more that the
    index meets, equal vectors included; component_id is the smallest vec_id
    reachable; kept is true for the row of that id. A vector that is null, empty
    or zero or holds a null, NaN or infinity links with nothing; vectors of
    different lengths don't link. Rows without an id are in components as all
    others; a component of such rows alone has component_id null. An empty table
    gives no rows. Other columns are not looked at.
    """
    packed = materialize(vectors(rows), "vectors")
    first = packed.select("width").first()
    width = first["width"] if first else 4
    nodes = materialize(
        packed.where("node is not null")
        .groupBy("node")
        .agg(F.min("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")),
        "vector-nodes",
    )
    index = fit(nodes, width, similarity, recall)
    kinds = "node binary, vec binary, copies long, cell long, visits array<long>"
    placed = map_batches(nodes.select("node", "vec", "copies"), _placer(index, width), kinds)
    placed = materialize(placed, "placed")
    members = placed.groupBy("cell").agg(F.ceil(F.count("*") / MEMBER_BLOCK).alias("n_members"))
    visitors = placed.select(F.explode("visits").alias("to")).groupBy("to").agg(F.ceil(F.count("*") / VISITOR_BLOCK).alias("n_visitors"))
    sizes = materialize(members.join(visitors, F.col("cell") == F.col("to")).select("to", "n_members", "n_visitors"), "cells")

    def block(n: str, salt: int):
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")

    def all_of(n: str):
        return F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))

    keep = ["node", "vec", "copies", "cell"]
    none = F.lit(None).cast("array<long>").alias("visits")
    held = placed.join(sizes, F.col("cell") == F.col("to")).withColumn("m", block("n_members", 1)).withColumn("v", all_of("n_visitors"))
    come = placed.select(*keep, F.explode("visits").alias("at")).join(sizes, F.col("at") == F.col("to"))
    come = come.withColumn("m", all_of("n_members")).withColumn("v", block("n_visitors", 2))
    task = F.format_string("%d:%d:%d", "to", "m", "v").alias("task")
    tasks = held.select(task, F.lit(False).alias("visitor"), *keep, "visits").unionByName(
        come.select(task, F.lit(True).alias("visitor"), *keep, none)
    )
    tasks = tasks.repartition("task").sortWithinPartitions("task")
    verified = materialize(map_batches(tasks, _verifier(similarity, width), "node binary, links long, root binary"), "vector-links")
    linked = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "copies", "first_id").join(linked, "node", "left").join(links, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    firsts = known.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    known = lookup(known, "component", firsts, "n").select(
        "node", "copies", "_found.component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    found = lookup(packed.select("vec_id", "node"), "node", materialize(known, "components"), "copies")
    component_id = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("_found.component_id"))
    return found.select(
        "vec_id",
        F.coalesce("_found.links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        component_id.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
