"""Jaccard join on word shingles by chosen paths.

Documents with equal shingle sets are one node. In each of RUNS runs every set
chooses each of its shingles with probability 1 / (similarity * size), which
puts it into a bucket for each one chosen; in buckets of more than SMALL sets
the choice is repeated among each set's shingles, DEPTH levels deep at most (only
sets in such buckets are read again). Two
sets of the wanted similarity share a child of a common bucket with expectation
1 at least, so all runs together meet them with the target recall. Buckets are
compared by brute force on sketches (large ones of the last level block by
block), which only groups nodes; within each group the sets themselves are
compared, all with all, block by block, so links are exact.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bitmap, groups, lookup, map_batches, materialize, slices, words_of
from .graph import components, forest, grown

WORDS = 5
SIMILARITY = 0.8
#: Of pairs whose common buckets are all large, so that they meet at the last level only.
RECALL = 0.9999
DEPTH = 3
SMALL = 3000
#: Shingles and nodes of a verification block; a larger set is a block of its own.
BLOCK_SHINGLES, BLOCK_NODES = 300_000, 500
BINS = 128
#: Sketches estimate a similarity with a standard deviation of sqrt(s (1 - s) / bins); pairs so many below the limit are left out.
DEVIATIONS = 4.5

_MUL = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs so that a pair whose paths all go `depth` levels deep is met with this probability.

    The number of common children is Poisson with mean 1 at least; a pair is
    met if that branching is alive at the last level.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of each text's shingles; a text of fewer words, but not none, is one shingle."""
    out = []
    digest = xxhash.xxh3_64_intdigest
    for text in texts:
        w = np.array(list(map(digest, words_of(text))), np.uint64)
        k = min(words, len(w))
        if not k:
            out.append(w)
            continue
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = h * _MUL + w[j : j + n]
        out.append(np.unique(mix64(h)))
    return out


def sketch(hashes: np.ndarray) -> bytes:
    """A byte of the smallest hash in each of BINS equal ranges, 0 for none."""
    out = np.zeros(BINS, np.uint8)
    if len(hashes):
        bins = (hashes >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        out[bins[first]] = 1 + mix64(hashes[first]) % np.uint64(255)
    return out.tobytes()


def chosen_paths(
    sets: list[np.ndarray], runs: int, similarity: float, depth: int, within: list[set[int]] | None = None
) -> list[list[list[int | None]]]:
    """For each set its paths: ids of the buckets that it is in at levels 1 to depth, null where nothing was chosen.

    With `within`, only those whose first bucket is among the set's own.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    limit = np.minimum(2.0**64 / (similarity * np.maximum(sizes, 1)), 2.0**64 - 2048).astype(np.uint64)
    salted = tokens * np.uint64(0xD6E8FEB86659FD93)
    out: list[list[list[int | None]]] = [[] for _ in sets]
    for run in range(runs):
        of = np.flatnonzero(sizes)
        paths = np.full((len(of), 1), run + 1, np.uint64)
        chains = np.zeros((len(of), 0), np.uint64)
        for level in range(depth):
            # in parts, so that what is held doesn't follow the number of paths
            kept_of, kept_chain, kept_path = [], [], []
            parts = np.split(np.arange(len(of)), np.searchsorted(np.cumsum(sizes[of]), np.arange(1 << 20, max(1, int(sizes[of].sum())), 1 << 20)))
            for rows in parts:
                if not len(rows):
                    continue
                n = sizes[of[rows]]
                owner = np.repeat(rows, n)
                pick = np.arange(n.sum()) + np.repeat(begins[of[rows]] - (np.cumsum(n) - n), n)
                seed = mix64(paths[:, 0] * _MUL + np.uint64(level))
                chance = mix64(salted[pick] ^ seed[owner])
                hit = np.flatnonzero(chance < limit[of[owner]])
                own = owner[hit]
                child = mix64(paths[own, 0] * np.uint64(0xC2B2AE3D27D4EB4F) ^ tokens[pick[hit]])
                if within is not None and not level:
                    wanted = [c in within[i] for i, c in zip(of[own].tolist(), child.view(np.int64).tolist(), strict=True)]
                    own, child = own[wanted], child[wanted]
                kept_of.append(of[own])
                kept_chain.append(np.concatenate((chains[own], child[:, None]), 1))
                kept_path.append(child)
                dead = np.setdiff1d(rows, own)
                if level:
                    for i in dead:
                        out[of[i]].append([int(x) for x in chains[i].astype(np.int64)] + [None] * (depth - level))
            if not kept_of:
                of = np.zeros(0, np.int64)
                break
            of, chains, paths = np.concatenate(kept_of), np.concatenate(kept_chain), np.concatenate(kept_path)[:, None]
        for i, chain in zip(of.tolist(), chains.astype(np.int64).tolist(), strict=True):
            out[i].append(chain)
    return out


def node_of(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, node, size, sketch, buckets (of level 1): a row for each row of docs; node is null for a text without words."""
    runs = runs_for(recall)

    def sign(batches):
        for batch in batches:
            for at, texts in slices(batch, limit=1 << 20):
                sets = shingle_sets(texts, words)
                paths = chosen_paths(sets, runs, similarity, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([sketch(s) for s in sets], pa.binary()),
                        pa.array([sorted({p[0] for p in own}) for own in paths], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "node", "size", "sketch", "buckets"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, sign, "doc_id long, node binary, size long, sketch binary, buckets array<long>")


def _deeper(docs: DataFrame, marked: DataFrame, words: int, similarity: float, recall: float) -> DataFrame:
    """node, paths: the paths of nodes (marked: node, first_id, large) whose first bucket is among the large ones, from their texts."""
    runs = runs_for(recall)

    def deepen(batches):
        for batch in batches:
            for at, texts in slices(batch, limit=1 << 20):
                wanted, large = (batch.column(k).slice(at, len(texts)).to_pylist() for k in (0, 1))
                sets = shingle_sets(texts, words)
                own = [i for i, s in enumerate(sets) if node_of(s) == wanted[i]]
                paths = chosen_paths([sets[i] for i in own], runs, similarity, DEPTH, [set(large[i]) for i in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([wanted[i] for i in own], pa.binary()), pa.array(paths, pa.list_(pa.list_(pa.int64())))], ["node", "paths"]
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    texts = by_bitmap(texts, "id", marked.select("first_id")).where("_maybe")
    rows = marked.hint("merge").join(texts, marked["first_id"].eqNullSafe(texts["id"])).select("node", "large", "text")
    return map_batches(rows, deepen, "node binary, paths array<array<long>>")


def _similar(sketches: np.ndarray, sizes: np.ndarray, i: int, others: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the others may be as similar to i as wanted, by sketch and size."""
    fits = np.minimum(sizes[others], sizes[i]) >= similarity * np.maximum(sizes[others], sizes[i])
    others = others[fits]
    a, b = sketches[i], sketches[others]
    filled = ((a != 0) | (b != 0)).sum(1)
    same = ((a == b) & (a != 0)).sum(1)
    slack = DEVIATIONS * np.sqrt(similarity * (1 - similarity) / np.maximum(filled, 1))
    return others[same >= (similarity - slack) * filled]


def _bucket_edges(similarity: float):
    def compare(batches):
        for t in groups(batches, "task"):
            seen = t.num_rows
            nodes = t.column("node").to_pylist()
            order = sorted(range(seen), key=nodes.__getitem__)
            order = [k for n, k in enumerate(order) if not n or nodes[k] != nodes[order[n - 1]]]
            nodes = [nodes[k] for k in order]
            if len(nodes) < 2:
                continue
            sketches = np.frombuffer(b"".join(t.column("sketch").take(pa.array(order)).to_pylist()), np.uint8).reshape(-1, BINS)
            sizes = t.column("size").take(pa.array(order)).to_numpy()
            label = np.arange(len(nodes))
            for i in range(len(nodes) - 1):
                others = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
                hits = _similar(sketches, sizes, i, others, similarity)
                if len(hits):
                    grown(label, i, hits)
            a = np.flatnonzero(label != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[i] for i in a], pa.binary()), pa.array([nodes[r] for r in label[a]], pa.binary())], ["a", "b"]
            )

    return compare


def _in_blocks(rows: DataFrame, key, n_blocks):
    """rows once for each pair of blocks that they take part in, with `task` and the pair."""
    own = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int")))
    pairs = rows.withColumn("own", own).withColumn("other", other)
    pairs = pairs.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    return pairs.withColumn("task", F.concat(key.cast("binary"), F.encode(F.format_string(":%d:%d", "lo", "hi"), "utf-8")))


def _counted(here: DataFrame) -> DataFrame:
    """here (node, bucket) with n, the bucket's number of nodes, of two at least; hot buckets are looked up by broadcast."""
    counts = materialize(here.groupBy("bucket").agg(F.count("*").alias("weight")).where("weight > 1"), "buckets")
    told = lookup(here, "bucket", counts.withColumn("n", F.col("weight")), "weight").where("_found is not null")
    return materialize(told.select("node", "bucket", "_found.n"), "members")


def candidate_groups(
    docs: DataFrame, nodes: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, small: int = SMALL
) -> DataFrame:
    """node, component: nodes that sketches in common buckets put into one group, of two nodes at least."""
    told = _counted(nodes.select("node", F.explode("buckets").alias("bucket")))
    members, large = told.where(F.col("n") <= small), told.where(F.col("n") > small)
    if large.head(1):
        marked = large.groupBy("node").agg(F.collect_set("bucket").alias("large")).hint("merge").join(nodes.select("node", "first_id"), "node")
        paths = _deeper(docs, materialize(marked, "in-large-buckets"), words, similarity, recall)
        paths = materialize(paths.select("node", F.explode("paths").alias("p")).select("node", F.col("p")[1].alias("second"), F.col("p")[2].alias("third")), "paths")
        told = _counted(paths.select("node", F.col("second").alias("bucket")).where("bucket is not null").distinct())
        above = told.where(F.col("n") > small).select("node", F.col("bucket").alias("second"))
        last = paths.join(above.hint("merge"), ["node", "second"], "left_semi").select("node", F.col("third").alias("bucket"))
        members = members.unionByName(told.where(F.col("n") <= small)).unionByName(_counted(last.where("bucket is not null").distinct()))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / small))
    tasks = _in_blocks(members, F.col("bucket").cast("string"), n_blocks).select("node", "task")
    tasks = tasks.hint("merge").join(nodes.select("node", "size", "sketch"), "node")
    edges = map_batches(tasks.repartition("task").sortWithinPartitions("task"), _bucket_edges(similarity), "a binary, b binary")
    return components(edges)


def _exact(words: int, similarity: float):
    """Links of each node with the nodes of the other block (or its own), weighted by their copies, and a forest of the links."""

    def verify(batches):
        for t in groups(batches, "task"):
            by_node: dict[bytes, tuple[np.ndarray, int, int]] = {}
            copies, block = t.column("copies").to_pylist(), t.column("own").to_pylist()
            wanted, texts = t.column("node").to_pylist(), t.column("text").to_pylist()
            for i, s in enumerate(shingle_sets([x or b"" for x in texts], words)):
                if wanted[i] not in by_node and node_of(s) == wanted[i]:
                    by_node[wanted[i]] = (s, copies[i], block[i])
            nodes = sorted(by_node)
            if len(nodes) < 2:
                continue
            sets = [by_node[x][0] for x in nodes]
            n_copies = np.array([by_node[x][1] for x in nodes], np.int64)
            side = np.array([by_node[x][2] for x in nodes])
            one = t.column("lo")[0].as_py() == t.column("hi")[0].as_py()
            sizes = np.array([len(s) for s in sets], np.int64)
            common = _common(sets)
            linked = common >= similarity * (sizes[:, None] + sizes[None] - common) - 1e-9
            np.fill_diagonal(linked, False)
            if not one:
                linked &= side[:, None] != side[None]
            links = linked @ n_copies
            root = forest(len(nodes), zip(*map(np.ndarray.tolist, np.nonzero(np.triu(linked))), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(links.astype(np.int64)), pa.array([nodes[r] for r in root], pa.binary())],
                ["node", "links", "root"],
            )

    return verify


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over the hashes of two sets at least."""
    n = len(sets)
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = counts[at] > 1
    of, at = of[shared], at[shared]
    _, at = np.unique(at, return_inverse=True)
    out = np.zeros((n, n), np.int64)
    width, order = 4096, np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    for start in range(0, int(at.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(at, [start, start + width])
        part = np.zeros((n, width), np.float32)
        part[of[a:b], at[a:b] - start] = 1
        out += (part @ part.T).astype(np.int64)
    out[np.diag_indices(n)] = [len(s) for s in sets]
    return out


def classes(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    small: int = SMALL,
    block_shingles: int = BLOCK_SHINGLES,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """doc_id, class_id, n_links, kept: a row for each row of docs.

    n_links counts the other rows whose Jaccard similarity is as wanted, copies
    included; class_id is the smallest doc_id reachable by links; kept is true
    for the document of that id. Texts without words (null, empty, only
    separators) link with nothing. Rows without an id are in classes as all
    others; a class of such rows alone has class_id null, and all of them are
    kept. Repeated rows are copies of each other and all of one id are kept. An
    empty table gives no rows. Other columns of docs are not looked at.
    """
    found = _classes(docs, words, similarity, recall, small, block_shingles, block_nodes)
    return found.select("doc_id", "class_id", "n_links", F.col("class_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def _classes(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    small: int = SMALL,
    block_shingles: int = BLOCK_SHINGLES,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """doc_id, node, class_id, n_links, chosen of each row: chosen is true for one node of each class, the smallest that has its class_id."""
    signed = materialize(signatures(docs, words, similarity, recall), "signatures")
    nodes = materialize(
        signed.where("node is not null")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("first_id"),
            F.max("size").alias("size"),
            F.max("sketch").alias("sketch"),
            F.max("buckets").alias("buckets"),
        ),
        "nodes",
    )
    grouped = candidate_groups(docs, nodes, words, similarity, recall, small)
    grouped = materialize(grouped.hint("merge").join(nodes.select("node", "copies", "first_id", "size"), "node"), "groups")
    n_blocks = grouped.groupBy("component").agg(
        F.greatest(F.ceil(F.sum("size") / block_shingles), F.ceil(F.count("*") / block_nodes)).alias("n_blocks"), F.count("*").alias("n")
    )
    tasks = _in_blocks(lookup(grouped, "component", n_blocks, "n"), F.col("component"), F.col("_found.n_blocks"))
    tasks = materialize(tasks.select("task", "lo", "hi", "own", "node", "copies", "first_id"), "pairs-of-blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    texts = by_bitmap(texts, "id", tasks.select("first_id")).where("_maybe")
    tasks = tasks.hint("merge").join(texts, tasks["first_id"].eqNullSafe(texts["id"]))
    tasks = tasks.select("task", "lo", "hi", "own", "node", "copies", "text").repartition("task").sortWithinPartitions("task")
    verified = materialize(map_batches(tasks, _exact(words, similarity), "node binary, links long, root binary"), "verified")
    linked = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.select("node", "copies", "first_id")
        .join(linked.hint("merge"), "node", "left")
        .join(links.hint("merge"), "node", "left")
        .select(
            "node", "copies", "first_id", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
        )
    )
    first = F.min(F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("class_id"), F.col("node").alias("chosen")))
    firsts = known.groupBy("component").agg(first.alias("first"), F.count("*").alias("n")).select("component", "first.class_id", "first.chosen", "n")
    own = lookup(known, "component", firsts, "n").select(
        "node", "copies", "_found.class_id", "links", (F.col("copies") - 1).alias("others"), (F.col("node") == F.col("_found.chosen")).alias("chosen")
    )
    known = materialize(own, "classes")
    found = lookup(signed.select("doc_id", "node"), "node", known, "copies")
    return found.select(
        "doc_id",
        "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("_found.class_id")).alias("class_id"),
        F.coalesce(F.col("_found.links") + F.col("_found.others"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_found.chosen", F.lit(False)).alias("chosen"),
    )


#: A text with a word; see words_of.
WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"


def _with_node(words: int):
    """Adds to each row the node of its text, or a digest of a text without words, and whether it has words."""

    def add(batches):
        for batch in batches:
            for at, texts in slices(batch, "_text"):
                sets = shingle_sets(texts, words)
                nodes = [node_of(s) if len(s) else hashlib.blake2b(t, digest_size=16).digest() for s, t in zip(sets, texts, strict=True)]
                own = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(nodes, pa.binary()), pa.array([len(s) > 0 for s in sets])],
                    [*own.schema.names, "_node", "_words"],
                )

    return add


def one_of_each(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of docs that stay: one row of each class, with all columns of docs.

    It is a row of the class's smallest id (of none if no row has one); of
    several such rows those of the smallest shingle-set hash, of these the
    smallest text. So an id stays more than once if its rows are of different
    classes. Texts without words are copies of nothing: one of each id and text
    stays, and all without an id. Only rows that may go are moved; rows whose id
    alone doesn't tell are decided by id and shingle-set hash.
    """
    found = materialize(_classes(docs, words, similarity, recall), "near")
    wins = F.col("chosen") & F.col("class_id").eqNullSafe(F.col("doc_id"))
    by_id = found.groupBy("doc_id").agg(F.bool_or(wins | F.col("node").isNull()).alias("kept"), F.count("*").alias("n"))
    odd = by_id.where("not kept or n > 1 or doc_id is null")
    odd = materialize(odd.select(F.col("doc_id").alias("_odd"), F.expr("n > 1 or doc_id is null").alias("many"), "n"), "near-odd")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("_row"), F.col("doc_id").cast("long").alias("_id"))
    rows = by_bitmap(rows, "_id", odd.select("_odd"))
    told = lookup(rows.where("_maybe").drop("_maybe"), "_id", odd.where("_odd is not null").withColumnRenamed("_odd", "_id"), "n")
    stay = rows.where("not _maybe").select("_row").unionByName(told.where("_id is not null and _found is null").select("_row"))
    if not odd.where("many").head(1):
        return stay.select("_row.*")
    unsure = told.where("_id is null or _found.many").withColumn("_text", F.col("_row.text").cast("binary"))
    has_words = F.coalesce(F.col("_row.text").cast("string").rlike(WORD), F.lit(False))
    stay = stay.unionByName(unsure.where(F.col("_id").isNull() & ~has_words).select("_row"))
    unsure = unsure.where(F.col("_id").isNotNull() | has_words).select("_row", "_id", "_text")
    kinds = T.StructType([*unsure.schema.fields, T.StructField("_node", T.BinaryType()), T.StructField("_words", T.BooleanType())])
    order = F.struct("_text", F.xxhash64(F.to_json("_row")))
    each = map_batches(unsure, _with_node(words), kinds).groupBy("_id", "_node", "_words").agg(F.min_by("_row", order).alias("_row"))
    winners = found.where(wins).select(F.col("doc_id").alias("_win_id"), F.col("node").alias("_win")).distinct()
    same = F.col("_words") & (F.col("_node") == F.col("_win")) & F.col("_id").eqNullSafe(F.col("_win_id"))
    each = each.join(winners.hint("merge"), same, "left").where("not _words or _win is not null")
    return stay.unionByName(each.select("_row")).select("_row.*")
