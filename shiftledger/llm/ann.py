"""Nearest neighbours by inner product from a forest of random-projection trees.

Every tree splits by hyperplanes between two random vectors of a sample, at the median, until a leaf
holds few sample vectors. All vectors are put into their leaf of every tree. A query enters all trees
with one priority queue of branches, ordered by the sum of squared margins on the way, and takes
leaves from it until they hold ``search_rows`` entries or ``search_share`` of all, whichever is more
(an entry counts once per tree). What it meets there is ranked by exact inner products on the original
vectors, in double precision, summed in the order of the components.

Largest inner products become smallest angles by one more component that lifts every vector to the
greatest length of all; a query's is zero.

Equal vectors are one entry with its smallest ids, which is all a result can name, so copies crowd
no leaf. A leaf is cut into chunks of ``CHUNK_ROWS`` vectors and none is left out. Null or zero
vectors, vectors with null or non-finite components or another dimension than most, and rows with a
null ``vec_id`` take no part; equal rows count once. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

TREES = 4
SAMPLE_ROWS = 20_000
LEAF_SAMPLE = 150
SEARCH_ROWS = 4_000
#: Vectors without any structure need this much for a recall of 0.9; clustered ones far less.
SEARCH_SHARE = 0.95
CHUNK_ROWS = 20_000
K = 20
SEED = 11


@dataclass
class Forest:
    """Nodes of all trees. A node below zero is leaf ``-node - 1``."""

    normals: np.ndarray
    offsets: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: list[int]
    leaves: int
    longest: float

    def lifted(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0.0))
        return np.column_stack((x, more))

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each lifted vector in each tree."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root)
            at = np.flatnonzero(node >= 0)
            while len(at):
                its = node[at]
                right = np.einsum("ij,ij->i", x[at], self.normals[its]) > self.offsets[its]
                node[at] = np.where(right, self.right[its], self.left[its])
                at = at[node[at] >= 0]
            out[:, t] = -node - 1
        return out

    def search(self, margins: np.ndarray, rows: np.ndarray, enough: int) -> list[int]:
        """Leaves a query takes. ``margins`` are its distances to all planes, ``rows`` the leaf sizes."""
        queue = [(0.0, root) for root in self.roots]
        taken, found = [], 0
        left, right = self.left, self.right
        while queue and found < enough:
            near, node = heappop(queue)
            while node >= 0:
                m = margins[node]
                here, there = (right[node], left[node]) if m > 0 else (left[node], right[node])
                heappush(queue, (near + m * m, there))
                node = here
            if rows[-node - 1]:
                taken.append(-int(node) - 1)
                found += rows[-node - 1]
        return taken


def grow(sample: np.ndarray, longest: float, trees: int = TREES, leaf_sample: int = LEAF_SAMPLE, seed: int = SEED) -> Forest:
    """A forest over a sample of vectors."""
    draw = np.random.default_rng(seed)
    forest = Forest(np.empty(0), np.empty(0), np.empty(0), np.empty(0), [], 0, longest)
    x = forest.lifted(sample)
    normals, offsets, left, right = [], [], [], []

    def build(rows: np.ndarray) -> int:
        if len(rows) > leaf_sample:
            for _ in range(3):
                a, b = draw.choice(rows, 2, replace=False)
                normal = x[a] - x[b]
                size = np.linalg.norm(normal)
                if size == 0:
                    continue
                normal = normal / size
                along = x[rows] @ normal
                middle = float(np.median(along))
                beyond = along > middle
                if 0 < beyond.sum() < len(rows):
                    node = len(normals)
                    normals.append(normal)
                    offsets.append(middle)
                    left.append(0)
                    right.append(0)
                    left[node] = build(rows[~beyond])
                    right[node] = build(rows[beyond])
                    return node
        forest.leaves += 1
        return -forest.leaves

    forest.roots = [build(np.arange(len(x))) for _ in range(trees)]
    forest.normals = np.array(normals).reshape(-1, x.shape[1])
    forest.offsets = np.array(offsets)
    forest.left, forest.right = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
    return forest


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total



def _place_batches(forest: Forest):
    """Each vector in its leaf of every tree."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.leaves_of(forest.lifted(_matrix(batch.column("vector"))))
            n, trees = leaves.shape
            row = pa.array(np.repeat(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves.ravel()), *[batch.column(c).take(row) for c in ("id", "first_id", "vector")]],
                ["leaf", "id", "first_id", "vector"],
            )

    return place


def _count_batches(forest: Forest):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(forest.leaves, dtype=np.int64)
        for batch in batches:
            leaves = forest.leaves_of(forest.lifted(_matrix(batch.column("vector"))))
            total += np.bincount(leaves.ravel(), minlength=forest.leaves)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(forest.leaves)), pa.array(total)], ["leaf", "n"])

    return count


def _route_batches(forest: Forest, rows: np.ndarray, chunks: np.ndarray, enough: int):
    """Each query to all chunks of the leaves it takes."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                x = _matrix(batch.column("vector"))
                x = np.column_stack((x, np.zeros(len(x))))
                margins = x @ forest.normals.T - forest.offsets
                leaf, chunk, row = [], [], []
                for i in range(len(x)):
                    for taken in forest.search(margins[i], rows, enough):
                        n = int(chunks[taken])
                        leaf += [taken] * n
                        chunk += range(n)
                        row += [i] * n
                pick = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(leaf, pa.int64()), pa.array(chunk, pa.int64()), pa.array([True] * len(row)),
                        batch.column("id").take(pick), batch.column("id").take(pick), batch.column("vector").take(pick),
                    ],
                    ["leaf", "chunk", "is_query", "id", "first_id", "vector"],
                )

    return route


def _rank_batches(most: int):
    """Over leaves, queries first: the best ``most`` entries of each query in each chunk of a leaf."""

    def best(queries: pa.Table, items: pa.Table) -> pa.RecordBatch:
        q, x = _matrix(queries.column("vector").combine_chunks()), _matrix(items.column("vector").combine_chunks())
        first = items.column("first_id").to_numpy()
        out_q, out_x, out_s = [], [], []
        for lo in range(0, len(q), 256):
            rough = q[lo : lo + 256] @ x.T
            if len(x) > most:
                cut = np.partition(rough, len(x) - most, axis=1)[:, len(x) - most]
                at, to = np.nonzero(rough >= (cut - 1e-9 * (1 + np.abs(cut)))[:, None])
            else:
                at, to = (a.ravel() for a in np.indices(rough.shape))
            score = exact_products(q[lo + at], x[to])
            order = np.lexsort((first[to], -score, at))
            at, to, score = at[order], to[order], score[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            keep = rank < most
            out_q.append(at[keep] + lo)
            out_x.append(to[keep])
            out_s.append(score[keep])
        a, b = pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_x))
        return pa.RecordBatch.from_arrays(
            [queries.column("id").combine_chunks().take(a), items.column("id").combine_chunks().take(b), pa.array(np.concatenate(out_s))],
            ["query", "entry", "score"],
        )

    def split(table: pa.Table) -> Iterator[pa.RecordBatch]:
        is_query = table.column("is_query").to_numpy()
        if is_query.any() and not is_query.all():
            n = int(is_query.sum())
            yield best(table.slice(0, n), table.slice(n))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if not table.num_rows:
                continue
            leaf, chunk = table.column("leaf").to_numpy(), table.column("chunk").to_numpy()
            edges = np.flatnonzero((leaf[1:] != leaf[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            edges = np.concatenate(([0], edges)).tolist()
            for a, b in zip(edges, edges[1:]):
                yield from split(table.slice(a, b - a))
            held = table.slice(edges[-1])
        if held is not None:
            yield from split(held)

    return rank


def usable_vectors(embeddings: DataFrame, vector: str) -> DataFrame:
    """Distinct ``vec_id, vector`` of the rows that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = (
        embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda c: c != 0))
        .select("vec_id", x.alias("vector"))
    )
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (sizes.d if sizes else 0)).distinct()


def nearest_neighbours(
    embeddings: DataFrame,
    query_every: int = K,
    k: int = K,
    vector: str = "embedding",
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    leaf_sample: int = LEAF_SAMPLE,
    search_rows: int = SEARCH_ROWS,
    search_share: float = SEARCH_SHARE,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``query_every``."""
    spark = embeddings.sparkSession
    rows = stage(usable_vectors(embeddings, vector), "vectors")
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    # one more than asked for, as a query may find itself
    named = rows.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
    entries = stage(
        named.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("id"), "vector", "ids", F.col("ids")[0].alias("first_id")),
        "entries",
    )
    asked = rows.where(F.col("vec_id") % query_every == 0)
    members = stage(
        asked.join(entries.select("vector", "id"), "vector").select(F.col("vec_id").alias("query_id"), F.col("id").alias("query")),
        "queries",
    )
    longest = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, c: s + c.cast("double") * c))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # the smallest hashes of the vectors themselves, so the forest does not hang on ids or partitions
    sample = entries.select("vector").orderBy(F.xxhash64("vector")).limit(sample_rows).toArrow()
    forest = grow(_matrix(sample.column("vector").combine_chunks()), float(np.sqrt(longest)), trees, leaf_sample)

    vectors = entries.select("id", "first_id", "vector")
    kind = vectors.schema["vector"].dataType.simpleString()
    counted = vectors.mapInArrow(_count_batches(forest), "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n"))
    sizes = np.zeros(forest.leaves, dtype=np.int64)
    for row in counted.collect():
        sizes[row.leaf] = row.n
    enough = max(search_rows, int(np.ceil(search_share * sizes.sum() / trees)))
    chunks = np.maximum(1, -(-sizes // chunk_rows))
    cut = F.element_at(F.array(*[F.lit(int(c)) for c in chunks]), F.col("leaf").cast("int") + 1) if chunks.max() > 1 else F.lit(1)
    placed = vectors.mapInArrow(
        _place_batches(forest), f"leaf bigint, id bigint, first_id bigint, vector {kind}"
    ).select("leaf", F.pmod(F.xxhash64("id"), cut).cast("bigint").alias("chunk"), F.lit(False).alias("is_query"), "id", "first_id", "vector")
    routed = (
        vectors.join(members.select(F.col("query").alias("id")).distinct(), "id", "left_semi")
        .mapInArrow(
            _route_batches(forest, sizes, chunks, enough),
            f"leaf bigint, chunk bigint, is_query boolean, id bigint, first_id bigint, vector {kind}",
        )
    )
    met = (
        placed.union(routed).repartition("leaf", "chunk")
        .sortWithinPartitions("leaf", "chunk", F.desc("is_query"), "id")
        .mapInArrow(_rank_batches(k + 1), "query bigint, entry bigint, score double")
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = (
        met.groupBy("query", "entry").agg(F.max("score").alias("score"))
        .join(entries.select(F.col("id").alias("entry"), "ids"), "entry")
        .select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("nth", F.row_number().over(by_score))
        .where(F.col("nth") <= k + 1)
    )
    found = stage(found.drop("nth"), "neighbours")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(found, "query").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
