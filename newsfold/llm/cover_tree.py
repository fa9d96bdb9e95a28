"""Exact top-k inner products by a dual-tree search over a cover tree.

The upper levels of the tree are fitted on a bounded sample: each node's children are far points of its
sample, until they cover it within half its radius or are ``FANOUT``, and no more than ``LEAVES`` leaves are made; so the
cover property isn't kept and the tree is one of k-centre partitions. All vectors are then sent down the tree to the nearest child; covering radii are the
true ones over all vectors below a node, so the bounds hold for every row and only their tightness rests on the sample.
Queries are indexed in the same tree.

A pair of nodes with centres p, q and radii r, s holds no inner product above p.q + r|q| + s|p| + rs. First each leaf of
queries meets the leaves most promising by their centres until it has k candidates, which gives a kth score for every
query and a worst one for each group. Then pairs of nodes are descended from the roots; a pair whose bound is below the
query group's worst kth score is cut off with everything below. The remaining pairs of leaves are scored block by block.

Vectors that occur often are folded to their k + 1 least ids first, which no top k with ties to smaller ids can miss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsfold.llm.scratch import Scratch

K = 20
SCALE = 64
#: Vectors that the tree's upper levels are fitted on, and how many leaves they have at most.
SAMPLE = 4096
LEAVES = 256
FANOUT = 8
#: Vectors of one block of data, and queries of one block of queries.
DATA_BLOCK = 2048
QUERY_BLOCK = 512

SCORES = "query_id bigint, vec_id bigint, score bigint"


class Tree:
    """Centres, children and parents of the nodes; node 0 is the root. Nodes come after their parents."""

    def __init__(self, sample: np.ndarray):
        self.centers = [sample.mean(axis=0)] if len(sample) else [np.zeros(sample.shape[1])]
        self.children: list[list[int]] = [[]]
        members = {0: np.arange(len(sample))}
        open_nodes = [0]
        while open_nodes:
            node = max(open_nodes, key=lambda n: len(members[n]))
            open_nodes.remove(node)
            points = sample[members[node]]
            leaves = sum(not kids for kids in self.children)
            if len(points) < 2 * FANOUT or leaves + FANOUT > LEAVES:
                continue
            distance = np.linalg.norm(points - self.centers[node], axis=1)
            reach, chosen = distance.max() / 2, [int(distance.argmax())]
            nearest = np.linalg.norm(points - points[chosen[0]], axis=1)
            while len(chosen) < FANOUT and nearest.max() > reach:
                chosen.append(int(nearest.argmax()))
                nearest = np.minimum(nearest, np.linalg.norm(points - points[chosen[-1]], axis=1))
            if len(chosen) < 2:
                continue
            owner = np.linalg.norm(points[:, None] - points[chosen][None], axis=2).argmin(axis=1)
            for at, point in enumerate(chosen):
                self.children[node].append(len(self.centers))
                members[len(self.centers)] = members[node][owner == at]
                open_nodes.append(len(self.centers))
                self.centers.append(points[point])
                self.children.append([])
        self.centers = np.array(self.centers)

    def descend(self, vectors: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """The leaf of each vector, and ``(node, count, radius)`` of the nodes met."""
        leaf, met = np.zeros(len(vectors), dtype=np.int64), []
        below = {0: np.arange(len(vectors))}
        while below:
            node, rows = below.popitem()
            met.append((node, len(rows), float(np.linalg.norm(vectors[rows] - self.centers[node], axis=1).max(initial=0))))
            leaf[rows] = node
            kids = self.children[node]
            if kids:
                centers = self.centers[kids]
                near = ((centers**2).sum(axis=1) - 2 * vectors[rows] @ centers.T).argmin(axis=1)
                below |= {kid: rows[near == at] for at, kid in enumerate(kids) if (near == at).any()}
        return leaf, met


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: floor(scale * x) of each component; rows that take no part are gone."""
    number = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(number, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = embeddings.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(number, lambda x: F.floor(x * scale).cast("bigint")).alias("vector"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for row, (end, size) in enumerate(zip(np.cumsum(sizes), sizes)):
        out[row, :size] = values[end - size : end]
    return out


def folded(vectors: DataFrame, most: int) -> DataFrame:
    """``vector, ids``: the least ``most`` ids of each distinct vector; every task folds its rows first."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: dict[bytes, list[int]] = {}
            rows = batch.column("vector").to_pylist()
            first = {}
            for row, (vector, number) in enumerate(zip(map(tuple, rows), batch.column("vec_id").to_pylist())):
                ids.setdefault(vector, []).append(number)
                first.setdefault(vector, row)
            kept = [sorted(set(own))[:most] for own in ids.values()]
            columns = [batch.column("vector").take(pa.array(list(first.values()))), pa.array(kept, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["vector", "ids"])

    partial = vectors.mapInArrow(fold, "vector array<bigint>, ids array<bigint>")
    together = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most)
    return partial.groupBy("vector").agg(together.alias("ids"))


def placed(rows: DataFrame, tree: Tree, width: int, keep: str, kind: str) -> DataFrame:
    """``leaf``, the column ``keep`` and ``vector`` of each row."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _ = tree.descend(_matrix(batch.column("vector"), width))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(keep), batch.column("vector")], ["leaf", keep, "vector"])

    return rows.select(keep, "vector").mapInArrow(place, f"leaf bigint, {keep} {kind}, vector array<bigint>")


def node_radii(rows: DataFrame, tree: Tree, width: int, counted: str) -> tuple[np.ndarray, np.ndarray]:
    """How many ids and which covering radius each node has; a few numbers per node and task."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, met = tree.descend(_matrix(batch.column("vector"), width))
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*met)], ["node", "n", "radius"])

    met = rows.select("vector").mapInArrow(measure, "node bigint, n bigint, radius double")
    count, radius = np.zeros(len(tree.centers)), np.zeros(len(tree.centers))
    for row in met.groupBy("node").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect():  # nodes of the tree
        count[row["node"]], radius[row["node"]] = row["n"], row["radius"]
    return count, radius


def blocked(rows: DataFrame, size: int, name: str, *columns: str) -> DataFrame:
    """Rows of a leaf in blocks of about ``size``, as lists; a leaf of any size is dealt over as many blocks as it takes."""
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count("*") / size).alias("blocks"))
    salted = rows.join(F.broadcast(sizes), "leaf")  # leaves of the tree
    salted = salted.withColumn("block", F.pmod(F.xxhash64(*columns), F.col("blocks")))
    return salted.groupBy(F.col("leaf").alias(name), "block").agg(*(F.collect_list(c).alias(f"{name}_{c}") for c in columns)).drop("block")


def best_of(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def scored_pairs(queries: DataFrame, data: DataFrame, pairs: DataFrame, k: int, width: int) -> DataFrame:
    """``SCORES`` of each block of queries' best k in each block of data its leaf is paired with."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked = np.array(batch.column("q_query_id")[row].as_py(), np.int64)
                ids = batch.column("d_ids")[row].as_py()
                left, right = (_matrix(batch.column(name)[row].values, width) for name in ("q_vector", "d_vector"))
                if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * width < 2**52:
                    found = (left @ right.T).astype(np.int64)
                else:
                    found = left.astype(object) @ right.astype(object).T
                owner = np.repeat(np.arange(len(ids)), [len(own) for own in ids])
                flat_ids = np.array([i for own in ids for i in own], np.int64)
                out_query, out_id, out_score = [], [], []
                for at, query in enumerate(asked):
                    all_scores = found[at][owner]
                    order = np.lexsort((flat_ids, -all_scores))[: k + 1]
                    order = order[flat_ids[order] != query][:k]
                    out_query += [query] * len(order)
                    out_id += flat_ids[order].tolist()
                    out_score += all_scores[order].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (out_query, out_id, out_score)], ["query_id", "vec_id", "score"])

    joined = queries.join(F.broadcast(pairs), "q").join(data, "d")  # pairs of leaves of the tree
    return joined.select("q_query_id", "q_vector", "d_ids", "d_vector").mapInArrow(score, SCORES)


def search(embeddings: DataFrame, every: int = K, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row with a vec_id divisible by ``every``, the k largest inner products
    with all other rows, ties to the smaller vec_id.

    Rows without a vec_id, and with null, NaN or infinite components, take no part. Rows with equal vec_id and vector are
    one row. Shorter vectors count as filled up with zeros. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "cover-tree")
    vectors = scratch.keep(integer_vectors(embeddings, scale), "vectors")
    width = max(1, vectors.agg(F.max(F.size("vector"))).first()[0] or 0)
    distinct = scratch.keep(folded(vectors, k + 1), "distinct")
    sample = [row["vector"] for row in distinct.orderBy(F.xxhash64("vector")).select("vector").limit(SAMPLE).collect()]
    tree = Tree(_matrix(pa.array(sample, pa.list_(pa.int64())), width))
    asked = vectors.where(F.col("vec_id") % every == 0).distinct().withColumnRenamed("vec_id", "query_id")

    data = scratch.keep(placed(distinct, tree, width, "ids", "array<bigint>"), "data")
    queries = scratch.keep(placed(asked, tree, width, "query_id", "bigint"), "queries")
    n_data, r_data = node_radii(distinct, tree, width, "ids")
    n_query, r_query = node_radii(asked, tree, width, "query_id")
    data_blocks = scratch.keep(blocked(data, DATA_BLOCK, "d", "ids", "vector"), "data-blocks")
    query_blocks = scratch.keep(blocked(queries, QUERY_BLOCK, "q", "query_id", "vector"), "query-blocks")

    norm = np.linalg.norm(tree.centers, axis=1)
    products = tree.centers @ tree.centers.T
    bound = products + np.outer(r_query, norm) + np.outer(norm, r_data) + np.outer(r_query, r_data)  # [queries, data]
    leaves = [node for node, kids in enumerate(tree.children) if not kids]
    full = [node for node in leaves if n_data[node]]
    first = []
    for q in (node for node in leaves if n_query[node]):
        have = 0
        for d in sorted(full, key=lambda d: -products[q, d]):
            first.append((q, d))
            have += n_data[d]
            if have > k:
                break

    def frame(pairs: list[tuple[int, int]]) -> DataFrame:
        return spark.createDataFrame([(int(q), int(d)) for q, d in pairs], "q bigint, d bigint")

    initial = scratch.keep(scored_pairs(query_blocks, data_blocks, frame(first), k, width), "first")
    leaf_of = queries.select("query_id", "leaf").distinct()
    kth = best_of(initial, k).groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
    worst_of = leaf_of.join(kth, "query_id", "left").groupBy("leaf").agg(F.min(F.coalesce("kth", F.lit(-(2**63)))).alias("worst"))
    worst = np.full(len(tree.centers), np.inf)
    for row in worst_of.collect():  # leaves of the tree
        worst[row["leaf"]] = row["worst"]
    for node in range(len(tree.centers) - 1, -1, -1):
        if tree.children[node]:
            worst[node] = min(worst[kid] for kid in tree.children[node])

    rest, open_pairs, met = [], [(0, 0)], set(first)
    while open_pairs:
        q, d = open_pairs.pop()
        if not n_query[q] or not n_data[d] or bound[q, d] < worst[q] - 1e-6 * (1 + abs(bound[q, d])):
            continue
        if not tree.children[q] and not tree.children[d]:
            rest += [(q, d)] if (q, d) not in met else []
        elif tree.children[q] and (not tree.children[d] or r_query[q] >= r_data[d]):
            open_pairs += [(kid, d) for kid in tree.children[q]]
        else:
            open_pairs += [(q, kid) for kid in tree.children[d]]
    more = scored_pairs(query_blocks, data_blocks, frame(rest), k, width)
    return best_of(initial.unionByName(more), k).select("query_id", "rank", "vec_id", "score")
