"""Approximate nearest neighbours by hierarchical navigable small-world graphs.

Distinct vectors are dealt to shards of bounded size by their hash. Each shard
gets a graph of its own, stored as flat arrays: levels, and per layer a fixed
number of neighbours for every vector. Queries, in blocks, are searched in every
shard, and the shards' results are merged. Equal vectors are one node that holds
the smallest of their ids, so that very many copies cannot cut the graph apart.
"""

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.llm.common import table
from labelweave.session import materialise

NEIGHBOURS = 10
SHARD_VECTORS = 4096
BLOCK_QUERIES = 512
DEGREE = 12  # neighbours in upper layers; twice as many in the lowest
BUILD_WIDTH = 48
SEARCH_WIDTH = 64
_INDEX = ("shard long, dim int, ids array<array<long>>, vectors binary, entry int, layers int, degrees array<int>, "
          "neighbours array<binary>")


class Graph:
    """The graph of one shard. Neighbours of layer l are the rows of
    ``links[l]``, filled up with -1."""

    def __init__(self, vectors, links, entry):
        self.vectors, self.links, self.entry = vectors, links, entry

    def search(self, layer, distance, starts, width):
        """The ``width`` nearest nodes that a best-first walk of a layer finds,
        as sorted (distance, node). ``distance`` takes an array of nodes."""
        seen = np.zeros(len(self.vectors), bool)
        seen[starts] = True
        ahead = list(zip(distance(np.array(starts)).tolist(), starts))
        heapq.heapify(ahead)
        best = [(-d, node) for d, node in ahead]
        heapq.heapify(best)
        links = self.links[layer]
        while ahead:
            near, node = heapq.heappop(ahead)
            if len(best) >= width and near > -best[0][0]:
                break
            around = links[node]
            around = around[around >= 0]
            around = around[~seen[around]]
            if not len(around):
                continue
            seen[around] = True
            for d, other in zip(distance(around).tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-d, other))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, other))
                else:
                    continue
                heapq.heappush(ahead, (d, other))
        return sorted((-d, node) for d, node in best)

    def descend(self, distance, to_layer):
        at = [self.entry]
        for layer in range(len(self.links) - 1, to_layer, -1):
            at = [self.search(layer, distance, at, 1)[0][1]]
        return at

    def nearest(self, query, width):
        """Nodes near a query, all of them in a graph no wider than the search."""
        if len(self.vectors) <= width:
            return np.arange(len(self.vectors))
        distance = lambda nodes: ((self.vectors[nodes] - query) ** 2).sum(1)
        return np.array([node for _, node in self.search(0, distance, self.descend(distance, 0), width)])


def _spread(order, between, most):
    """Of nodes in order of distance those that are nearer to the new node than
    to any chosen one, then the nearest of the others: links in all directions."""
    chosen, spare = [], []
    for d, node in order:
        if len(chosen) == most:
            break
        if not chosen or between[node, chosen].min() > d:
            chosen.append(node)
        else:
            spare.append(node)
    return chosen + spare[:most - len(chosen)]


def build(vectors, seed=0):
    """Inserts the vectors one by one. Distances within a shard are computed in
    one go, for its size is bounded."""
    vectors = np.ascontiguousarray(vectors, np.float32)
    n = len(vectors)
    norms = (vectors.astype(np.float64) ** 2).sum(1)
    between = (norms[:, None] + norms[None, :] - 2 * (vectors @ vectors.T)).astype(np.float32)
    draws = np.random.default_rng(seed).random(n)
    levels = np.minimum((-np.log(1 - draws) / math.log(DEGREE)).astype(int), 8)
    top = int(levels.max())
    links = [np.full((n, DEGREE if layer else 2 * DEGREE), -1, np.int32) for layer in range(top + 1)]
    graph = Graph(vectors, links, 0)
    reached = int(levels[0])
    for i in range(1, n):
        row = between[i]
        distance = row.__getitem__
        at = [graph.entry]
        for layer in range(reached, levels[i], -1):
            at = [graph.search(layer, distance, at, 1)[0][1]]
        for layer in range(min(reached, levels[i]), -1, -1):
            found = graph.search(layer, distance, at, BUILD_WIDTH)
            at, slots = [node for _, node in found], links[layer]
            most = slots.shape[1]
            for node in _spread(found, between, DEGREE):
                slots[i, np.argmin(slots[i])] = node
                free = np.flatnonzero(slots[node] < 0)
                if len(free):
                    slots[node, free[0]] = i
                else:
                    around = [*slots[node].tolist(), i]
                    order = sorted(zip(between[node, around].tolist(), around))
                    slots[node] = _spread(order, between, most)
        if levels[i] > reached:
            reached, graph.entry = int(levels[i]), i
    return graph


def _valid(vector):
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0)


def build_index(vectors, copies=NEIGHBOURS + 1, shard_vectors=SHARD_VECTORS):
    """A written table, one row per shard, of vec_id and embedding rows.

    Null and zero vectors, those with null or non-finite components, and rows
    without an id are left out. Of equal vectors the ``copies`` smallest ids are
    kept, which is all that any query can return. Only vectors of the same
    number of components share a shard.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & _valid(F.col("embedding"))).distinct()
    # The limit on the rank is applied before the shuffle too.
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id")))
    nodes = materialise(ranked.where(F.col("nth") <= copies).groupBy("embedding").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // shard_vectors))
    dealt = nodes.withColumns({"dim": F.size("embedding"),
                               "shard": F.pmod(F.xxhash64("embedding"), F.lit(shards))})

    def graph_of(frame):
        frame = frame.sort_values("ids", key=lambda c: c.map(lambda x: x[0]))
        vectors = np.stack(frame["embedding"].to_list()).astype(np.float32)
        graph = build(vectors)
        return pd.DataFrame([{
            "shard": frame["shard"].iloc[0], "dim": vectors.shape[1], "ids": frame["ids"].to_list(),
            "vectors": vectors.tobytes(), "entry": graph.entry, "layers": len(graph.links),
            "degrees": [x.shape[1] for x in graph.links], "neighbours": [x.tobytes() for x in graph.links]}])

    return materialise(dealt.groupBy("dim", "shard").applyInPandas(graph_of, _INDEX), "index")


def search_index(index, queries, k=NEIGHBOURS, width=SEARCH_WIDTH):
    """query_id, rank, vec_id, score (Euclidean distance in double precision).

    ``queries`` has vec_id and embedding, the query's own id is no candidate.
    Each shard returns its k nearest, ties to smaller ids, and the merge keeps k.
    """
    asked = queries.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & _valid(F.col("embedding"))).distinct()
    asked = materialise(asked, "queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    grouped = (asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
               .groupBy("block", F.size("embedding").alias("dim"))
               .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("asked")))
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(batches):
        for batch in batches:
            for row in batch.itertuples():
                vectors = np.frombuffer(row.vectors, np.float32).reshape(-1, row.dim)
                links = [np.frombuffer(x, np.int32).reshape(-1, d) for x, d in zip(row.neighbours, row.degrees)]
                graph, exact, out = Graph(vectors, links, row.entry), vectors.astype(np.float64), []
                for query in row.asked:
                    vector = np.asarray(query["embedding"], np.float64)
                    nodes = graph.nearest(vector.astype(np.float32), width)
                    scores = np.sqrt(((exact[nodes] - vector) ** 2).sum(1))
                    found = sorted((s, v) for s, node in zip(scores.tolist(), nodes.tolist())
                                   for v in row.ids[node] if v != query["vec_id"])
                    out += [(query["vec_id"], vector.tobytes(), v, s) for s, v in found[:k]]
                yield pd.DataFrame(out, columns=["query_id", "of", "vec_id", "score"])

    found = (pairs.join(grouped, ["block", "dim"])
             .mapInPandas(search, "query_id long, of binary, vec_id long, score double"))
    order = Window.partitionBy("query_id", "of").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_hnsw(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search_index(build_index(vectors), vectors.where("vec_id % 100 = 0"))
