"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard.

Equal vectors collapse to one node, nodes are dealt to shards by hash, and every shard gets a graph (``index``, one row per node). Every node is searched in every
shard: a pair of shards is one task, in which the nodes of one go through the graph of the other, down its layers and then with a beam on the lowest. The beam of a shard is doubled until
an audit finds at least ``RECALL`` of the links of its audit queries, which brute force over the shard gives; a shard that fails even with a beam of all its nodes is searched by brute force. From a link that was found
the search goes on over all links next to it, whatever their number, so a group of near copies larger than the beam comes out whole. Candidates are verified by their
cosine in double precision. A task keeps counts and one root per node, never its pairs, and the components of all roots are united in rounds of staged tables.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, not even with their like. Vectors of different lengths do not link. Equal vectors link
whatever their ids; rows of equal or null id stand for themselves, and a null id becomes a component's id only if it has no other. An empty table gives an empty result; other
columns, whatever their names, are ignored. The graph follows from the vectors alone, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import attach_group, staged
from loamgrid.llm.graph import connected_components

COSINE = 0.9
#: A shard has up to SHARD_NODES nodes in the mean; there are SHARDS shards at least.
SHARD_NODES, SHARDS = 32_768, 8
#: Links of a node on the upper layers and on the lowest, and the beams of the build, of the upper layers, and the least of a search.
LINKS, LOW_LINKS, BUILD_BEAM, UPPER_BEAM, BEAM = 16, 32, 64, 8, 32
#: Share of the audit's links that a beam must find, and the audit's queries per shard and kind.
RECALL, AUDIT = 0.99, 256
#: Queries at once, and pairs at once where a search goes on from link to link.
QUERIES, PAIRS = 512, 50_000


def units(raw: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    raw = raw.astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def pair_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


class Beam:
    """Best-first search of many queries at once on one layer; ``ids`` and ``sims`` hold the ``width`` best nodes of each query."""

    def __init__(self, links: np.ndarray, x: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int, least: float = math.inf):
        self.links, self.x, self.queries, self.least = links, x, queries, least
        n = len(queries)
        self.seen = np.zeros((n, len(links)), bool)
        self.ids, self.sims, self.open = np.full((n, width), -1, np.int32), np.full((n, width), -np.inf, np.float32), np.zeros((n, width), bool)
        #: pairs of query and node at ``least`` or more, and those of them whose neighbours were looked at
        self.hits: list[np.ndarray] = []
        self.done: list[np.ndarray] = []
        self._take(np.arange(n), entries)
        while True:
            best = np.where(self.open, self.sims, -np.inf)
            at = best.argmax(axis=1)
            active = np.flatnonzero(best[np.arange(n), at] > -np.inf)
            if not len(active):
                break
            at = at[active]
            self.open[active, at] = False
            if least < math.inf:
                near = self.sims[active, at] >= least
                self.done.append(active[near] * len(links) + self.ids[active, at][near])
            self._take(active, links[self.ids[active, at]])

    def _take(self, rows: np.ndarray, nodes: np.ndarray) -> None:
        """Offer nodes (-1: none; no node twice in a row) to the beams of ``rows``."""
        r, c = np.nonzero((nodes >= 0) & ~self.seen[rows[:, None], nodes])
        if not len(r):
            return
        v = nodes[r, c]
        self.seen[rows[r], v] = True
        own = pair_cosines(self.x[v], self.queries[rows[r]])
        if self.least < math.inf:
            near = own >= self.least
            self.hits.append(rows[r[near]] * len(self.links) + v[near])
        some, r = np.unique(r, return_inverse=True)
        sims, ids = np.full((len(some), nodes.shape[1]), -np.inf, np.float32), np.full((len(some), nodes.shape[1]), -1, np.int32)
        sims[r, c], ids[r, c] = own, v
        rows = rows[some]
        width = self.ids.shape[1]
        sims, ids = np.concatenate((self.sims[rows], sims), axis=1), np.concatenate((self.ids[rows], ids), axis=1)
        open_ = np.concatenate((self.open[rows], np.ones((len(some), nodes.shape[1]), bool)), axis=1)
        best = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        self.sims[rows], self.ids[rows] = np.take_along_axis(sims, best, 1), np.take_along_axis(ids, best, 1)
        self.open[rows] = np.take_along_axis(open_, best, 1) & (self.ids[rows] >= 0)

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """Queries and nodes at ``least`` or more: those that the beam met, and all that can be reached from them over such nodes."""
        n = len(self.links)
        found = [np.unique(np.concatenate([*self.hits, np.empty(0, np.int64)]))]
        todo = np.setdiff1d(found[0], np.concatenate([*self.done, np.empty(0, np.int64)]))
        while len(todo):
            part, todo = todo[:PAIRS], todo[PAIRS:]
            nodes = self.links[part % n]
            keys = np.unique(((part // n * n)[:, None] + nodes)[nodes >= 0])
            keys = keys[~self.seen.ravel()[keys]]
            self.seen.ravel()[keys] = True
            new = keys[pair_cosines(self.x[keys % n], self.queries[keys // n]) >= self.least]
            found.append(new)
            todo = np.concatenate((todo, new))
        keys = np.concatenate(found)
        return keys // n, keys % n


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of each row's candidates (best first, -1 last): those nearer to the row's node than to any chosen before, then the best of the others."""
    v = x[ids]
    among = v @ v.transpose(0, 2, 1)
    chosen, nearest, count = np.zeros(ids.shape, bool), np.full(ids.shape, -np.inf, np.float32), np.zeros(len(ids), int)
    for k in range(ids.shape[1]):
        ok = (ids[:, k] >= 0) & (nearest[:, k] < sims[:, k]) & (count < most)
        chosen[:, k] = ok
        count += ok
        nearest = np.where(ok[:, None], np.maximum(nearest, among[:, k]), nearest)
    order = np.argsort(np.where(ids < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1)


def by_similarity(ids: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sims = np.where(ids < 0, -np.inf, sims).astype(np.float32)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


class Graph:
    """Layers of links over the nodes of a shard. Nodes come by level, highest first, so a layer is a beginning of the list."""

    def __init__(self, x: np.ndarray, sizes: list[int], layers: list[np.ndarray]):
        self.x, self.sizes, self.layers = x, sizes, layers

    @staticmethod
    def build(x: np.ndarray, levels: np.ndarray) -> Graph:
        """``levels``: falling numbers, one per node. Each layer, from the highest, takes its nodes in growing batches; those of a batch see the graph before it and each other."""
        sizes = [int((levels >= k).sum()) for k in range(int(levels[0]) + 1)]
        g = Graph(x, sizes, [np.empty((0, 0), np.int32)] * len(sizes))
        for level in range(len(sizes) - 1, -1, -1):
            n, most = sizes[level], LINKS if level else LOW_LINKS
            links = np.full((n, most), -1, np.int32)
            start = 1
            while start < n:
                end = min(n, start + max(1, min(QUERIES, start // 4)))
                new = np.arange(start, end)
                entries = g.entries(x[start:end], level)
                entries = np.where((entries < start) & (entries != 0), entries, -1)
                entries = np.concatenate((np.zeros((len(new), 1), entries.dtype), entries), axis=1)
                met = Beam(links[:start], x[:start], x[start:end], entries, BUILD_BEAM)
                among = x[start:end] @ x[start:end].T
                np.fill_diagonal(among, -np.inf)
                k = min(LINKS, len(new) - 1)
                mates = np.argpartition(-among, k - 1, axis=1)[:, :k] if k > 0 else np.empty((len(new), 0), int)
                ids = np.concatenate((met.ids, (mates + start).astype(np.int32)), axis=1)
                ids, sims = by_similarity(ids, np.concatenate((met.sims, np.take_along_axis(among, mates, 1)), axis=1))
                links[start:end] = diverse(x, ids, sims, most)
                g._link_back(links, new, most)
                start = end
            g.layers[level] = links
        return g

    def _link_back(self, links: np.ndarray, new: np.ndarray, most: int) -> None:
        """Each node that a new one links to gets the link back; where there are too many, the diverse ones stay."""
        r, c = np.nonzero(links[new] >= 0)
        old, src = links[new][r, c], new[r].astype(np.int32)
        sims = pair_cosines(self.x[old], self.x[src])
        order = np.lexsort((-sims, old))
        old, src = old[order], src[order]
        targets, first = np.unique(old, return_index=True)
        rank = np.arange(len(old)) - np.repeat(first, np.diff(np.append(first, len(old))))
        row = np.searchsorted(targets, old)
        keep = rank < most
        come = np.full((len(targets), most), -1, np.int32)
        come[row[keep], rank[keep]] = src[keep]
        come = np.where((come[:, :, None] == links[targets][:, None, :]).any(axis=2), -1, come)  # linked already
        ids = np.concatenate((links[targets], come), axis=1)
        sims = np.einsum("ijk,ik->ij", self.x[ids], self.x[targets])
        ids, sims = by_similarity(ids, sims)
        full = (ids >= 0).sum(axis=1) > most
        links[targets[~full]] = ids[~full, :most]
        if full.any():
            links[targets[full]] = diverse(self.x, ids[full], sims[full], most)

    def entries(self, queries: np.ndarray, level: int) -> np.ndarray:
        """The best nodes of the layers above ``level`` for each query."""
        at = np.zeros((len(queries), 1), np.int32)
        for k in range(len(self.sizes) - 1, level, -1):
            at = Beam(self.layers[k], self.x[: self.sizes[k]], queries, at, UPPER_BEAM).ids
        return at

    def linked(self, queries: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a node with a cosine of ``least`` or more."""
        if beam > len(self.x):  # no beam passed the audit
            return np.nonzero(queries @ self.x.T >= least)
        return Beam(self.layers[0], self.x, queries, self.entries(queries, 0), beam, least).linked()

    def audited_beam(self, least: float) -> int:
        """The least beam, doubling, whose searches find ``RECALL`` of the links of the audit queries: nodes spread over the shard, as they are and turned away to a cosine just above ``least``."""
        n = len(self.x)
        some = self.x[np.unique(np.linspace(0, n - 1, min(n, AUDIT)).astype(int))]
        away = np.random.default_rng(13).standard_normal(some.shape).astype(np.float32)
        away -= pair_cosines(away, some)[:, None] * some
        length = np.sqrt(pair_cosines(away, away))[:, None]
        aside = min(1.0, least + 0.005)
        turned = np.where(length > 0, aside * some + math.sqrt(1 - aside * aside) * away / np.maximum(length, 1e-30), some).astype(np.float32)
        queries = np.concatenate((some, turned))
        true = sum(int((queries[i : i + QUERIES] @ self.x.T >= least).sum()) for i in range(0, len(queries), QUERIES))
        beam = BEAM
        while beam <= n:
            found = sum(len(self.linked(queries[i : i + QUERIES], beam, least)[0]) for i in range(0, len(queries), QUERIES))
            if found >= RECALL * true:
                return beam
            beam *= 2
        return n + 1


class Roots:
    """The smallest node of the component of each node, over the links seen so far."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        pairs = np.unique(np.stack((self.of[a], self.of[b]), axis=1), axis=0)
        up: dict[int, int] = {}

        def top(i: int) -> int:
            while i in up:
                i = up[i]
            return i

        for i, j in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
            i, j = sorted((top(i), top(j)))
            if i != j:
                up[j] = i
        if up:
            to = np.arange(len(self.of))
            for i in up:
                to[i] = top(i)
            self.of = to[self.of]


def sound(vec: Column) -> Column:
    """Whether a vector can link."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def stack(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column, all of length ``dim``."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def index(nodes: DataFrame, shards: int, cosine: float = COSINE) -> DataFrame:
    """The graphs of ``nodes`` (``dim, shard, node, n, vec``), one row per node: its ``place`` and ``level`` in the shard's graph, its links as 32-bit numbers of places (``low``; ``upper``: level by level) and the shard's audited ``beam``."""
    kind = nodes.schema["vec"].dataType.simpleString()
    schema = f"dim int, shard int, node long, n long, vec {kind}, place int, level int, low binary, upper binary, beam int"

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        mixed = (node.view(np.uint64) ^ (node.view(np.uint64) >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        share = ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        levels = np.floor(-np.log(share) / math.log(LINKS)).astype(int)
        order = np.lexsort((node, mixed, -levels))
        table, levels = table.take(pa.array(order)), levels[order]
        graph = Graph.build(units(stack(table.column("vec"), table.column("dim")[0].as_py())).astype(np.float32), levels)
        beam = graph.audited_beam(cosine - 1e-6)
        n = len(levels)
        upper = [b"".join(graph.layers[k][i].astype("<i4").tobytes() for k in range(1, levels[i] + 1)) for i in range(n)]
        low = [row.tobytes() for row in graph.layers[0].astype("<i4")]
        for name, values, t in (("place", np.arange(n), pa.int32()), ("level", levels, pa.int32()), ("low", low, pa.binary()), ("upper", upper, pa.binary()), ("beam", np.full(n, beam), pa.int32())):
            table = table.append_column(name, pa.array(values, t))
        return table

    return nodes.select("dim", "shard", "node", "n", "vec").groupBy("dim", "shard").applyInArrow(run, schema)


def loaded(table: pa.Table, x: np.ndarray) -> Graph:
    """The graph of one shard's rows, which come by place."""
    levels = table.column("level").to_numpy()
    sizes = [int((levels >= k).sum()) for k in range(int(levels[0]) + 1)]
    low = np.frombuffer(b"".join(table.column("low").to_pylist()), "<i4").reshape(-1, LOW_LINKS)
    upper = [np.frombuffer(b, "<i4").reshape(-1, LINKS) for b in table.column("upper").slice(0, sizes[1] if len(sizes) > 1 else 0).to_pylist()]
    return Graph(x, sizes, [low, *[np.stack([upper[i][k - 1] for i in range(sizes[k])]) for k in range(1, len(sizes))]])


def match(graph_rows: pa.Table, query_rows: pa.Table, cosine: float) -> pa.Table:
    """``node, links, root`` of the nodes of two shards that link with a node of the other (or of the same): links by rows, and a node of the same component."""
    columns = {"node": pa.int64(), "links": pa.int64(), "root": pa.int64()}
    if not len(graph_rows) or not len(query_rows):
        return pa.table({c: pa.array([], t) for c, t in columns.items()})
    graph_rows = graph_rows.sort_by("place")
    dim = graph_rows.column("dim")[0].as_py()
    x, q = (units(stack(t.column("vec"), dim)) for t in (graph_rows, query_rows))
    x32, q32 = x.astype(np.float32), q.astype(np.float32)
    node = np.concatenate((graph_rows.column("node").to_numpy(), query_rows.column("node").to_numpy()))
    size = np.concatenate((graph_rows.column("n").to_numpy(), query_rows.column("n").to_numpy()))
    same = graph_rows.column("shard")[0].as_py() == query_rows.column("shard")[0].as_py()
    graph, beam, n = loaded(graph_rows, x32), graph_rows.column("beam")[0].as_py(), len(graph_rows)
    links, roots = np.zeros(len(node), np.int64), Roots(len(node))
    for start in range(0, len(q), QUERIES):
        a, b = graph.linked(q32[start : start + QUERIES], beam, cosine - 1e-5)
        a = a + start
        for part in range(0, len(a), PAIRS):
            i, j = a[part : part + PAIRS], b[part : part + PAIRS]
            ok = pair_cosines(q[i], x[j]) >= cosine
            if same:  # each link once, and no node with itself
                ok &= node[n + i] > node[j]
            i, j = n + i[ok], j[ok]
            links += np.bincount(i, size[j], len(node)).astype(np.int64) + np.bincount(j, size[i], len(node)).astype(np.int64)
            roots.join(i, j)
    some = np.flatnonzero(links)
    return pa.table({"node": node[some], "links": links[some], "root": node[roots.of[some]]}, pa.schema(list(columns.items())))


def similar_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, shard_nodes: int = SHARD_NODES, shards: int = SHARDS) -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id`` and ``kept`` (whether the row's id is its component's)."""
    vec = F.col("vec")
    slim = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    slim = slim.select("id", "vec", F.when(sound(vec), F.xxhash64(F.size(vec), vec)).alias("node"))
    distinct = staged(slim.filter("node IS NOT NULL").groupBy("node", "vec").agg(F.min("id").alias("min_id"), F.count(F.lit(1)).alias("n")), "vectors")
    n_nodes, total = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    count = max(shards, math.ceil(n_nodes / shard_nodes))
    nodes = distinct.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64("node"), F.lit(count)).cast("int").alias("shard"), "node", "n", "vec")
    graphs = staged(index(nodes, count, cosine), "graphs")
    searched = graphs.withColumn("with", F.explode(F.sequence(F.col("shard"), F.lit(count - 1)))).groupBy("dim", F.col("shard").alias("a"), F.col("with").alias("b"))
    queries = graphs.select("dim", "shard", "node", "n", "vec").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("shard"))))
    queries = queries.groupBy("dim", F.col("with").alias("a"), F.col("shard").alias("b"))
    found = searched.cogroup(queries).applyInArrow(lambda g, q: match(g, q, cosine), "node long, links long, root long")
    found = staged(found, "links")
    roots = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("_node"), "root")
    counted = found.groupBy("node").agg(F.sum("links").alias("links")).select(F.col("node").alias("_found"), "links")
    own = distinct.select("node", "min_id", "n").join(roots, F.col("node") == F.col("_node"), "left").join(counted, F.col("node") == F.col("_found"), "left")
    own = staged(own.select("node", "min_id", "n", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "nodes")
    smallest = own.groupBy("root").agg(F.min("min_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = attach_group(own, smallest, ["root"], "members", ["component_id"], F.col("node"), n_nodes)
    groups = staged(named.select("node", "n", "n_links", "component_id"), "groups")
    sure = slim.select("id", F.coalesce("node", F.xxhash64("id")).alias("node"), F.col("node").isNull().alias("alone"))
    out = attach_group(sure, groups, ["node"], "n", ["n_links", "component_id"], F.col("id"), total)
    component = F.when(F.col("alone"), F.col("id")).otherwise(F.col("component_id"))
    n_links = F.when(F.col("alone"), F.lit(0)).otherwise(F.col("n_links")).cast("long")
    return out.select(F.col("id").alias(id_col), n_links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
