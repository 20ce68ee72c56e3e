"""SimHash near-duplicates with pivot distance tables.

Every document gets a 64-bit fingerprint; equal fingerprints collapse to one. Two fingerprints that differ in at most
``radius`` bits agree on all but ``radius`` of ``blocks`` bit blocks, so they share a key in at least one of the tables keyed on
``blocks - radius`` blocks: no link is lost. Inside a key's bucket the Hamming distances to fixed reference
fingerprints (pivots) are computed once per fingerprint. By the triangle inequality a pair whose distances to any one pivot differ
by more than ``radius`` cannot be a link; what is left is verified. A bucket reports one edge per member that joins
something, not all its links, which is enough for components.

The number of blocks follows the number of fingerprints, so that buckets of unrelated fingerprints stay small. A bucket of more than ``tile``
fingerprints (a dense group of near copies) is split into tiles, every pair of which meets in a task of its own: bounded
memory, no pair lost.

``similar_documents`` is the form for links by similarity (five-word shingles, 0.8 or more). Documents that share a window of
shingles that follow each other in the order of their hashes, directly or through others, form a cluster: no link is lost (see ``window_sizes``). Inside a cluster tables of the
distances to pivots, which are some of its sets, discard pairs, counts of shingles by the range of their hash discard further ones, both by bounds that hold for every pair, and shared
shingles, counted exactly, decide on the rest: the links are all pairs at the similarity or more, and no others.

Null and empty texts have fingerprint zero and are linked like any other. A null id never becomes a component id unless
the component has no other; repeated rows give repeated results; a text of any length is shingled whole, in parts of bounded memory; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import attach_group, fresh, map_texts, read_documents, staged
from loamgrid.llm.graph import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
TILE = 4096
#: Groups of up to this many fingerprints are paired by index arrays; larger ones are walked.
SMALL = 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Reference fingerprints from a fixed seed.
PIVOTS = np.random.default_rng(20).integers(0, 2**64, (16, 1), dtype=np.uint64)
#: Links by similarity: ranges of hashes in which the shingles of a set are counted, and windows that a task sends on together, about.
RANGES, WINDOWS_AT_ONCE = 64, 250_000
#: Sets of a group that serve as pivots, at most, and shingles that a count looks at together, about.
SET_PIVOTS, SHINGLES_AT_ONCE = 16, 250_000
_ODD = np.random.default_rng(21).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Tables of oversized buckets of at most this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_BUCKETS = 20_000


def shingle_hashes(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of the lower-cased text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    body = b" ".join(words)
    n = len(words)
    if n <= shingle_words:
        return np.array([xxhash.xxh64_intdigest(body, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[: n - shingle_words] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(body[a:b], 42) for a, b in zip(starts, ends[shingle_words - 1 :].tolist(), strict=True)]
    return np.array(hashes, np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; zero if there are none."""
    if not len(hashes):
        return 0
    set_bits = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[part : part + 4096].astype("<u8").view(np.uint8), bitorder="little")
        set_bits += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, fp`` (the fingerprint's bits as a signed long)."""

    def run(texts: list[str | None]):
        return None, [np.fromiter((simhash(shingle_hashes(t)) for t in texts), np.uint64, len(texts)).view(np.int64)]

    return map_texts(docs, id_col, text_col, [("fp", "long", pa.int64())], run)


def block_masks(n_fingerprints: int, radius: int = RADIUS) -> list[int]:
    """Masks of the tables. The fewest blocks for which a key holds about four unrelated fingerprints or fewer."""
    blocks = radius + 2
    while n_fingerprints / 2.0 ** (64 * (blocks - radius) / blocks) > 4 and blocks < 2 * radius + 4:
        blocks += 1
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(block, blocks - radius)]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints, one row of 64-bit words each."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return distances(fps[:, None, :], pivots[None, :, :])


def linked_pairs(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs ``(a, b)`` of row numbers are links: the pivot tables discard, the fingerprints verify."""
    left = np.arange(len(a))
    for p in range(table.shape[1]):
        left = left[np.abs(table[a[left], p] - table[b[left], p]) <= radius]
    return left[distances(fps[a[left]], fps[b[left]]) <= radius]


def walk(fps: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (member, member that reached it) that connect each component inside one bucket."""
    edges, unseen = [], np.arange(len(fps))
    while len(unseen) > 1:
        frontier, unseen = [unseen[0]], unseen[1:]
        while frontier and len(unseen):
            x = frontier.pop()
            hit = linked_pairs(fps, table, unseen, np.full(len(unseen), x), radius)
            if len(hit):
                edges += [(y, x) for y in unseen[hit].tolist()]
                frontier += unseen[hit].tolist()
                unseen = np.delete(unseen, hit)
    return edges


def bucket_edges(group: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the edges inside each run of equal ``group`` numbers."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist():
        members = (starts[sizes == size][:, None] + np.arange(size)).ravel()
        own = fps[members]
        first = np.arange(0, len(members), size)
        i, j = np.triu_indices(size, 1)
        a, b = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
        table = pivot_table(own, PIVOTS)
        hit = linked_pairs(own, table, a, b, radius)
        us.append(members[a[hit]])
        vs.append(members[b[hit]])
    for k in np.flatnonzero(sizes > SMALL).tolist():
        own = fps[starts[k] : starts[k] + sizes[k]]
        found = np.array(walk(own, pivot_table(own, PIVOTS), radius), np.int64).reshape(-1, 2) + starts[k]
        us.append(found[:, 0])
        vs.append(found[:, 1])
    return np.concatenate(us), np.concatenate(vs)


def near_edges(distinct: DataFrame, n_fingerprints: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``u, v`` (fingerprints as longs) that connect all fingerprints within ``radius`` bits of each other."""
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(n_fingerprints, radius)]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]))
    return bucketed_edges(distinct.select("fp", keys.alias("k")).select("k.*", "fp"), radius, tile)


def bucketed_edges(keyed: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges ``u, v`` inside the buckets of ``table, key, fp``."""
    columns = keyed.columns
    large = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    large = staged(large.select(F.col("table").alias("_t"), F.col("key").alias("_k"), F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "buckets")
    side = F.broadcast(large) if large.count() <= BROADCAST_BUCKETS else large
    keyed = keyed.join(side, (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k")), "left")
    tiles = F.coalesce("tiles", F.lit(1))
    keyed = keyed.withColumn("own", F.pmod(F.xxhash64("fp"), tiles).cast("int"))
    keyed = keyed.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    keyed = keyed.select("table", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), *columns[2:])
    dealt = keyed.repartition("table", "key", "a", "b").sortWithinPartitions("table", "key", "a", "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            same = np.ones(len(held), bool)
            for c in ("table", "key", "a", "b"):
                same &= (held[c] == held[c].iloc[-1]).to_numpy()
            cut = len(held) - int(same.sum())  # the last bucket may go on in the next batch
            if cut:
                yield edges_of(held.iloc[:cut])
                held = held.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield edges_of(held)

    def edges_of(pdf: pd.DataFrame) -> pd.DataFrame:
        new = np.zeros(len(pdf), bool)
        for c in ("table", "key", "a", "b"):
            x = pdf[c].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        node = pdf["fp"].to_numpy()
        fps = node.view(np.uint64)[:, None]
        u, v = bucket_edges(np.cumsum(new), fps, radius)
        return pd.DataFrame({"u": node[u], "v": node[v]})

    return dealt.mapInPandas(run, "u long, v long")


def with_components(rows: DataFrame, distinct: DataFrame, edges: DataFrame, node: str, total: int) -> DataFrame:
    """Add ``component_id`` to ``rows``; ``distinct`` has each ``node`` once, with its ``min_id`` and number ``n`` of rows."""
    roots = connected_components(edges).select(F.col("node").alias("_node"), "root")
    linked = staged(distinct.join(roots, distinct[node] == F.col("_node")).select("_node", "root", "min_id"), "linked")
    smallest = linked.groupBy("root").agg(F.min("min_id").alias("smallest"), F.count(F.lit(1)).alias("members"))
    linked = attach_group(linked, smallest, ["root"], "members", ["smallest"], F.col("_node"), linked.count()).select("_node", "smallest")
    groups = distinct.join(linked, F.col(node) == F.col("_node"), "left").select(node, "n", F.coalesce("smallest", "min_id").alias("component_id"))
    return attach_group(rows, staged(groups, "groups"), [node], "n", ["component_id"], F.col("id"), total)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id``. Fingerprints within ``radius`` bits link."""
    rows = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("min_id"), F.count(F.lit(1)).alias("n")), "distinct")
    total, n = (distinct.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first())
    out = with_components(rows, distinct, near_edges(distinct, n, radius, tile), "fp", total)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@lru_cache(maxsize=100_000)
def window_sizes(n: int, similarity: float) -> list[tuple[int, int]]:
    """Window sizes of a set of ``n`` elements, each with the number of windows that it shares at least with any set that is its link by that size.

    Of two links of S elements together, o >= s S / (1 + s) are common and d = S - 2 o are not. In the order of all elements the d leave d + 1 gaps for the o, so one gap holds
    o / (d + 1) of them or more, which follow each other in both sets; over all gaps at least o - (w - 1) (d + 1) windows of w elements are common. For links of 0.8 that is four elements, less in small sets. Both
    sets of a pair work out the same size, as it depends on S only.
    """
    m = np.arange(max(1, math.ceil(similarity * n - 1e-6)), math.floor(n / similarity + 1e-6) + 1)
    total = n + m
    common = np.maximum(1, np.ceil(similarity * total / (1 + similarity) - 1e-6).astype(np.int64))
    gaps = total - 2 * common + 1
    met = (common <= np.minimum(n, m)) & ((m != n) | (gaps > 1))  # equal sets are one
    most = min(len(_ODD), math.ceil(similarity / max(1 - similarity, 1e-6) - 1e-6))  # larger windows are never needed
    size = np.minimum(-(-common // np.maximum(gaps, 1)), most)
    least = np.maximum(1, common - (size - 1) * gaps)
    return [(w, int(least[met & (size == w)].min())) for w in np.unique(size[met]).tolist()]


def windows(hashes: np.ndarray, similarity: float) -> np.ndarray:
    """Keys of which any two links share one: per window size the windows with the smallest keys, less those that can be spared as links share several."""
    out = [np.empty(0, np.uint64)]
    for size, least in window_sizes(len(hashes), similarity):
        n = len(hashes) - size + 1
        keys = np.full(n, size, np.uint64)
        for k in range(size):
            keys = (keys ^ hashes[k : k + n]) * _ODD[k]
            keys ^= keys >> np.uint64(29)
        out.append(np.sort(keys)[: n - least + 1])
    return np.concatenate(out)


def set_node(hashes: np.ndarray) -> int:
    """What stands for a set of shingle hashes."""
    return xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), 23) - (1 << 63)


def profile(hashes: np.ndarray) -> np.ndarray:
    """Shingles in each of ``RANGES`` ranges of hashes: two sets have at least as many elements that are not common as their profiles differ."""
    return np.bincount((hashes // np.uint64(2**64 // RANGES)).astype(np.int64), minlength=RANGES)


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> dict:
    """What tells rows apart: a hash of id and text, and the text's MD5."""
    return {"key": F.xxhash64(id_col, text_col), "sha": F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))}


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """Per row ``id``, its ``key`` and ``sha``, ``node`` (of the set of shingles) and ``n_shingles``."""

    def run(texts: list[str | None]):
        sets = [np.unique(shingle_hashes(t, shingle_words)) for t in texts]
        return None, [list(map(set_node, sets)), list(map(len, sets))]

    who = F.struct(F.col(id_col).alias("id"), *[c.alias(k) for k, c in _row_key(docs, id_col, text_col).items()])
    rows = map_texts(docs.select(who.alias("_who"), F.col(text_col).alias("_body")), "_who", "_body", [("node", "long", pa.int64()), ("n_shingles", "long", pa.int64())], run, "who")
    return staged(rows.select("who.*", "node", "n_shingles"), "signatures")


def neighbours(docs: DataFrame, text_col: str, similarity: float, shingle_words: int) -> DataFrame:
    """Edges ``u, v`` that connect all nodes which share a window, and so all links.

    A task sends the windows of a set once, however many rows have it. The nodes of a window are chained in their order as they stream by, so no task holds a window's nodes.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, nodes, keys, n = set(), [], [], 0
        for batch in batches:
            for value in batch.column(0):
                hashes = np.unique(shingle_hashes(value.as_py(), shingle_words))
                if (node := set_node(hashes)) in seen:
                    continue
                seen.add(node)
                keys.append(windows(hashes, similarity))
                nodes.append(np.full(len(keys[-1]), node))
                n += len(keys[-1])
                if n >= WINDOWS_AT_ONCE:
                    yield sent(nodes, keys)
                    nodes, keys, n = [], [], 0
        if n:
            yield sent(nodes, keys)

    def sent(nodes: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], ["key", "node"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [np.empty(0, np.int64)] * 2
        for batch in batches:
            key, node = (np.concatenate((x, c.to_numpy())) for x, c in zip(last, batch.columns, strict=True))
            same = (key[1:] == key[:-1]) & (node[1:] != node[:-1])
            pairs = np.unique(np.stack((node[:-1][same], node[1:][same]), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in pairs.T], ["u", "v"])
            last = [key[-1:], node[-1:]]

    keyed = docs.select(F.col(text_col).alias("_text")).mapInArrow(cut, "key long, node long")
    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(chain, "u long, v long")


def shingle_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """Add ``shingles`` (sorted 64-bit hashes) to ``members`` (``cluster, node, key, sha``), from the texts of these rows only."""
    own = members.withColumnsRenamed({"key": "_key", "sha": "_sha"})
    texts = docs.select(F.col(text_col).alias("_body"), *[c.alias(k) for k, c in _row_key(docs, id_col, text_col).items()])
    met = texts.join(own, (F.col("key") == F.col("_key")) & (F.col("sha") == F.col("_sha")))
    who = F.struct("cluster", "node").alias("_who")

    def run(texts: list[str | None]):
        return None, [[np.unique(shingle_hashes(t, shingle_words)).astype("<u8").tobytes() for t in texts]]

    sets = map_texts(met.select(who, "_body"), "_who", "_body", [("shingles", "binary", pa.binary())], run, "who")
    return sets.select("who.*", "shingles").dropDuplicates(["node"])  # rows alike in id and text come more than once


def similar_edges(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, similarity: float, shingle_words: int, tile: int = TILE) -> DataFrame:
    """Edges ``u, v`` that connect all nodes whose sets are links (see ``walk_sets``).

    ``rows``: the ``signatures`` of ``docs``. Nodes that share windows, directly or through others, form a cluster; nodes that share none are done. A
    set goes once to its cluster; a cluster above ``tile`` sets (or 512 shingles a set) is split into tiles, every pair of which meets.
    """
    clusters = connected_components(neighbours(docs, text_col, similarity, shingle_words))
    clusters = clusters.select(F.col("node").alias("_node"), F.col("root").alias("cluster"))
    one = rows.groupBy("node").agg(F.min(F.struct("key", "sha", "n_shingles")).alias("r"))  # equal sets: any row stands for its node
    members = staged(one.join(clusters, F.col("node") == F.col("_node")).select("cluster", "node", "r.*"), "members")
    large = members.groupBy("cluster").agg(F.ceil(F.greatest(F.count(F.lit(1)) / tile, F.sum("n_shingles") / (512 * tile))).cast("int").alias("tiles"))
    large = staged(large.filter("tiles > 1").withColumnRenamed("cluster", "_c"), "clusters")
    side = F.broadcast(large) if large.count() <= BROADCAST_BUCKETS else large
    sets = shingle_sets(docs, members, id_col, text_col, shingle_words)
    sets = sets.join(side, F.col("cluster") == F.col("_c"), "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    sets = sets.withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    sets = sets.select("cluster", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "shingles")
    dealt = sets.repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held = None, []
        for pdf in batches:
            for k, part in pdf.groupby(["cluster", "a", "b"], sort=False):
                if k != place and held:
                    yield edges_of(pd.concat(held))
                    held = []
                place = k
                held.append(part)
        if held:
            yield edges_of(pd.concat(held))

    def edges_of(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf["node"].to_numpy()
        sets = [np.frombuffer(x, "<u8") for x in pdf["shingles"]]
        found = walk_sets(np.array([profile(x) for x in sets], np.int32), sets, similarity)
        return pd.DataFrame({"u": node[[x for x, _ in found]], "v": node[[y for _, y in found]]}, dtype=np.int64)

    return dealt.mapInPandas(run, "u long, v long")


class ShingleSets:
    """The sets of a group, their shingles numbered, so that what one shares with many others is counted at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        self.codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        self.mark = np.zeros(len(self.codes) + 1, bool)

    def shared(self, x: int, others: np.ndarray) -> np.ndarray:
        """Shingles that set ``x`` shares with each of ``others``, exactly."""
        own = self.codes[self.bounds[x] : self.bounds[x + 1]]
        self.mark[own] = True
        parts = np.flatnonzero(np.diff(np.cumsum(self.sizes[others]) // SHINGLES_AT_ONCE)) + 1
        out = [self._marked(part) for part in np.split(others, parts)]
        self.mark[own] = False
        return np.concatenate(out)

    def _marked(self, others: np.ndarray) -> np.ndarray:
        n = self.sizes[others]
        ends = np.cumsum(n)
        at = np.arange(n.sum()) + np.repeat(self.bounds[others] - ends + n, n)
        hits = np.concatenate(([0], np.cumsum(self.mark[self.codes[at]])))
        return hits[ends] - hits[ends - n]

    def pivots(self, similarity: float) -> tuple[dict[int, np.ndarray], np.ndarray]:
        """Pivots among the sets, each with what it shares with every set, and the table of all sets' distances (one less the similarity) to them.

        The next pivot is the set furthest from those before; there are as many as halvings of the group, ``SET_PIVOTS`` at most, and fewer if every set is a link of one.
        """
        every, shared, x = np.arange(len(self.sizes)), {}, 0
        table = np.empty((len(every), 0))
        while len(shared) < max(1, min(SET_PIVOTS, len(every).bit_length() - 1)):
            shared[x] = self.shared(x, every)
            either = self.sizes + self.sizes[x] - shared[x]
            table = np.column_stack((table, np.where(either > 0, 1 - shared[x] / np.maximum(either, 1), 0.0)))
            x = int(table.min(axis=1).argmax())
            if table[x].min() <= 1 - similarity:
                break
        return shared, table


def walk_sets(profiles: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges that connect each component of sets, whose links are the pairs that share shingles enough for ``similarity``.

    Pairs of sets too different in size are no links. One less the similarity is a metric, so a pair whose distances to any one pivot differ by more than one less ``similarity`` is no link
    either: the pivot tables discard it, whatever the size of its sets. So does a pair whose ``profiles`` differ by more elements than links have that are not common.
    What survives is verified by counting shared shingles.
    """
    group = ShingleSets(sets)
    sizes, (known, table) = group.sizes, group.pivots(similarity)
    far, apart = 1 - similarity + 1e-6, (1 - similarity) / (1 + similarity)
    edges, unseen = [], np.arange(len(sets))
    while len(unseen) > 1:
        frontier, unseen = [unseen[0]], unseen[1:]
        while frontier and len(unseen):
            x = int(frontier.pop())
            if x in known:
                may, shared = np.arange(len(unseen)), known[x][unseen]
            else:
                may = np.flatnonzero(np.minimum(sizes[unseen], sizes[x]) >= similarity * np.maximum(sizes[unseen], sizes[x]) - 1e-9)
                may = may[(np.abs(table[unseen[may]] - table[x]) <= far).all(axis=1)]
                other = np.abs(profiles[unseen[may]] - profiles[x]).sum(axis=1)
                may = may[other <= apart * (sizes[unseen[may]] + sizes[x]) + 1e-6]
                shared = group.shared(x, unseen[may])
            hit = may[shared >= similarity * (sizes[unseen[may]] + sizes[x] - shared) - 1e-9]
            if len(hit):
                edges += [(y, x) for y in unseen[hit].tolist()]
                frontier += unseen[hit].tolist()
                unseen = np.delete(unseen, hit)
    return edges


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, shingle_words: int = 5, tile: int = TILE
) -> DataFrame:
    """One row per input row: id, ``component_id``, the smallest id reachable over links of ``similarity`` or more."""
    rows = signatures(docs, id_col, text_col, shingle_words)
    distinct = staged(rows.groupBy("node").agg(F.min("id").alias("min_id"), F.count(F.lit(1)).alias("n")), "distinct")
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    edges = similar_edges(docs, rows, id_col, text_col, similarity, shingle_words, tile)
    out = with_components(rows.select("id", "node"), distinct, edges, "node", total)
    return out.select(F.col("id").alias(id_col), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """The documents that stay, with all columns: of each component of similar documents the row with the smallest id (null last).

    Rows are told apart by id and text, so different texts under one id, or without id, stand for themselves; rows alike in both are one.
    """
    key, sha, keep_key, keep_sha = fresh(docs, "_key", "_sha", "_k", "_s")
    rows = signatures(docs, id_col, text_col, shingle_words)
    edges = similar_edges(docs, rows, id_col, text_col, similarity, shingle_words)
    roots = connected_components(edges).select(F.col("node").alias("_node"), "root")
    person = F.struct(F.col("id").isNull().alias("last"), "id", "key", "sha")
    firsts = rows.groupBy("node").agg(F.min(person).alias("first")).join(roots, F.col("node") == F.col("_node"), "left")
    keep = firsts.groupBy(F.coalesce("root", "node").alias("c")).agg(F.min("first").alias("first")).select(F.col("first.key").alias(keep_key), F.col("first.sha").alias(keep_sha))
    digest = _row_key(docs, id_col, text_col)
    own = docs.withColumns({key: digest["key"], sha: digest["sha"]})
    own = own.join(keep, (F.col(key) == F.col(keep_key)) & (F.col(sha) == F.col(keep_sha)), "left_semi")
    return own.dropDuplicates([key, sha]).drop(key, sha)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir))
