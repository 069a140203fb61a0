"""Approximate nearest neighbours by largest inner product: a navigable small-world graph per shard.

Vectors are dealt to shards of bounded size by a hash, among those of equal length and of a norm within a factor of
two. In a shard, equal vectors are one node with a list of ids, and one more component, sqrt(norm of the longest ^ 2 -
own norm ^ 2), makes all nodes equally long, so that the largest inner product is the nearest node. The graph has
layers (Malkov and Yashunin): a node's top layer is drawn geometrically, nodes are inserted in the order of their top
layers, a batch at a time, each linked to a diverse choice of the nodes that a beam search finds, and lists that
overflow are chosen anew. Nodes that no path reaches in the end get a link from the nearest node that has one to
spare, so a beam as wide as the shard finds everything. A shard is stored as flat arrays: vectors, ids, and for each
layer one array of neighbours of fixed width.

A search meets every shard with blocks of queries: a beam from the upper layers down gives candidates, which are
scored exactly, in double precision, on the original vectors; the results of the shards are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.memory import cogrouped, grouped, streaming
from cellpulse.staging import written

#: Bounds of a shard in vectors and bytes, and of the queries that one task searches for.
SHARD_ROWS, SHARD_BYTES, QUERY_BYTES = 8192, 32 << 20, 16 << 20
#: Links a new node gets, width of a list in upper layers and in the lowest one, and places kept for late links.
LINKS, UPPER, LOWEST, LATE = 16, 16, 32, 2
#: Width of the beam while building and while searching, nodes of it that are expanded at a time, nodes of a batch.
BUILD, SEARCH, STEP, BATCH = 64, 128, 4, 512
SEED = 42


# --- the graph of a shard ----------------------------------------------------------------------------


def beam(nodes: np.ndarray, lists: np.ndarray, wanted: np.ndarray, begin: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, inner products), best first and -1 where there are none, of a beam search for each row of `wanted` that
    begins at its row of nodes in `begin` (-1: none). All rows go on in step."""
    n, rows = len(nodes), len(wanted)
    seen = np.zeros((rows, n + 1), bool)
    seen[:, n] = True
    ids = np.full((rows, width), -1)
    near = np.full((rows, width), -np.inf, np.float32)
    spent = np.ones((rows, width), bool)
    live = np.arange(rows)
    fresh = begin
    while len(live):
        fresh = np.where(fresh < 0, n, fresh)
        fresh.sort(axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = n
        r, c = np.nonzero(~seen[live[:, None], fresh])
        found = fresh[r, c]
        seen[live[r], found] = True
        value = np.full(fresh.shape, -np.inf, np.float32)
        value[r, c] = np.einsum("ij,ij->i", nodes[found], wanted[live[r]])
        fresh[value == -np.inf] = -1
        all_near = np.concatenate([near[live], value], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        near[live] = np.take_along_axis(all_near, best, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], fresh], axis=1), best, 1)
        spent[live] = np.take_along_axis(np.concatenate([spent[live], fresh < 0], axis=1), best, 1)
        live = live[~spent[live].all(axis=1)]
        if not len(live):
            break
        # The best ones that haven't been expanded: lists are in order, so a stable sort puts them first.
        next_ = np.argsort(spent[live], axis=1, kind="stable")[:, :STEP]
        open_ = ~np.take_along_axis(spent[live], next_, 1)
        centre = np.where(open_, np.take_along_axis(ids[live], next_, 1), -1)
        spent[live[:, None], next_] = True
        fresh = np.where(centre[:, :, None] < 0, -1, lists[centre]).reshape(len(live), -1)
    return ids, near


def diverse(nodes: np.ndarray, ids: np.ndarray, near: np.ndarray, count: int) -> np.ndarray:
    """For each row of candidates, best first (-1: none), `count` of them: first those that are nearer to the centre
    than to any chosen one, then the best others."""
    width = ids.shape[1]
    if width <= count:
        return np.pad(ids, ((0, 0), (0, count - width)), constant_values=-1)
    points = nodes[ids]
    among = points @ points.transpose(0, 2, 1)
    there = ids >= 0
    chosen = np.zeros(ids.shape, bool)
    for k in range(width):
        hidden = (chosen[:, :k] & (among[:, k, :k] >= near[:, k, None])).any(axis=1)
        chosen[:, k] = there[:, k] & ~hidden & (chosen[:, :k].sum(axis=1) < count)
    order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :count]
    return np.take_along_axis(ids, order, 1)


class Graph:
    """Layers of neighbour lists over equally long vectors; node order is insertion order, so a layer's nodes are the
    first ones."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        chance = np.random.default_rng(SEED)
        top = np.minimum((-np.log(1 - chance.random(n)) / math.log(LINKS)).astype(int), 16)
        top -= top.min() if n else 0
        self.order = np.argsort(-top, kind="stable")
        self.nodes = np.ascontiguousarray(vectors[self.order], np.float32)
        levels = top[self.order]
        self.sizes = [int((levels >= k).sum()) for k in range(int(levels[0]) + 1)] if n else []
        self.lists = [np.full((size, (LOWEST if k == 0 else UPPER) + LATE), -1, np.int32) for k, size in enumerate(self.sizes)]
        begin = 0
        for level in range(len(self.sizes) - 1, -1, -1):
            while begin < self.sizes[level]:
                end = min(self.sizes[level], begin + min(BATCH, max(LINKS, begin)))
                self._insert(begin, end, level)
                begin = end
        if n:
            self._reach_all()

    def _insert(self, begin: int, end: int, level: int):
        batch = self.nodes[begin:end]
        own = np.arange(begin, end)
        inside = batch @ batch.T
        np.fill_diagonal(inside, -np.inf)
        start = self._descended(batch, level + 1) if begin else None
        for layer in range(level, -1, -1):
            ids, near = own[None, :].repeat(len(own), 0), inside
            if begin:
                found, value = beam(self.nodes[:begin], self.lists[layer][:begin], batch, start, BUILD)
                start = found[:, :STEP]
                ids, near = np.concatenate([found, ids], axis=1), np.concatenate([value, near], axis=1)
            best = np.argsort(-near, axis=1, kind="stable")[:, :BUILD]
            near = np.take_along_axis(near, best, 1)
            ids = np.where(near == -np.inf, -1, np.take_along_axis(ids, best, 1))
            chosen = diverse(self.nodes, ids, near, LINKS)
            self.lists[layer][begin:end, :LINKS] = chosen
            r, c = np.nonzero(chosen >= 0)
            self._link_back(layer, chosen[r, c], own[r])

    def _descended(self, wanted: np.ndarray, down_to: int) -> np.ndarray:
        """Nodes at which the search in the layer below `down_to` begins."""
        start = np.zeros((len(wanted), 1), int)
        for layer in range(len(self.lists) - 1, down_to - 1, -1):
            size = self.sizes[layer]
            start = beam(self.nodes[:size], self.lists[layer], wanted, start, STEP)[0]
        return start

    def _link_back(self, layer: int, at: np.ndarray, new: np.ndarray):
        """Adds `new` to the lists of the nodes `at`; lists that overflow are chosen anew."""
        lists, width = self.lists[layer], LOWEST if layer == 0 else UPPER
        order = np.lexsort((new, at))
        at, new = at[order], new[order]
        known = (lists[at] == new[:, None]).any(axis=1)
        at, new = at[~known], new[~known]
        while len(at):
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            now = place < width
            targets = at[first]
            wide = np.full((len(targets), 2 * width), -1)
            wide[:, :width] = lists[targets, :width]
            wide[np.searchsorted(targets, at[now]), width + place[now]] = new[now]
            for a in range(0, len(targets), BATCH):
                ids, centre = wide[a : a + BATCH], self.nodes[targets[a : a + BATCH]]
                near = np.where(ids < 0, -np.inf, np.einsum("ijk,ik->ij", self.nodes[ids], centre))
                best = np.argsort(-near, axis=1, kind="stable")
                ids, near = np.take_along_axis(ids, best, 1), np.take_along_axis(near, best, 1)
                chosen = ids[:, :width].copy()
                full = np.flatnonzero(ids[:, width] >= 0)
                if len(full):
                    chosen[full] = diverse(self.nodes, ids[full], near[full], width)
                lists[targets[a : a + BATCH], :width] = chosen
            at, new = at[~now], new[~now]

    def _reached(self, reached: np.ndarray, front: np.ndarray):
        """Adds all that is reachable from `front` in the lowest layer."""
        while len(front):
            reached[front] = True
            front = np.unique(self.lists[0][front])
            front = front[(front >= 0)]
            front = front[~reached[front]]

    def _reach_all(self):
        lists = self.lists[0]
        reached = np.zeros(len(self.nodes), bool)
        self._reached(reached, np.zeros(1, int))
        while not reached.all():
            lost = int(np.argmin(reached))
            spare = np.flatnonzero(reached & (lists[:, -1] < 0))
            nearest = int(spare[np.argmax(self.nodes[spare] @ self.nodes[lost])])
            lists[nearest, -LATE + int(lists[nearest, -LATE] >= 0)] = lost
            self._reached(reached, np.array([lost]))

    def search(self, wanted: np.ndarray, width: int = SEARCH) -> np.ndarray:
        """Nodes found for each row, best first."""
        return beam(self.nodes, self.lists[0], wanted, self._descended(wanted, 1), width)[0]


# --- shards ------------------------------------------------------------------------------------------


def measured(batches):
    """Of rows (id, v) those whose vector takes part, with its length and the binary exponent of its norm: not null, not
    empty, not zero, all components finite numbers."""
    for batch in batches:
        there = pc.fill_null(pc.greater(pc.list_value_length(batch.column("v")), 0), False)
        batch = batch.filter(there)
        sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
        if not len(sizes):
            continue
        size = np.abs(batch.column("v").flatten().to_numpy(zero_copy_only=False))  # a null is not a number
        first = np.cumsum(sizes) - sizes
        largest = np.maximum.reduceat(size, first)
        usable = np.isfinite(largest) & (largest > 0)
        scale = np.where(usable, largest, 1.0)
        # Divided by the largest component, squares neither overflow nor vanish.
        square = np.add.reduceat((size / np.repeat(scale, sizes)) ** 2, first)
        band = np.floor(np.log2(scale) + np.log2(np.where(usable, square, 1.0)) / 2).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("v"), pa.array(sizes.astype(np.int32)), pa.array(band)], names=["id", "v", "dim", "band"]
        ).filter(pa.array(usable))


def _rows(table: DataFrame, id_: str, vector: str) -> DataFrame:
    """Distinct ids and vectors that take part, with their length and the binary exponent of their norm."""
    rows = table.select(F.col(id_).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(streaming(measured), "id bigint, v array<double>, dim int, band int").distinct()


KEYS = ["dim", "band", "bucket"]
INDEX = (
    "dim int, band int, bucket int, vectors binary, ids binary, ends binary, nodes binary, sizes array<int>, lists array<binary>"
)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _built(group: pa.Table) -> pa.Table:
    """The stored graph of a shard."""
    dim = group.column("dim")[0].as_py()
    vectors = _matrix(group.column("v"), dim) + 0.0  # no negative zeros
    ids = np.array([-1 if i is None else i for i in group.column("id").to_pylist()], np.int64)
    null = np.array(group.column("id").is_null())
    # Equal vectors are one node; ids in order, null last.
    _, first, node = np.unique(vectors.view(f"V{8 * dim}").ravel(), return_index=True, return_inverse=True)
    vectors = vectors[first]
    largest = np.abs(vectors).max(axis=1)
    norms = largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(axis=1))
    longest = norms.max()
    unit = vectors / longest if np.isfinite(longest) else vectors / largest.max() / math.sqrt(dim)
    rest = np.sqrt(np.maximum(0.0, 1.0 - (unit**2).sum(axis=1)))
    graph = Graph(np.c_[unit, rest])
    place = np.empty(len(vectors), int)
    place[graph.order] = np.arange(len(vectors))
    order = np.lexsort((ids, null, place[node]))
    ends = np.cumsum(np.bincount(place[node], minlength=len(vectors)))
    row = (
        dim, group.column("band")[0].as_py(), group.column("bucket")[0].as_py(), vectors[graph.order].tobytes(),
        # A null id is stored behind the last one of its node.
        np.stack([ids[order], null[order]]).tobytes(), ends.astype(np.int64).tobytes(), graph.nodes.tobytes(),
        graph.sizes, [x.tobytes() for x in graph.lists],
    )
    types = [pa.int32()] * 3 + [pa.binary()] * 4 + [pa.list_(pa.int32()), pa.list_(pa.binary())]
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)


class _Stored(Graph):
    """A shard read back."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.vectors = np.frombuffer(row["vectors"]).reshape(-1, dim)
        self.nodes = np.frombuffer(row["nodes"], np.float32).reshape(-1, dim + 1)
        self.ids, self.null = np.frombuffer(row["ids"], np.int64).reshape(2, -1)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.sizes = row["sizes"]
        self.lists = [np.frombuffer(x, np.int32).reshape(n, -1) for x, n in zip(row["lists"], self.sizes)]


def indexed(table: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The written index: one row per shard.

    Vectors that are null, empty or zero, or hold a null or a component that isn't finite, aren't indexed. Rows that
    repeat an id and its vector are one; rows without an id are indexed. An empty table gives an empty index.
    """
    rows = _rows(table, id_, vector)
    room = F.least(F.lit(SHARD_ROWS), F.greatest(F.lit(1), F.floor(F.lit(SHARD_BYTES) / (8 * F.col("dim")))))
    sizes = rows.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / room).cast("int").alias("buckets"))
    dealt = rows.join(sizes, ["dim", "band"]).withColumn("bucket", F.pmod(F.xxhash64("id", "v"), F.col("buckets")).cast("int"))
    return written(dealt.select("id", "v", *KEYS).groupBy(*KEYS).applyInArrow(grouped(_built), INDEX), "index")


# --- searching ---------------------------------------------------------------------------------------


def _found(k: int, width: int):
    """The `k` best rows of a shard for each query of a block."""
    names = ["query_id", "query", "vec_id", "score"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def rows(index: pa.Table, asked: pa.Table) -> pa.Table:
        if not index.num_rows or not asked.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        shard = _Stored(index.to_pylist()[0])
        parts = []
        for a in range(0, asked.num_rows, BATCH):
            some = asked.slice(a, BATCH)
            wanted = _matrix(some.column("v"), shard.vectors.shape[1])
            unit = wanted / np.abs(wanted).max(axis=1, keepdims=True)
            unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
            nodes = shard.search(np.c_[unit, np.zeros(len(unit))].astype(np.float32), width)
            r, c = np.nonzero(nodes >= 0)
            node = nodes[r, c]
            # Added up from the first component to the last, so that the sum doesn't depend on the machine.
            score = np.zeros(len(node))
            for d in range(wanted.shape[1]):
                score += shard.vectors[node, d] * wanted[r, d]
            # Of a node's ids only the first k, and one more for the query's own, can be among the k best.
            first = np.where(node > 0, shard.ends[node - 1], 0)
            count = np.minimum(shard.ends[node] - first, k + 1)
            r, score = np.repeat(r, count), np.repeat(score, count)
            at = np.repeat(first, count) + np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
            ids, null = shard.ids[at], shard.null[at]
            own = np.asarray(some.column("id").to_pylist())
            other = (ids != own[r]) | (null == 1)
            r, score, ids, null = r[other], score[other], ids[other], null[other]
            order = np.lexsort((ids, null, -score, r))
            r, score, ids, null = r[order], score[order], ids[order], null[order]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            best = rank < k
            query = np.asarray(some.column("query").to_pylist())
            parts.append(pa.Table.from_arrays(
                [pa.array(own[r[best]], types[0]), pa.array(query[r[best]], types[1]),
                 pa.array(ids[best], types[2], mask=null[best] == 1), pa.array(score[best], types[3])], names=names,
            ))
        return pa.concat_tables(parts)

    return rows


def searched(index: DataFrame, queries: DataFrame, k: int = 20, id_: str = "vec_id", vector: str = "embedding", width: int = SEARCH) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the `k` nearest found rows of an index for each query: largest
    inner product first, equal ones by vec_id, null last.

    Rows with the query's id aren't among its candidates. A query meets vectors of its own length only. Queries that
    are null, empty, zero or not finite, or have no id, take no part; queries that repeat an id and its vector are one,
    with another vector they are ranked apart. Fewer candidates than `k` are all returned.
    """
    rows = _rows(queries.filter(F.col(id_).isNotNull()), id_, vector).withColumn("query", F.xxhash64("v"))
    volume = rows.agg(F.sum(F.col("dim") * 8).cast("bigint")).first()[0] or 0
    blocks = max(1, math.ceil(volume / QUERY_BYTES))
    # Named anew: both sides of the cogroup come from the index.
    shards = index.groupBy("dim", "band").agg((F.max("bucket") + 1)).toDF("dim", "band", "buckets")
    keys = [*KEYS, "part"]
    asked = (
        rows.select("id", "query", "v", "dim", F.pmod("query", F.lit(blocks)).cast("int").alias("part")).join(shards, "dim")
        .withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).select(*keys, "id", "query", "v")
    )
    # An index row goes to each block of queries; a block is bounded, and so is the row.
    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        cogrouped(_found(k, max(width, k + 1))), "query_id bigint, query bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
