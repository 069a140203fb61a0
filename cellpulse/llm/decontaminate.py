"""Benchmark decontamination by the q-gram lemma.

A region of a text that is within k edits of an item of m characters shares at least m + 1 - q (k + 1) of the
item's q-grams with it, and these lie on at most k + 1 neighbouring diagonals (text position less item
position). Shared q-grams are counted in overlapping diagonal bands of 2 (k + 1), bands that reach the bound
are kept, and what they cover is verified by banded alignment.

Characters are compared without case and with every white space character as a space; k is a share of the
item's length. Items go to the tasks as sorted arrays, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.memory import streaming

Q, RATE = 8, 0.1
#: Bound of the items in one block, in characters, and the size of the table that is asked first, in bits.
BLOCK_CHARS, TABLE_BITS = 1 << 21, 21
#: Characters of a text that are searched at once.
CHUNK = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15


@cache
def _folded() -> np.ndarray:
    """Lower case of every code point that has one of a single character; white space is a space."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        if not 0xD800 <= c < 0xE000:
            low = chr(c).lower()
            table[c] = 32 if chr(c).isspace() else ord(low) if len(low) == 1 else c
    return table


def folded(text: str) -> np.ndarray:
    return _folded()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q characters from each position on, by doubling."""
    h, power, length = points.astype(np.uint64), MULTIPLIER, 1
    while length < Q:
        h = h[:-length] * np.uint64(power) + h[length:]
        power, length = power * power % (1 << 64), 2 * length
    return h * np.uint64(0xD6E8FEB86659FD93)


def budget(m: int) -> int:
    """Edits allowed for an item of m characters; at least one q-gram must be sure to be shared."""
    return max(0, min(int(RATE * m), m // Q - 1))


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        self.points = [folded(t) for _, t in items]
        self.k = np.array([budget(len(p)) for p in self.points], np.int64)
        self.needed = np.array([len(p) + 1 - Q * (k + 1) for p, k in zip(self.points, self.k.tolist())], np.int64)
        self.reach = max((len(p) + 4 * (k + 1) for p, k in zip(self.points, self.k.tolist())), default=0)
        hashes = [gram_hashes(p) for p in self.points]
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.keys >> np.uint64(64 - TABLE_BITS)] = True

    def candidates(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of the regions whose bands reach the bound."""
        if len(points) < Q or not len(self.keys):
            return []
        h = gram_hashes(points)
        at = np.flatnonzero(self.table[h >> np.uint64(64 - TABLE_BITS)])
        key = np.searchsorted(self.keys, h[at])
        key[key == len(self.keys)] = 0
        same = self.keys[key] == h[at]
        at, key = at[same], key[same]
        many = self.many[key]
        if many.sum() < self.needed.min():
            return []
        before = np.cumsum(many) - many
        entry = np.repeat(self.first[key] - before, many) + np.arange(many.sum())
        item = self.item[entry]
        width = self.k[item] + 1
        # Diagonals are never negative with the longest item added.
        diagonal = np.repeat(at, many) - self.place[entry] + self.reach
        row = item << 40 | diagonal // width
        band, n = np.unique(row, return_counts=True)
        both = n.copy()
        pair = np.flatnonzero(band[1:] == band[:-1] + 1)
        both[pair] += n[pair + 1]
        found: list[tuple[int, int, int]] = []
        for b in band[both >= self.needed[band >> 40]].tolist():
            i, d = b >> 40, (b & (1 << 40) - 1)
            # The lemma is about different q-grams of the item and of the text: repeats count once.
            inside = (row == b) | (row == b + 1)
            grams = np.unique(self.place[entry[inside]]), np.unique(np.repeat(at, many)[inside])
            if min(map(len, grams)) < self.needed[i]:
                continue
            k = int(self.k[i])
            low = d * (k + 1) - self.reach
            start, end = max(0, low - k), min(len(points), low + 2 * (k + 1) + len(self.points[i]) + k)
            if found and found[-1][0] == i and start <= found[-1][1] + k + 1:  # the other half of the same band
                start, end = found[-1][1], max(end, found.pop()[2])
            found.append((i, start, end))
        return found

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of all regions of a text within an item's budget, overlaps reduced to the best."""
        text, found = text or "", []
        for begin in range(0, max(1, len(text)), CHUNK):
            points = folded(text[begin : begin + CHUNK + self.reach])
            for i, a, b in self.candidates(points):
                best = aligned(self.points[i], points[a:b], int(self.k[i]))
                if best:
                    found.append((best[2], i, begin + a + best[0], begin + a + best[1]))
        kept: list[tuple[int, int, int, int]] = []
        for edits, i, a, b in sorted(set(found)):
            if not any(i == j and a < d and c < b for j, c, d, _ in kept):
                kept.append((i, a, b, edits))
        return kept


def _ends(item: np.ndarray, region: np.ndarray, k: int, free: bool) -> np.ndarray:
    """Edits of aligning the whole item with the region up to each end; `free`: starting anywhere in it. Ends
    early, with more than k everywhere, when no cell of a row is within k."""
    steps = np.arange(len(region) + 1)
    row = np.zeros_like(steps) if free else steps.copy()
    for i, c in enumerate(item.tolist(), 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[1:] + 1, row[:-1] + (region != c), out=new[1:])
        row = np.minimum.accumulate(new - steps) + steps
        if not i & 7 and row.min() > k:
            break
    return row


def aligned(item: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int, int] | None:
    """Start, end and edits of the best place of the item in the region, the last of equals; None above k edits.

    The region is a band's own stretch of text, so its rows are the band of the alignment."""
    if len(region) >= len(item):
        view = np.lib.stride_tricks.sliding_window_view(region, len(item))
        exact = np.flatnonzero((view == item).all(axis=1))
        if len(exact):
            return int(exact[0]), int(exact[0]) + len(item), 0
    ends = _ends(item, region, k, True)
    end = len(ends) - 1 - int(np.argmin(ends[::-1]))
    if ends[end] > k:
        return None
    starts = _ends(item[::-1], region[:end][::-1], k, False)
    return end - int(np.argmin(starts)), end, int(ends[end])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Items with at least Q characters, in blocks of at most BLOCK_CHARS (a longer item is a block)."""
    items = benchmark.filter(F.length("text") >= Q).select("item_id", F.col("text").cast("string"))
    block: list[tuple] = []
    size = 0
    for row in items.toLocalIterator():
        if block and size + len(row.text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (characters of the text) and edits of every leaked passage.

    A document without one has no row. Null and empty texts leak nothing; null ids stay; repeated rows and
    repeated items give rows each. Items shorter than Q characters have no q-gram and match nothing. Other
    columns are not read. The documents are read once per block of items.
    """
    base = docs.select("doc_id", F.col("text").cast("string"))
    kind = base.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, start int, end int, edits int"
    spark, result = docs.sparkSession, None
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(Index(block))

        def rows(batches, shared=shared):
            index = shared.value
            for batch in batches:
                ids = batch.column(0)
                found = [(n, *x) for n, t in enumerate(batch.column(1).to_pylist()) for x in index.leaks(t)]
                if found:
                    n, i, a, b, edits = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(n)), pa.array([index.ids[x] for x in i]), *(pa.array(x, pa.int32()) for x in (a, b, edits))],
                        names=["doc_id", "item_id", "start", "end", "edits"],
                    )

        part = base.mapInArrow(streaming(rows), schema)
        result = part if result is None else result.unionAll(part)
    return result if result is not None else spark.createDataFrame([], schema)


def leaking_removed(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no benchmark passage. Every block of items is asked
    about what the blocks before it have kept.

    Null and empty texts hold none and stay, rows without an id are judged by their text, repeated rows stay or go
    together; without items all rows stay, an empty table stays empty.
    """
    spark, schema = docs.sparkSession, docs.schema
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(Index(block))

        def rows(batches, shared=shared):
            for batch in batches:
                yield batch.filter(pa.array([not shared.value.leaks(t) for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(streaming(rows), schema)
    return docs
