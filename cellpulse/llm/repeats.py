"""Exact repeats of 100 bytes or more by common-prefix interval trees.

Every window of 100 bytes names one of its 20-byte grams, the one of least hash: an anchor. Equal windows name
equal anchors at equal places, so repeats meet at their anchors. An anchor's context, up to 80 bytes on either
side of the gram, holds every window that names it. Anchors whose gram occurs once in the corpus are left out;
the contexts of the others are sorted by gram and following bytes, which is an enhanced suffix array over the
anchors. A stack scan of its common-prefix lengths gives the interval tree; the members of every interval are
split by the same scan over their preceding bytes, and a class is a maximal repeat if both its left and its
right extensions differ. Repeats that reach past a context are found as overlapping pieces, one per anchor.

How it travels: consecutive documents form a block. Blocks send their grams, then the contexts of repeated
grams, packed by range of the gram's hash; ranges answer each block with what concerns its documents. The blocks are
written once, and all later steps read that table: input that is split or ordered otherwise when it is read again
changes nothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpulse.staging import written

LENGTH, GRAM = 100, 20
SIDE = LENGTH - GRAM
#: A block ends with the document at which it has so many bytes; one range of hashes per so many bytes of text.
BLOCK_BYTES, RANGE_BYTES = 8 << 20, 8 << 20
#: Bytes of a document whose anchors are found at once; their places take the low bits of the hash.
PLACE_BITS = 20
CHUNK = (1 << PLACE_BITS) - 2 * LENGTH
MULTIPLIER = 0x9E3779B97F4A7C15


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows of a text, and the hashes of their grams."""
    places, hashes = [], []
    for begin in range(0, len(text) - LENGTH + 1, CHUNK):
        h = np.frombuffer(text, np.uint8, min(CHUNK + LENGTH - 1, len(text) - begin), begin).astype(np.uint64)
        powers, parts, length, power = {}, {}, 1, MULTIPLIER
        parts[1] = h
        while length < 16:
            powers[length] = power
            parts[2 * length] = parts[length][:-length] * np.uint64(power) + parts[length][length:]
            length, power = 2 * length, power * power % (1 << 64)
        h = parts[16][: len(h) - GRAM + 1] * np.uint64(powers[4]) + parts[4][16:]
        h = (h ^ h >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        least = h & ~np.uint64((1 << PLACE_BITS) - 1) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= SIDE + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = SIDE + 1 - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
        at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        places.append(at + begin)
        # The least of many hashes are small: mix them again, so that ranges of hashes are equal shares.
        key = h[at] * np.uint64(MULTIPLIER)
        hashes.append(key ^ key >> np.uint64(32))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, value) of the intervals of common-prefix length `least` or more with two or more members;
    lcp[i] belongs to members i - 1 and i, lcp[0] is not read."""
    stack: list[tuple[int, int]] = []  # (value, first member)
    for i in range(1, len(lcp) + 1):
        value, first = lcp[i] if i < len(lcp) else -1, i - 1
        while stack and stack[-1][0] > value:
            top, first = stack.pop()
            yield first, i - 1, top
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def _neighbours(texts: list[bytes]) -> list[int]:
    """Common-prefix length of each text with the one before it; 0 for the first."""
    if len(texts) < 24:
        return [0, *map(common, texts, texts[1:])]
    wide = np.zeros((len(texts), LENGTH + 1), np.uint8)
    sizes = np.array([min(len(t), LENGTH) for t in texts])
    wide[np.arange(LENGTH + 1) < sizes[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
    # Where one ends they differ at the latest.
    wide[:, LENGTH] = np.arange(len(texts)) & 1
    differ = (wide[1:] != wide[:-1]).argmax(axis=1)
    return [0, *np.minimum(differ, np.minimum(sizes[1:], sizes[:-1])).tolist()]


def maximal(contexts: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of LENGTH or more among distinct contexts of one gram, given as (preceding bytes from
    the gram backwards, gram and following bytes): bytes before the gram, bytes from it on, members."""
    if len(contexts) == 2:
        l, r = map(common, *contexts)
        if l + r >= LENGTH:
            yield l, r, [0, 1]
        return
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    right = _neighbours([contexts[i][1] for i in order])
    lefts = [contexts[i][0] for i in order]
    place = [0] * len(order)
    for n, i in enumerate(sorted(range(len(order)), key=lefts.__getitem__)):
        place[i] = n
    for first, last, r in intervals(right, GRAM):
        members = sorted(range(first, last + 1), key=place.__getitem__)
        left = _neighbours([lefts[i] for i in members])
        if max(left) + r < LENGTH:
            continue
        for a, b, l in intervals(left, max(0, LENGTH - r)):
            ranks = members[a : b + 1]
            low, high = min(ranks), max(ranks)
            # Members of one child interval have a longer common extension and belong to the child.
            if high - low == last - first or min(right[low + 1 : high + 1]) == r:
                yield l, r, [order[i] for i in ranks]


def reach(contexts: list[tuple[bytes, bytes]], ages: list) -> np.ndarray:
    """Bytes before the gram, and from it on, that repeats with a context of smaller age cover of each context.

    What all repeats of a context with an older one cover is one stretch, since all of them hold the gram; its two
    ends are maxima over the classes of the trees, so classes need not be told one by one.
    """
    found = np.zeros((2, len(contexts)), np.int64)
    if len(contexts) < 16:
        for before, after, some in maximal(contexts):
            oldest = min(some, key=ages.__getitem__)
            others = [i for i in some if i != oldest]
            found[:, others] = np.maximum(found[:, others], [[before], [after]])
        return found
    order = np.array(sorted(range(len(contexts)), key=lambda i: contexts[i][1]))
    right = _neighbours([contexts[i][1] for i in order])
    lefts = [contexts[i][0] for i in order]
    place = np.empty(len(order), np.int64)
    place[sorted(range(len(order)), key=lefts.__getitem__)] = np.arange(len(order))
    age = np.empty(len(order), np.int64)
    age[sorted(range(len(order)), key=lambda n: ages[order[n]])] = np.arange(len(order))
    sizes = np.array([len(t) for t in lefts])
    wide = np.zeros((len(order), SIDE + 1), np.uint8)
    wide[np.arange(SIDE + 1) < sizes[:, None]] = np.frombuffer(b"".join(lefts), np.uint8)
    most = np.zeros((2, len(order)), np.int64)
    for first, last, r in intervals(right, GRAM):
        members = first + np.argsort(place[first : last + 1])
        differ = wide[members[1:]] != wide[members[:-1]]
        differ[:, SIDE] = True
        left = np.minimum(differ.argmax(axis=1), np.minimum(sizes[members[1:]], sizes[members[:-1]]))
        if left.max() + r < LENGTH:
            continue
        for a, b, l in intervals([0, *left.tolist()], max(0, LENGTH - r)):
            ranks = members[a : b + 1]
            oldest = ranks[age[ranks].argmin()]
            kept = most[:, oldest].copy()
            most[:, ranks] = np.maximum(most[:, ranks], [[l], [r]])
            most[:, oldest] = kept
    found[:, order] = most
    return found


class Block:
    """Consecutive documents; each keeps its id and bytes."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.ids: list = []
        self.texts: list[bytes] = []

    def name(self) -> bytes:
        digest = xxhash.xxh3_128(repr((TaskContext.get().partitionId(), self.number, self.ids)).encode())
        for text in self.texts:
            digest.update(len(text).to_bytes(8, "little") + text)
        return digest.digest()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block = Block(0)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block.ids.append(doc_id)
            block.texts.append(text)
            block.size += len(text) + 64
            if block.size >= BLOCK_BYTES:
                yield block
                block = Block(block.number + 1)
    if block.ids:
        yield block


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    wide = np.ascontiguousarray(values)
    return zlib.compress(wide.view(np.uint8).reshape(len(wide), -1).T.tobytes(), 1)


def _unplanes(packed: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()


def _batch(names: list[str], rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _block_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list]:
    """Sorted distinct gram hashes of a block, whether each occurs twice in it, and the anchors by document."""
    found = [anchors(t) for t in texts]
    keys, n = np.unique(np.concatenate([h for _, h in found]) if found else np.empty(0, np.uint64), return_counts=True)
    return keys, n > 1, found


def _repeated(asked: pa.Table) -> pa.Table:
    """For each block of a range, which of its grams occur twice or more in the corpus."""
    rows = list(zip(*(asked.column(n).to_pylist() for n in ("part", "block", "keys", "twice"))))
    keys = [np.cumsum(_unplanes(r[2], np.uint64), dtype=np.uint64) for r in rows]
    twice = [np.unpackbits(np.frombuffer(r[3], np.uint8), count=len(k)).astype(bool) for r, k in zip(rows, keys)]
    flat, n = np.unique(np.concatenate(keys), return_counts=True)
    many = n > 1
    for k, t in zip(keys, twice):
        many[np.searchsorted(flat, k[t])] = True
    out = [(r[0], r[1], np.packbits(many[np.searchsorted(flat, k)]).tobytes()) for r, k in zip(rows, keys)]
    return pa.Table.from_batches([_batch(["part", "block", "bits"], out, [pa.int32(), pa.binary(), pa.binary()])])


def _stored(id_type: pa.DataType):
    """Documents of each block with their place in it."""

    def rows(batches):
        for block in _blocks(batches):
            name = block.name()
            for a in range(0, len(block.ids), 256):
                some = [
                    (name, a + k, i, zlib.compress(t, 1))
                    for k, (i, t) in enumerate(zip(block.ids[a : a + 256], block.texts[a : a + 256]))
                ]
                yield _batch(["block", "row", "doc_id", "text"], some, [pa.binary(), pa.int32(), id_type, pa.binary()])

    return rows


def _cut(parts: int, id_type: pa.DataType):
    """Documents of each block (part is null) and its grams by range (row is null)."""
    names = ["block", "row", "doc_id", "text", "part", "keys", "twice"]
    types = [pa.binary(), pa.int32(), id_type, pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def rows(batches):
        for block in _blocks(batches):
            name = block.name()
            for a in range(0, len(block.ids), 256):
                some = [
                    (name, a + k, i, zlib.compress(t, 1), None, None, None)
                    for k, (i, t) in enumerate(zip(block.ids[a : a + 256], block.texts[a : a + 256]))
                ]
                yield _batch(names, some, types)
            keys, twice, _ = _block_grams(block.texts)
            cut = np.searchsorted(_parts(keys, parts), np.arange(parts + 1)).tolist()
            grams = [
                (name, None, None, None, p, _planes(np.diff(keys[a:b], prepend=np.uint64(0))), np.packbits(twice[a:b]).tobytes())
                for p, (a, b) in enumerate(zip(cut, cut[1:])) if a < b
            ]
            yield _batch(names, grams, types)

    return rows


def _complete(docs: pa.Table, told: pa.Table) -> None:
    if told.num_rows and not docs.num_rows:
        raise ValueError("spans or grams of a block without documents: the written blocks changed between two reads")


def _opened(docs: pa.Table) -> tuple[list, list[bytes]]:
    docs = docs.sort_by("row")
    return docs.column("doc_id").to_pylist(), [zlib.decompress(t) for t in docs.column("text").to_pylist()]


CONTEXTS = "part int, block binary, owners binary, places binary, before binary, sizes binary, bytes binary"


def _contexts(parts: int):
    """Contexts of the repeated grams of a block, packed by range. Rows without an id take no part."""
    names = ["part", "block", "owners", "places", "before", "sizes", "bytes"]
    types = [pa.int32(), *[pa.binary()] * 6]

    def rows(docs: pa.Table, answers: pa.Table) -> pa.Table:
        _complete(docs, answers)
        out: list[tuple] = []
        if docs.num_rows:
            ids, texts = _opened(docs)
            keys, _, found = _block_grams(texts)
            cut = np.searchsorted(_parts(keys, parts), np.arange(parts + 1))
            many = np.zeros(len(keys), bool)
            for part, bits in zip(answers.column("part").to_pylist(), answers.column("bits").to_pylist()):
                a, b = cut[part], cut[part + 1]
                many[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
            packs: dict[int, list] = defaultdict(list)
            for row, (at, h) in enumerate(found):
                if ids[row] is None or not len(at):
                    continue
                chosen = many[np.searchsorted(keys, h)]
                for place, part in zip(at[chosen].tolist(), _parts(h[chosen], parts).tolist()):
                    packs[part].append((row, place))
            for part, some in packs.items():
                text = [texts[row][max(0, p - SIDE) : p + LENGTH] for row, p in some]
                out.append((
                    part, docs.column("block")[0].as_py(),
                    # Ids and places in the block of the owners, and the places of the grams.
                    zlib.compress(np.array([(ids[row], row) for row, _ in some], np.int64).T.tobytes(), 1),
                    _planes(np.array([p for _, p in some], np.uint32)),
                    zlib.compress(np.array([min(SIDE, p) for _, p in some], np.uint8).tobytes(), 1),
                    zlib.compress(np.array([len(t) for t in text], np.uint8).tobytes(), 1),
                    zlib.compress(b"".join(text), 1),
                ))
        return pa.Table.from_batches([_batch(names, out, types)])

    return rows


SPANS = "block binary, rows binary, starts binary, sizes binary, firsts binary, groups binary"


def _spans(whole: bool):
    """Spans of the repeats of a range, packed by block: every occurrence of every maximal repeat if `whole`,
    else for every anchor what its repeats that also start earlier cover, which is one span, since all of them
    hold the gram."""

    def rows(asked: pa.Table) -> pa.Table:
        blocks = asked.column("block").to_pylist()
        leaves: dict[bytes, dict[tuple[int, bytes], list]] = {}
        for b, (owners, places, before, sizes, packed) in enumerate(
            zip(*(asked.column(n).to_pylist() for n in ("owners", "places", "before", "sizes", "bytes")))
        ):
            owned = np.frombuffer(zlib.decompress(owners), np.int64).reshape(2, -1).tolist()
            text, end = zlib.decompress(packed), 0
            for doc_id, row, place, left, size in zip(
                *owned, _unplanes(places, np.uint32).tolist(), zlib.decompress(before), zlib.decompress(sizes)
            ):
                start, end = end, end + size
                group = leaves.setdefault(text[start + left : start + left + GRAM], {})
                group.setdefault((left, text[start:end]), []).append((doc_id, blocks[b], row, place))
        out: dict[bytes, list] = defaultdict(list)

        def told(before: int, size: int, members: list, first: tuple | None, name: bytes):
            group = xxhash.xxh3_64_intdigest(name) if whole else 0
            for m in members:
                out[m[1]].append((m[2], m[3] - before, size, m is first, group))

        while leaves:
            _, group = leaves.popitem()
            for (left, context), members in group.items():
                members.sort()
                if len(members) > 1 and len(context) >= LENGTH:
                    told(left, len(context), members if whole else members[1:], members[0], context)
            if len(group) < 2:
                continue
            contexts = [(context[:left][::-1], context[left:]) for left, context in group]
            firsts, leaf = [members[0] for members in group.values()], list(group.values())
            if whole:
                for before, after, some in maximal(contexts):
                    left, right = contexts[some[0]]
                    members = [m for i in some for m in leaf[i]]
                    told(before, before + after, members, min(firsts[i] for i in some), left[:before][::-1] + right[:after])
            else:
                most = reach(contexts, firsts)
                for i in np.flatnonzero(most[1]).tolist():
                    told(int(most[0, i]), int(most[:, i].sum()), [firsts[i]], None, b"")
        packs = []
        for block, found in out.items():
            row, start, size, first, group = zip(*found)
            packs.append((
                block, _planes(np.array(row, np.uint32)), _planes(np.array(start, np.uint32)),
                zlib.compress(np.array(size, np.uint8).tobytes(), 1), np.packbits(np.array(first)).tobytes(),
                zlib.compress(np.array(group, np.uint64).tobytes(), 1),
            ))
        return pa.Table.from_batches([_batch([c.split()[0] for c in SPANS.split(", ")], packs, [pa.binary()] * 6)])

    return rows


def _unpacked(spans: pa.Table) -> tuple[np.ndarray, ...]:
    """Place of the document, start, size, whether it is the first occurrence, and group of all spans."""
    found = [[np.empty(0, np.int64)] for _ in range(5)]
    for rows, starts, sizes, firsts, groups in zip(*(spans.column(n).to_pylist() for n in ("rows", "starts", "sizes", "firsts", "groups"))):
        row = _unplanes(rows, np.uint32)
        for column, values in zip(found, (
            row, _unplanes(starts, np.uint32), np.frombuffer(zlib.decompress(sizes), np.uint8),
            np.unpackbits(np.frombuffer(firsts, np.uint8), count=len(row)),
            np.frombuffer(zlib.decompress(groups), np.uint64).view(np.int64),
        )):
            column.append(values.astype(np.int64))
    return tuple(np.concatenate(c) for c in found)


def merged(starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; runs that touch are one."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), (starts + sizes).tolist())):
        if runs and a <= runs[-1][1]:
            if b > runs[-1][1]:
                runs[-1] = runs[-1][0], b
        else:
            runs.append((a, b))
    return runs


class Repeats:
    """The blocks of a table and the spans of its repeats, for the operations below.

    `docs` has doc_id (an integer type) and text. Documents are ordered by doc_id; of rows with equal ids, by
    their place in the table. Rows without an id repeat nothing and make nothing a repeat. Null texts are empty.
    """

    def __init__(self, docs: DataFrame):
        base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
        self.kind = base.schema["doc_id"].dataType.simpleString()
        self.id_type = {"bigint": pa.int64(), "int": pa.int32()}[self.kind]
        size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(8, math.ceil(size / RANGE_BYTES))
        # Cut and written once: a second reading can split the input elsewhere, and names of blocks would not match.
        cut = written(
            base.mapInArrow(
                _cut(parts, self.id_type),
                f"block binary, row int, doc_id {self.kind}, text binary, part int, keys binary, twice binary",
            ),
            "blocks",
        )
        repeated = (
            cut.filter("part is not null").select("part", "block", "keys", "twice")
            .groupBy("part").applyInArrow(_repeated, "part int, block binary, bits binary")
        )
        self.blocks = cut.filter("row is not null").select("block", "row", "doc_id", "text")
        self.contexts = self.blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_contexts(parts), CONTEXTS)

    def _each(self, rows, schema: str, whole: bool) -> DataFrame:
        spans = written(self.contexts.groupBy("part").applyInArrow(_spans(whole), SPANS), "repeats")
        return self.blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(rows, schema)

    def occurrences(self) -> DataFrame:
        """doc_id, start, size (bytes), group_id and is_first: all occurrences of the maximal repeats."""
        id_type = self.id_type

        def rows(docs: pa.Table, spans: pa.Table) -> pa.Table:
            _complete(docs, spans)
            ids = docs.sort_by("row").column("doc_id").to_pylist()
            row, start, size, first, group = _unpacked(spans)
            new = np.unique(np.stack([row, start, size, first, group]), axis=1)
            columns = [pa.array([ids[r] for r in new[0]], id_type), pa.array(new[1]), pa.array(new[2]), pa.array(new[4]), pa.array(new[3] == 1)]
            return pa.Table.from_arrays(columns, names=["doc_id", "start", "size", "group_id", "is_first"])

        return self._each(rows, f"doc_id {self.kind}, start bigint, size bigint, group_id bigint, is_first boolean", True)

    def removed(self) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row: without the bytes that a LENGTH-byte
        string covers which also starts earlier."""
        id_type = self.id_type

        def rows(docs: pa.Table, spans: pa.Table) -> pa.Table:
            _complete(docs, spans)
            ids, texts = _opened(docs) if docs.num_rows else ([], [])
            row, start, size, first, _ = _unpacked(spans)
            order = np.flatnonzero(first == 0)
            order = order[np.argsort(row[order], kind="stable")]
            cut = np.searchsorted(row[order], np.arange(len(ids) + 1))
            out = []
            for n, (doc_id, text) in enumerate(zip(ids, texts)):
                mine = order[cut[n] : cut[n + 1]]
                runs = merged(start[mine], size[mine])
                kept = hashlib.sha256()
                at = 0
                for a, b in runs:
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                out.append((doc_id, len(text), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            return pa.Table.from_batches([_batch(names, out, [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string()])])

        return self._each(rows, f"doc_id {self.kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", False)
