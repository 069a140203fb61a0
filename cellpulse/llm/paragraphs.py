"""Substring dedup by MinHash banding of paragraphs.

Paragraphs are of two kinds. Marked ones are the lines of a text that have 24 words or more. Texts also repeat each
other at any place, so pieces are runs of 24 words that start where the text itself says so: at the least five-word
shingle of any 28 neighbouring ones. A repeated passage of 51 words therefore holds at least one whole piece, at the
same words in every copy.

A paragraph's MinHash under each of a few permutations is a band; the number of bands is tuned so that paragraphs at
the wanted Jaccard similarity share one almost surely. Bands that occur at one place only are left out, paragraphs
that share a band are joined, the exact Jaccard similarity of their whole shingle sets is verified, and components of
similar paragraphs are clusters: the first occurrence of a cluster stays, all others are removed.

A removed piece is extended word by word as far as its words are those beside an earlier occurrence of its cluster, up
to the words that a passage can have beyond its outermost piece: the whole passage goes. Only where the next piece
isn't removed as well are the words beside it looked at: they meet those of the other occurrences by cluster and
nearest word, and a sort tells the longest stretch that each shares with an earlier one.

How it travels: consecutive documents form a block, written once with the bands of its paragraphs, packed by range of
their hash. Ranges answer every block which of its bands stand at two places. Paragraphs that share none are never told
apart; of the others each block tells every text once. A band of many different paragraphs is compared in pairs of
bounded blocks. Written tables go when the next one stands.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.components import connected
from cellpulse.llm.memory import cogrouped, grouped, streaming
from cellpulse.llm.repeats import RANGE_BYTES, _batch, _blocks, _complete, _parts, _planes, _repeated
from cellpulse.staging import discarded, written

SHINGLE, WORDS, REACH = 5, 24, 28
SHINGLES = WORDS - SHINGLE + 1
#: Words of a repeated passage that can lie before its first piece or after its last one.
SIDE = REACH - 1
SIMILARITY, RECALL = 0.8, 0.99
PLACE_BITS = 24
#: Bits of the number of a row in its block, and of a block in its partition.
ROW_BITS, BLOCK_BITS = 24, 19
#: Words of different paragraphs of a band that are compared in one block.
BLOCK = 2048 * WORDS
#: Paragraphs up to which plain loops compare them.
FEW = 12
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Types of doc_id.
ID_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}


def bands(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Least number of single-row bands of which paragraphs at `similarity` share one with probability `recall`."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity)))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hash of every run of five word hashes."""
    n = len(hashes) - SHINGLE + 1
    total = np.zeros(max(0, n), np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        total = total * np.uint64(MULTIPLIERS[0]) + hashes[k : k + n]
    return (total ^ total >> np.uint64(29)) * np.uint64(MULTIPLIERS[2])


def _mixes(found: np.ndarray):
    """The hashes of the shingles under the permutation of each band."""
    for b in range(bands()):
        mixed = (found ^ found >> np.uint64(31)) * np.uint64(MULTIPLIERS[b % 5] ^ b << 8 | 1)
        yield b, mixed ^ mixed >> np.uint64(30)


def _key(least: np.ndarray, band: int) -> np.ndarray:
    """The least of many hashes are small: mixed again, so that ranges of hashes are equal shares."""
    again = (least + np.uint64(band)) * np.uint64(MULTIPLIERS[3])
    return again ^ again >> np.uint64(32)


def marked(mixes: list[np.ndarray], lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words and numbers of words of the lines of WORDS words or more, and for each band (rows) and line its
    hash; `lines` has the first word of every line and the number of words of the text."""
    sizes = np.diff(lines)
    first, sizes = lines[:-1][sizes >= WORDS], sizes[sizes >= WORDS]
    if not len(first):
        return first, sizes, np.empty((len(mixes), 0), np.uint64)
    # Between the shingles of two lines stand those that belong to neither: every other stretch is a line's.
    cut = np.stack([first, first + sizes - SHINGLE + 1]).T.ravel()
    if cut[-1] >= len(mixes[0]):
        cut = cut[:-1]
    return first, sizes, np.array([_key(np.minimum.reduceat(m, cut)[::2], b) for b, m in enumerate(mixes)])


def starts_of(found: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """First words of the pieces of texts whose shingles are `found`, one text behind the other; `docs` has the first
    word of every text and the number of words."""
    first, shingles_ = docs[:-1], np.maximum(0, np.diff(docs) - SHINGLE + 1)
    # Too short to say where pieces start: one from the first word, if there is one.
    short = first[(shingles_ >= SHINGLES) & (shingles_ < REACH)]
    long = shingles_ >= REACH
    if not long.any():
        return short
    # Windows of REACH shingles that lie in one text.
    windows = np.zeros(len(found) + 1, np.int64)
    np.add.at(windows, first[long], 1)
    np.add.at(windows, (first + shingles_ - REACH + 1)[long], -1)
    inside = np.flatnonzero(np.cumsum(windows[:-1])[: len(found) - REACH + 1])
    chosen = np.empty(0, np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, len(found) - REACH + 1, 1 << PLACE_BITS - 1):
        part = found[at : at + (1 << PLACE_BITS - 1) + REACH - 1]
        least = _least((part & ~low) | np.arange(len(part), dtype=np.uint64), REACH) & low
        mine = inside[(inside >= at) & (inside < at + (1 << PLACE_BITS - 1))] - at
        least = least[mine]
        # The least of neighbouring windows rarely changes.
        least = least[np.concatenate([[True], least[1:] != least[:-1]])] if len(least) else least
        chosen = np.concatenate([chosen, least.astype(np.int64) + at])
    chosen = np.unique(chosen)
    ends = (first + shingles_)[np.searchsorted(first, chosen, "right") - 1]
    return np.sort(np.concatenate([short, chosen[chosen + SHINGLES <= ends]]))


#: Bytes of text that are looked at together, and the longest word whose hash is made of its bytes' powers.
CHUNK, LONGEST = 1 << 20, 1 << 12
_BASE = 0xC6A4A7935BD1E995


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of word hashes, and of its inverse."""
    size = CHUNK + LONGEST
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    return made[0], made[1]


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a lower-cased text, given by their first bytes and the bytes behind them."""
    powers, inverse = _powers()
    found = np.empty(len(first), np.uint64)
    for base in range(0, len(data), CHUNK):
        a, b = np.searchsorted(first, [base, base + CHUNK])
        if a == b:
            continue
        low, high = first[a:b] - base, np.minimum(last[a:b] - base, CHUNK + LONGEST)
        part = data[base : base + CHUNK + LONGEST].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers[: len(part)], dtype=np.uint64)])
        found[a:b] = (sums[np.minimum(high, len(part))] - sums[low]) * inverse[low] + (high - low).astype(np.uint64)
    for k in np.flatnonzero(last - first > LONGEST).tolist():
        found[k] = xxhash.xxh3_64_intdigest(data[first[k] : last[k]].tobytes())
    found = (found ^ found >> np.uint64(32)) * np.uint64(MULTIPLIERS[1])
    return found ^ found >> np.uint64(29)


class _Chunk:
    """The paragraphs of neighbouring texts of a block: by paragraph (pieces first) the text, first word and number of
    words, bytes and characters in it, content, bands (rows), and whether its band's shingle counts as a place."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        data = np.frombuffer(joined.lower(), np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_WHITE[data]
        first, last = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        docs = np.searchsorted(first, offsets)
        hashes = word_hashes(data, first, last)
        found = shingles(hashes)
        mixes = [m for _, m in _mixes(found)]
        starts = starts_of(found, docs)
        lines = np.searchsorted(first, np.concatenate([[0], np.flatnonzero(data == 10) + 1]))
        line_first, line_size, line_keys = marked(mixes, lines)
        self.pieces = len(starts)
        keys, counted = [], []
        for b, m in enumerate(mixes):
            if not self.pieces:
                keys.append(line_keys[b])
                counted.append(np.ones(len(line_first), bool))
                continue
            place = starts + np.lib.stride_tricks.sliding_window_view(m, SHINGLES)[starts].argmin(axis=1)
            # Neighbouring pieces can have one shingle in common; its place counts once, for pieces and lines apart.
            new = np.concatenate([[True], place[1:] != place[:-1]])
            keys.append(np.concatenate([_key(m[place], b), line_keys[b]]))
            counted.append(np.concatenate([new, np.ones(len(line_first), bool)]))
        self.keys, self.counted = np.array(keys), np.array(counted)
        self.keys[:, self.pieces :] ^= np.uint64(1)
        whole = np.concatenate([starts, line_first])
        self.size = np.concatenate([np.full(self.pieces, WORDS), line_size]).astype(np.int64)
        self.row = np.searchsorted(docs, whole, "right") - 1
        self.first = whole - docs[self.row]
        end = whole + self.size - 1
        # Bands of a block are asked for first; places and contents only of what is shared.
        self._told = hashes, data, first, last, offsets, whole, end

    def told(self, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of some paragraphs the bytes and characters in their texts (first and behind the last), and contents."""
        hashes, data, first, last, offsets, whole, end = self._told
        rows, a, b = self.row[chosen], first[whole[chosen]], last[end[chosen]]
        characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        before = characters[offsets[rows]]
        digests = np.empty(len(chosen), np.uint64)
        powers, inverse = _powers()
        sums, base = None, -1
        order = np.argsort(whole[chosen], kind="stable")
        for k in range(0, len(order), 4096):
            some = chosen[order[k : k + 4096]]
            low, high = whole[some], end[some] + 1
            base = int(low[0])
            if int(high.max()) - base > CHUNK:
                for j, n in zip(order[k : k + 4096].tolist(), some.tolist()):
                    digests[j] = self._digest(hashes[whole[n] : end[n] + 1])
                continue
            part = hashes[base : int(high.max())]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers[: len(part)], dtype=np.uint64)])
            digests[order[k : k + 4096]] = (sums[high - base] - sums[low - base]) * inverse[low - base]
        digests += self.size[chosen].astype(np.uint64)
        digests = (digests ^ digests >> np.uint64(32)) * np.uint64(MULTIPLIERS[4])
        return a - offsets[rows], b - offsets[rows], characters[a] - before, characters[b] - before, digests ^ digests >> np.uint64(29)

    def _digest(self, words: np.ndarray) -> np.uint64:
        powers, total = _powers()[0], np.uint64(0)
        for a in range(0, len(words), CHUNK):
            part = words[a : a + CHUNK]
            total += (part * powers[: len(part)]).sum(dtype=np.uint64) * np.uint64(pow(_BASE, a, 1 << 64))
        return total


def _block_chunks(ids: list, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, _Chunk]]]:
    """Sorted distinct bands of a block, whether each stands at two places, and the paragraphs by chunk, with the row
    of its first text. Rows that repeat a document, and rows without an id, add no places."""
    once, adds = set(), np.zeros(len(ids), bool)
    for row, (doc_id, text) in enumerate(zip(ids, texts)):
        adds[row] = doc_id is not None and (doc_id, text) not in once
        once.add((doc_id, text))
    found, keys = [], [np.empty(0, np.uint64)]
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < CHUNK):
            size += len(texts[end])
            end += 1
        chunk = _Chunk(texts[at:end])
        found.append((at, chunk))
        keys.append(chunk.keys[chunk.counted & adds[at + chunk.row]])
        at = end
    distinct, n = np.unique(np.concatenate(keys), return_counts=True)
    return distinct, n > 1, found


def _runs(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(range, first, behind last) of each run of equal ranges: only those that occur."""
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, int)
    return list(zip(part[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist()))


def _cut(parts: int, id_type: pa.DataType):
    """Documents of each block, packed by the thousand (part is null), and its bands by range (first is null)."""
    names = ["block", "number", "first", "ids", "texts", "part", "keys", "twice"]
    types = [pa.binary(), pa.int64(), pa.int32(), pa.list_(id_type), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def rows(batches):
        for block in _blocks(batches):
            name = block.name()
            # Unique in the job that writes the blocks; its low bits are zero, rows are added to it.
            number = TaskContext.get().partitionId() << ROW_BITS + BLOCK_BITS | block.number << ROW_BITS
            for a in range(0, len(block.ids), 1024):
                some = block.texts[a : a + 1024]
                sizes = np.array([len(t) for t in some], np.uint32).tobytes()
                packed = zstandard.compress(len(some).to_bytes(4, "little") + sizes + b"".join(some), 3)
                yield _batch(names, [(name, number, a, block.ids[a : a + 1024], packed, None, None, None)], types)
            keys, twice, _ = _block_chunks(block.ids, block.texts)
            told = [
                (name, None, None, None, None, p, _planes(np.diff(keys[a:b], prepend=np.uint64(0))), np.packbits(twice[a:b]).tobytes())
                for p, a, b in _runs(_parts(keys, parts))
            ]
            yield _batch(names, told, types)

    return rows


def _opened(docs: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a block in their order."""
    docs = docs.sort_by("first")
    ids, texts = [], []
    for some, packed in zip(docs.column("ids").to_pylist(), docs.column("texts").to_pylist()):
        data = zstandard.decompress(packed)
        n = int.from_bytes(data[:4], "little")
        at = 4 + 4 * n
        for size in np.frombuffer(data, np.uint32, n, 4).tolist():
            texts.append(data[at : at + size])
            at += size
        ids += some
    return ids, texts


UNIT = (
    "doc_id {kind}, version bigint, place bigint, first int, size int, piece boolean, start int, end int, "
    "next int, apart int, content bigint, words string, bands array<bigint>"
)


def _units(parts: int, id_type: pa.DataType):
    """Paragraphs with a band that stands at two places: their words and characters in the text; for a piece, the
    first word of the next such piece within reach and the number of words between; and once for every content of the
    block (doc_id and first are null) its words and those bands."""
    names = ["doc_id", "version", "place", "first", "size", "piece", "start", "end", "next", "apart", "content", "words", "bands"]
    types = [
        id_type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(),
        pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()),
    ]

    def rows(docs: pa.Table, answers: pa.Table) -> pa.Table:
        _complete(docs, answers)
        out: list[pa.Table] = []
        if docs.num_rows:
            number = docs.column("number")[0].as_py()
            ids, texts = _opened(docs)
            keys, _, found = _block_chunks(ids, texts)
            ranges = {p: (a, b) for p, a, b in _runs(_parts(keys, parts))}
            many = np.zeros(len(keys), bool)
            if answers.num_rows != len(ranges):
                raise ValueError("a block has not got an answer from every range: the written blocks changed")
            for part, bits in zip(answers.column("part").to_pylist(), answers.column("bits").to_pylist()):
                a, b = ranges[part]
                many[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
            missing = np.array([i is None for i in ids])
            all_ids, versions = pa.array(ids, id_type), np.array([_version(t) for t in texts], np.int64)
            told: set[int] = set()
            for at, chunk in found:
                if not len(keys) or not len(chunk.row):
                    continue
                shared = many[np.minimum(np.searchsorted(keys, chunk.keys), len(keys) - 1)] & ~missing[at + chunk.row]
                chosen = np.flatnonzero(shared.any(axis=0))
                if not len(chosen):
                    continue
                row, first, size, piece = chunk.row[chosen], chunk.first[chosen], chunk.size[chosen], chosen < chunk.pieces
                begin, stop, start, end, content = chunk.told(chosen)
                step = np.append(first[1:] - first[:-1], 0)
                near = np.append(row[1:] == row[:-1], False) & np.append(piece[1:], False) & piece & (step <= REACH)
                columns = {
                    "doc_id": all_ids.take(pa.array(at + row)), "version": versions[at + row],
                    "place": number + at + row, "first": first, "size": size,
                    "piece": piece, "start": start, "end": end, "next": pa.array(first + step, pa.int32(), mask=~near),
                    "apart": pa.array(np.maximum(0, step - WORDS), pa.int32(), mask=~near), "content": content.view(np.int64),
                }
                out.append(pa.Table.from_arrays(
                    [pa.array(columns[n], t) if n in columns else pa.nulls(len(row), t) for n, t in zip(names, types)], names=names
                ))
                distinct, once = np.unique(content.view(np.int64), return_index=True)
                k = once[[value not in told for value in distinct.tolist()]]
                told.update(distinct.tolist())
                rows_ = [
                    _plain(texts[r][a:b]) for r, a, b in zip((at + row[k]).tolist(), begin[k].tolist(), stop[k].tolist())
                ]
                mine = shared[:, chosen[k]].T
                bands_ = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(mine.sum(axis=1))]).astype(np.int32)),
                    pa.array(chunk.keys[:, chosen[k]].T[mine].view(np.int64)),
                )
                new = {"size": size[k], "content": content.view(np.int64)[k], "words": rows_}
                out.append(pa.Table.from_arrays(
                    [bands_ if n == "bands" else pa.array(new[n], t) if n in new else pa.nulls(len(k), t) for n, t in zip(names, types)],
                    names=names,
                ))
        return pa.concat_tables(out) if out else pa.Table.from_batches([_batch(names, [], types)])

    return rows


#: Bytes in lower case, white space as spaces.
_LOWER = bytes(32 if _WHITE[b] else b for b in range(256)).lower()


def _plain(text: bytes) -> bytes:
    """The words of a text from its first to its last word in lower case with one space between."""
    text = text.translate(_LOWER)
    return b" ".join(text.split()) if b"  " in text else text


def _version(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def similar(contents: list[int], words: list[str]) -> list[tuple[int, int]]:
    """Edges from one member of each component of paragraphs at SIMILARITY or more to the others.

    Sets that differ in d shingles differ in at most d bits of their 64-bit maps, so the maps are compared
    first; both are exact bounds."""
    sets = []
    for text in words:
        w = text.split(" ")
        sets.append(set(zip(*(w[k:] for k in range(SHINGLE)))))
    if len(sets) <= FEW:
        return _similar_few(contents, sets)
    maps = []
    for found in sets:
        bits = 0
        for x in found:
            bits |= 1 << (hash(x) & 63)
        maps.append(bits)
    maps = np.array(maps, np.uint64)
    size = np.array([len(x) for x in sets])
    waiting, edges = np.ones(len(sets), bool), []
    for start in range(len(sets)):
        if not waiting[start]:
            continue
        waiting[start] = False
        todo = [start]
        while todo:
            here = todo.pop()
            # |A ^ B| <= (1 - s) |A | B| and |A | B| <= (|A| + |B|) / (1 + s)
            bound = (1 - SIMILARITY) * (size[here] + size) / (1 + SIMILARITY)
            alike = (np.bitwise_count(maps ^ maps[here]) <= bound + 1e-9) & (np.abs(size - size[here]) <= bound + 1e-9)
            for other in np.flatnonzero(waiting & alike).tolist():
                both = len(sets[here] & sets[other])
                if both >= SIMILARITY * (len(sets[here]) + len(sets[other]) - both) - 1e-9:
                    waiting[other] = False
                    todo.append(other)
                    edges.append((contents[start], contents[other]))
    return edges


def _similar_few(contents: list[int], sets: list[set]) -> list[tuple[int, int]]:
    """The same by plain loops, which are faster for few paragraphs."""
    waiting, edges = list(range(len(sets))), []
    while waiting:
        start, todo = waiting[0], [waiting.pop(0)]
        while todo and waiting:
            here, rest = sets[todo.pop()], []
            for other in waiting:
                both = len(here & sets[other])
                if both >= SIMILARITY * (len(here) + len(sets[other]) - both) - 1e-9:
                    todo.append(other)
                    edges.append((contents[start], contents[other]))
                else:
                    rest.append(other)
            waiting = rest
    return edges


def links(found: DataFrame) -> DataFrame:
    """Edges (a, b) of contents that connect all contents sharing a band at SIMILARITY or more; `found` has content,
    size (number of words), words and bands, a content perhaps more than once."""
    # A row for each block that holds the content: reduced before words move.
    placed = found.select("content", F.explode("bands").alias("band"), "size").distinct()
    several = placed.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.bit_xor("content").alias("same"),
        F.bit_xor(F.xxhash64("content")).alias("too"),
    ).filter("n > 1")
    # Paragraphs that are alike share most bands: of bands with the same paragraphs one is compared.
    several = several.groupBy("n", "total", "same", "too").agg(F.min("band").alias("band")).select(
        "band", F.greatest(F.lit(1), F.least("n", F.ceil(F.col("total") / BLOCK))).cast("int").alias("blocks")
    )
    # A paragraph of block i stands in the units (i, j) or (j, i) for all j: each pair of paragraphs shares a unit.
    mine = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, mine).alias("i"), F.greatest(j, mine).alias("j")),
    )
    # With two blocks or more, a unit (i, i) has no pair that (i, j) doesn't have.
    pairs = F.when(F.col("blocks") == 1, pairs).otherwise(F.filter(pairs, lambda u: u["i"] != u["j"]))
    compared = written(placed.join(several, "band").select("content", "band", F.explode(pairs).alias("u")), "compared")
    texts = found.select("content", "words").join(compared.select("content").distinct(), "content", "left_semi").groupBy(
        "content"
    ).agg(F.first("words").alias("words"))
    spread = compared.join(texts, "content").select("band", "u.i", "u.j", "content", "words")

    def edges(batches):
        """Runs of equal (band, i, j) in sorted rows; a run may go on in the next batch."""
        held: list[tuple] = []
        for batch in batches:
            found_: list[tuple[int, int]] = []
            for row in zip(*(batch.column(n).to_pylist() for n in ("band", "i", "j", "content", "words"))):
                if held and held[-1][:3] != row[:3]:
                    found_ += similar([r[3] for r in held], [r[4] for r in held])
                    held = []
                held.append(row)
            yield _batch(["a", "b"], found_, [pa.int64(), pa.int64()])
        if held:
            yield _batch(["a", "b"], similar([r[3] for r in held], [r[4] for r in held]), [pa.int64(), pa.int64()])

    return (
        spread.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        .mapInArrow(streaming(edges), "a bigint, b bigint").distinct()
    )


# --- the words beside removed pieces -----------------------------------------------------------------


def _sides(id_type: pa.DataType):
    """For the pieces of a block that are told with a side (0 before, 1 after): the text of up to SIDE words on that
    side. Of equal ones in the block only the earliest goes on; the others have all words beside an earlier one."""
    names = ["root", "side", "near", "asked", "doc_id", "version", "first", "text", "grown"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), id_type, pa.int64(), pa.int32(), pa.string(), pa.int32()]

    def rows(docs: pa.Table, told: pa.Table) -> pa.Table:
        _complete(docs, told)
        if not told.num_rows:
            return pa.Table.from_batches([_batch(names, [], types)])
        _, texts = _opened(docs)
        told = told.sort_by([(n, "ascending") for n in ("doc_id", "first", "version", "place")])
        row = told.column("place").to_numpy() & (1 << ROW_BITS) - 1
        right = told.column("side").to_numpy() == 1
        beside = _beside(texts, row, told.column("first").to_numpy().astype(np.int64), right)
        kept = np.flatnonzero(beside["count"])
        root = told.column("root").to_numpy()[kept]
        keys = [beside["said"][kept], beside["count"][kept], right[kept], root]
        # Stable: of equal ones the first in order of age comes first.
        order = np.lexsort(keys)
        new = np.ones(len(kept), bool)
        if len(kept):
            new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
        earliest = np.zeros(len(kept), bool)
        earliest[order[new]] = True
        removed = np.array(told.column("removed").to_pylist(), bool)[kept]
        chosen = earliest | removed
        kept, earliest, removed = kept[chosen], earliest[chosen], removed[chosen]
        said = [
            texts[r][a:b] if e else None
            for r, a, b, e in zip(*(x.tolist() for x in (row[kept], beside["begin"][kept], beside["stop"][kept], earliest)))
        ]
        columns = {
            "root": root[chosen], "side": right[kept].astype(np.int32),
            "near": pa.array(beside["near"][kept].view(np.int64), pa.int64(), mask=~earliest), "asked": earliest & removed,
            **{n: told.column(n).take(pa.array(kept)) for n in ("doc_id", "version", "first")}, "text": said,
            "grown": pa.array(beside["letters"][kept], pa.int32(), mask=earliest),
        }
        # From a list of arrays: chunks of a taken column needn't be those of the others.
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for c, t in zip((columns[n] for n in names), types)], names=names)

    return rows


def _beside(texts: list[bytes], row: np.ndarray, start: np.ndarray, right: np.ndarray) -> dict[str, np.ndarray]:
    """Of the up to SIDE words beside pieces, given by text, first word and side: their number, hash, the hash of the one
    nearest to the piece, first byte and byte behind the last one of their text, up to the piece, and its characters."""
    found = {n: np.zeros(len(row), np.int64) for n in ("count", "begin", "stop")}
    found |= {n: np.zeros(len(row), np.uint64) for n in ("said", "near")} | {"letters": np.zeros(len(row), np.int32)}
    by_row = np.argsort(row, kind="stable")
    wanted, opens = np.unique(row[by_row], return_index=True)
    opens, at = np.append(opens, len(row)), 0
    while at < len(wanted):
        end, size = at, 0
        while end < len(wanted) and (end == at or size + len(texts[wanted[end]]) < CHUNK):
            size += len(texts[wanted[end]])
            end += 1
        some = [texts[r] for r in wanted[at:end].tolist()]
        data = np.frombuffer((b"\n".join(some) + b"\n").lower(), np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_WHITE[data]
        first, last = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        offsets = np.cumsum([0, *(len(t) + 1 for t in some)])
        words, hashes = np.searchsorted(first, offsets), word_hashes(data, first, last)
        characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        mine = by_row[opens[at] : opens[end]]
        text, on = np.searchsorted(wanted[at:end], row[mine]), right[mine]
        here = words[text] + start[mine]
        a = np.where(on, here + WORDS, np.maximum(words[text], here - SIDE))
        b = np.where(on, np.minimum(a + SIDE, words[text + 1]), here)
        some = b > a
        mine, text, on, a, b = mine[some], text[some], on[some], a[some], b[some]
        said = np.zeros(len(mine), np.uint64)
        for k in range(SIDE):
            said = np.where(a + k < b, (said + hashes[np.minimum(a + k, b - 1)]) * np.uint64(MULTIPLIERS[0]), said)
        begin = np.where(on, last[a - 1], first[a])
        stop = np.where(on, last[b - 1], first[np.minimum(b, len(first) - 1)])
        found["count"][mine], found["said"][mine] = b - a, said
        found["near"][mine] = hashes[np.where(on, a, b - 1)]
        found["begin"][mine], found["stop"][mine] = begin - offsets[text], stop - offsets[text]
        found["letters"][mine] = characters[stop] - characters[begin]
        at = end
    return found


def shared_reach(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each row of word hashes, given in order of age with its number of words, how many of its first words are
    also the first ones of an older row."""
    n, width = words.shape
    # Behind its words a row is like no other one.
    padded = np.where(np.arange(width) < sizes[:, None], words, (np.arange(n, dtype=np.uint64) << np.uint64(32) | np.uint64(1))[:, None])
    order = np.lexsort(padded.T[::-1])
    differ = np.concatenate([padded[order[1:]] != padded[order[:-1]], np.ones((n - 1, 1), bool)], axis=1) if n > 1 else np.ones((0, width + 1), bool)
    same = np.concatenate([[0], differ.argmax(axis=1)])
    reach = np.zeros(n, np.int64)
    for length in range(1, width + 1):
        first = np.flatnonzero(same < length)
        oldest = np.minimum.reduceat(order, first)
        run = np.cumsum(same < length) - 1
        younger = (oldest[run] < order) & (sizes[order] >= length)
        reach[order[younger]] = length
    return reach


GROWN = "doc_id {kind}, version bigint, first int, side int, grown int"


def _reached(id_type: pa.DataType):
    """How many characters of each asked side are words that stand beside an earlier piece of its cluster too."""

    def rows(told: pa.Table) -> pa.Table:
        told = told.sort_by([(n, "ascending") for n in ("doc_id", "first", "version")])
        n, right = told.num_rows, told.column("side").to_numpy() == 1
        texts = [t.encode() for t in told.column("text").to_pylist()]
        wide, sizes = np.zeros((n, SIDE + 2), np.uint64), np.zeros(n, np.int64)
        # Characters up to the end of each word (right), or from its beginning to the end of the text (left).
        lengths = np.zeros((n, SIDE), np.int32)
        for a in range(0, n, 4096):
            joined = b"\n".join(texts[a : a + 4096]) + b"\n"
            data = np.frombuffer(joined.lower(), np.uint8)
            inside = np.zeros(len(data) + 2, bool)
            inside[1:-1] = ~_WHITE[data]
            first, last = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
            offsets = np.cumsum([0, *(len(t) + 1 for t in texts[a : a + 4096])])
            words = np.searchsorted(first, offsets)
            hashes, characters = word_hashes(data, first, last), np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            count, here = np.diff(words), right[a : a + 4096]
            sizes[a : a + 4096] = count + 2
            row, k = np.nonzero(np.arange(SIDE) < count[:, None])
            at = np.where(here[row], words[row] + k, words[row] + count[row] - 1 - k)
            wide[a + row, k + 2] = hashes[at]
            lengths[a + row, k] = np.where(
                here[row], characters[last[at]] - characters[offsets[row]], characters[offsets[row + 1] - 1] - characters[first[at]]
            )
        wide[:, 0] = told.column("root").to_numpy().view(np.uint64)
        wide[:, 1] = right
        reach = shared_reach(wide, sizes) - 2
        asked = np.array(told.column("asked").to_pylist(), bool)
        grown = np.where(reach > 0, lengths[np.arange(n), np.maximum(reach, 1) - 1], 0)[asked]
        taken = told.filter(pa.array(asked))
        return pa.Table.from_arrays(
            [taken.column("doc_id"), taken.column("version"), taken.column("first"), taken.column("side"), pa.array(grown.astype(np.int32))],
            names=["doc_id", "version", "first", "side", "grown"],
        )

    return rows


def clustered(docs: DataFrame) -> DataFrame:
    """Paragraphs that occur at two places or more, as doc_id, version, start, end (characters of the text; of
    those removed with the words beside them that stand beside an earlier one, too), cluster (smallest doc_id of its
    cluster) and removed (all but the first occurrence).

    Occurrences are ordered by doc_id and place; those that overlap the first one are part of it. Rows with
    equal doc_id and text are one document. Rows without an id, null, empty and short texts have none. doc_id is an
    integer or a string.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    id_type = ID_TYPES[kind]
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, math.ceil(size / RANGE_BYTES))
    cut = written(
        base.mapInArrow(
            streaming(_cut(parts, id_type)),
            f"block binary, number bigint, first int, ids array<{kind}>, texts binary, part int, keys binary, twice binary",
        ), "blocks",
    )
    blocks = cut.filter("part is null").select("block", "number", "first", "ids", "texts")
    repeated = cut.filter("part is not null").select("part", "block", "keys", "twice").groupBy("part").applyInArrow(
        grouped(_repeated), "part int, block binary, bits binary"
    )
    told = written(
        blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
            cogrouped(_units(parts, id_type)), UNIT.format(kind=kind)
        ), "paragraphs",
    )
    roots = connected(links(told.filter("first is null").select("content", "size", "words", "bands")))
    units = told.filter("first is not null").drop("words", "bands")
    named = units.join(roots, units["content"] == roots["node"], "left").withColumn("root", F.coalesce("root", "content"))
    named = written(named.drop("content", "node"), "clusters")
    discarded(told)
    ends = named.groupBy("root").agg(
        F.min(F.struct("doc_id", "start", "end")).alias("opens"), F.max(F.struct("doc_id", "start")).alias("last"),
    ).filter("last.doc_id != opens.doc_id or last.start >= opens.end").select(
        "root", F.col("opens.doc_id").alias("cluster"), F.col("opens.end").alias("ends")
    )
    # Rows that repeat a document are one from here on: any of their blocks can tell its words.
    once = ["doc_id", "version", "first", "size", "piece", "start", "end", "next", "apart"]
    several = named.join(ends, "root").groupBy("root", *once).agg(
        F.min("place").alias("place"), F.first("cluster").alias("cluster"), F.first("ends").alias("ends")
    )
    flagged = written(
        several.withColumn("removed", (F.col("doc_id") != F.col("cluster")) | (F.col("start") >= F.col("ends"))).drop("ends"), "flagged",
    )
    discarded(named)
    grown = written(_grown(blocks, _told(flagged), id_type, parts, kind), "grown")
    discarded(cut)
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("grown")))
    both = grown.groupBy("doc_id", "version", "first").agg(side(0).alias("back"), side(1).alias("on"))
    more = lambda n: F.when(F.col("removed") & F.col("piece"), F.coalesce(n, F.lit(0))).otherwise(0)
    return flagged.join(both, ["doc_id", "version", "first"], "left").select(
        "doc_id", "version", (F.col("start") - more("back")).alias("start"), (F.col("end") + more("on")).alias("end"),
        "cluster", "removed",
    )


def _told(flagged: DataFrame) -> DataFrame:
    """The pieces whose words beside them are looked at: all pieces of the clusters in which a removed piece has, on
    that side, no neighbour that is removed as well without words between."""
    pieces = flagged.filter("piece")
    inside = Window.partitionBy("doc_id", "version").orderBy("first")
    goes_on = F.col("removed") & (F.lead("first").over(inside) == F.col("next")) & F.lead("removed").over(inside) & (F.col("apart") == 0)
    sided = pieces.withColumn("on", F.coalesce(goes_on, F.lit(False)))
    sided = sided.withColumn("back", F.coalesce(F.lag("on").over(inside), F.lit(False))).filter("removed")
    open_ = sided.groupBy("root").agg(F.min("back").alias("back"), F.min("on").alias("on"))
    sides = F.filter(F.array(F.when(~F.col("back"), F.lit(0)), F.when(~F.col("on"), F.lit(1))), lambda x: x.isNotNull())
    return pieces.join(open_.select("root", F.explode(sides).alias("side")), "root").select(
        "place", "doc_id", "version", "first", "root", "side", "removed"
    )


def _grown(blocks: DataFrame, told: DataFrame, id_type: pa.DataType, parts: int, kind: str) -> DataFrame:
    """doc_id, version, first, side and the characters by which a removed piece grows on that side."""
    number = F.shiftleft(F.shiftright("place", ROW_BITS), ROW_BITS).alias("number")
    sides = written(
        blocks.groupBy("number").cogroup(told.groupBy(number)).applyInArrow(
            cogrouped(_sides(id_type)),
            f"root bigint, side int, near bigint, asked boolean, doc_id {kind}, version bigint, first int, text string, grown int",
        ), "sides",
    )
    # Words can only be shared with a side of the same nearest word.
    part = F.pmod(F.xxhash64("root", "side", "near"), F.lit(parts)).cast("int").alias("part")
    met = sides.filter("near is not null").groupBy(part).applyInArrow(grouped(_reached(id_type)), GROWN.format(kind=kind))
    known = sides.filter("near is null").select("doc_id", "version", "first", "side", "grown")
    return met.unionAll(known)


def by_document(docs: DataFrame) -> DataFrame:
    """One row per document that shares a paragraph: doc_id, version, component_id (smallest doc_id that its
    paragraphs occur in), n_paragraphs, n_removed and `spans`, the characters to remove (merged)."""
    flagged = clustered(docs)
    span = F.when(F.col("removed"), F.struct("start", "end"))
    grouped = flagged.groupBy("doc_id", "version").agg(
        F.min("cluster").alias("component_id"), F.count(F.lit(1)).alias("n_paragraphs"),
        F.sum(F.col("removed").cast("long")).alias("n_removed"), F.sort_array(F.collect_list(span)).alias("spans"),
    )
    # Sorted by start: a span is added to the last one if it begins inside it or where it ends.
    step = lambda runs, s: F.when(
        (F.size(runs) > 0) & (F.element_at(runs, -1)["end"] >= s["start"]),
        F.concat(
            F.slice(runs, F.lit(1), F.size(runs) - 1),
            F.array(F.struct(F.element_at(runs, -1)["start"].alias("start"), F.greatest(F.element_at(runs, -1)["end"], s["end"]).alias("end"))),
        ),
    ).otherwise(F.concat(runs, F.array(s)))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return grouped.withColumn("spans", F.when(F.size("spans") > 0, F.aggregate("spans", empty, step)).otherwise(empty))


def duplicates_removed(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs`, without the repeated paragraphs in `text`; the other columns don't change,
    and a null text stays null."""
    schema = docs.schema
    cuts = "cuts"
    while cuts in docs.columns:
        cuts += "_"
    # Every version of a document with cuts; the task picks the one of its text.
    listed = by_document(docs).filter("n_removed > 0").groupBy("doc_id").agg(
        F.collect_list(F.struct("version", "spans")).alias(cuts)
    )
    joined = docs.join(listed, "doc_id", "left").select(*docs.columns, cuts)

    def rows(batches):
        for batch in batches:
            texts = []
            for text, versions in zip(batch.column("text").to_pylist(), batch.column(cuts).to_pylist()):
                if text is not None and versions:
                    version = xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)
                    spans = next((v["spans"] for v in versions if v["version"] == version), [])
                    at, kept = 0, []
                    for s in spans:
                        kept.append(text[at : s["start"]])
                        at = s["end"]
                    text = "".join([*kept, text[at:]])
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(streaming(rows), schema)
