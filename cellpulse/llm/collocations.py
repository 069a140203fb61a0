"""Phrases of words that occur together more often than apart, per language.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every word begins a suffix of its piece,
of which the first DEPTH words matter. Suffixes are routed by their two leading words to ranges, and a range sorts its
suffixes by multikey three-way quicksort down to DEPTH words: what is equal to the pivot at a depth is one phrase, its
size is the phrase's count, and a partition that is smaller than the least count is abandoned with all that would
follow from it.

How it travels: consecutive documents form a block, written once as codes of its own dictionary. First the blocks ask
for their words, then for their pairs of words, packed one row per range of a hash; a range answers every block with
what is frequent (words get numbers). A word or pair that is too rare ends a suffix, since no phrase with it can be
frequent, so only suffixes with a frequent leading pair travel, each once per block with its number of occurrences. The
suffixes of a pair that is very frequent aren't sorted in one range: each of their beginnings goes to a range of its
own and is summed there.

Words are numbered exactly (no hashes stand for words), counts and scores are exact numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.memory import cogrouped, grouped, streaming
from cellpulse.staging import written

# Fixed values of the phrases.
DEPTH, LEAST, SCALE, COVERED = 4, 30, 2_000_000, 80
#: A block ends with the document at which it has so many words; one range per so many bytes of text.
BLOCK_WORDS, RANGE_BYTES = 1 << 20, 12 << 20
#: Occurrences of a leading pair from which its suffixes are spread over ranges.
HOT = 1 << 17
#: Partitions of fewer suffixes are counted one by one.
SMALL = 48
# Ends of pieces become line ends, other white space of words blanks, A-Z lower case.
_FOLDED = bytes.maketrans(b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz")
RARE, FREQUENT, SPREAD = range(3)
DEFAULT_LANG = "und"


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of every piece."""
    for piece in text.translate(_FOLDED).split(b"\n"):
        words = piece.split()
        if words:
            yield words


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    wide = np.ascontiguousarray(values)
    return zstandard.compress(wide.view(np.uint8).reshape(-1, wide.itemsize).T.tobytes(), 3)


def _numbers(packed: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _runs(sorted_: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, first, behind last) of each run of equal numbers: only ranges that occur."""
    if not len(sorted_):
        return []
    cut = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]]))
    return list(zip(sorted_[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist()))


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _mixed(*columns: np.ndarray) -> np.ndarray:
    """A hash of rows of numbers."""
    total = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        total = (total ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9) ^ total >> np.uint64(31)


def _batch(names: list[str], rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


# --- blocks and their words --------------------------------------------------------------------------

BLOCKS = "block binary, codes binary, part int, langs binary, sizes binary, words binary, counts binary"


def _cut(parts: int):
    """Per block one row of codes (part is null), and for each range of words one with those words and their counts.

    Words are coded in the order of these rows from 1 on; 0 ends a piece."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    types = [pa.binary(), pa.binary(), pa.int32(), *[pa.binary()] * 4]

    def done(number: int, known: dict, coded: list):
        words = list(known)
        codes = np.array(coded, np.uint32)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, len(k)) for k, w in words), np.uint64, len(words))
        part = _part(hashes, parts)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(words) + 1, np.uint32)
        place[0] = 0
        place[order + 1] = np.arange(1, len(words) + 1)
        codes = place[codes]
        packed = _squeezed(codes)
        name = xxhash.xxh3_128(packed + b"%d %d" % (TaskContext.get().partitionId(), number)).digest()
        counts = np.bincount(codes, minlength=len(words) + 1)[1:].astype(np.uint32)
        rows = [(name, packed, None, None, None, None, None)]
        for p, a, b in _runs(part[order]):
            some = [words[i] for i in order[a:b].tolist()]
            langs = sorted({k for k, _ in some})
            at = {k: n for n, k in enumerate(langs)}
            # Languages of the words: their names, the number of each word's, and the bytes of the words.
            which = np.fromiter((at[k] for k, _ in some), np.uint32, len(some))
            rows.append((
                name, None, p, zstandard.compress(b"".join(len(k).to_bytes(4, "little") + k for k in langs), 3),
                _squeezed(np.concatenate([which, np.fromiter((len(w) for _, w in some), np.uint32, len(some))])),
                zstandard.compress(b"".join(w for _, w in some), 3), _squeezed(counts[a:b]),
            ))
        return _batch(names, rows, types)

    def rows(batches):
        known: dict[tuple[bytes, bytes], int] = {}
        by_lang: dict[bytes, dict[bytes, int]] = {}
        coded, number = [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = by_lang.setdefault(lang, {})
                for words in pieces(text):
                    for w in words:
                        code = mine.get(w)
                        if code is None:
                            code = mine[w] = known[lang, w] = len(known) + 1
                        coded.append(code)
                    coded.append(0)
                if len(coded) >= BLOCK_WORDS:
                    yield done(number, known, coded)
                    known, by_lang, coded, number = {}, {}, [], number + 1
        if coded:
            yield done(number, known, coded)

    return rows


def _opened(langs: bytes, sizes: bytes, words: bytes) -> list[tuple[bytes, bytes]]:
    data, names = zstandard.decompress(langs), []
    while data:
        n = int.from_bytes(data[:4], "little")
        names.append(data[4 : 4 + n])
        data = data[4 + n :]
    which, size = _numbers(sizes, np.uint32).reshape(2, -1).tolist()
    text, out, at = zstandard.decompress(words), [], 0
    for k, n in zip(which, size):
        out.append((names[k], text[at : at + n]))
        at += n
    return out


def _text(word: bytes) -> str:
    return word.decode(errors="replace")


WORDS = "part int, block binary, ids binary, id bigint, lang string, word string, n bigint"


def _numbered(least: int):
    """Adds the words of a range up: for each block the numbers of its words (0 for rare ones), and a row for each
    frequent word (block is null) and for each language with the occurrences of its words in the range (id is null)."""
    names = [c.split()[0] for c in WORDS.split(", ")]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def rows(asked: pa.Table) -> pa.Table:
        part = asked.column("part")[0].as_py()
        total: Counter = Counter()
        told = []
        for block, langs, sizes, words, counts in sorted(
            zip(*(asked.column(n).to_pylist() for n in ("block", "langs", "sizes", "words", "counts")))
        ):
            some = _opened(langs, sizes, words)
            for key, n in zip(some, _numbers(counts, np.uint32).tolist()):
                total[key] += n
            told.append((block, some))
        ids = {key: part << 32 | n for n, key in enumerate(sorted(k for k, n in total.items() if n >= least), 1)}
        out = [
            (part, block, _squeezed(np.fromiter((ids.get(k, 0) for k in some), np.int64, len(some))), None, None, None, None)
            for block, some in told
        ]
        out += [(part, None, None, i, _text(k[0]), _text(k[1]), total[k]) for k, i in ids.items()]
        by_lang: Counter = Counter()
        for (lang, _), n in total.items():
            by_lang[lang] += n
        out += [(part, None, None, None, _text(lang), None, n) for lang, n in by_lang.items()]
        return pa.Table.from_batches([_batch(names, out, types)])

    return rows


# --- pairs -------------------------------------------------------------------------------------------


def _complete(blocks: pa.Table, told: pa.Table) -> None:
    if told.num_rows and not blocks.num_rows:
        raise ValueError("answers for a block that isn't there: the written blocks changed between two reads")


def _ids(blocks: pa.Table, answers: pa.Table) -> np.ndarray:
    """Numbers of the words of a block in order, 0 for rare words and ends of pieces."""
    codes = _numbers(blocks.column("codes")[0].as_py(), np.uint32)
    told = sorted(zip(answers.column("part").to_pylist(), answers.column("ids").to_pylist()))
    ids = np.concatenate([np.zeros(1, np.int64), *(_numbers(x, np.int64) for _, x in told)])
    return ids[codes]


def _grouped(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows in order, their summed weights, and the group of each row."""
    order = np.lexsort(columns[::-1])
    if not len(order):
        return columns, weights, order
    sorted_ = [c[order] for c in columns]
    new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in sorted_], axis=0)])
    first = np.flatnonzero(new)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return [c[first] for c in sorted_], np.add.reduceat(weights[order], first), group


def _pairs(ids: np.ndarray, parts: int):
    """Distinct pairs of frequent neighbours of a block in the order of their ranges, with their counts; for each
    word of the block the number of the pair that it begins, or -1."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0)) if len(ids) else np.empty(0, np.int64)
    part = _part(_mixed(ids[at], ids[at + 1]), parts)
    (range_, first, second), counts, group = _grouped([part, ids[at], ids[at + 1]], np.ones(len(at), np.int64))
    begun = np.full(len(ids), -1, np.int64)
    begun[at] = group
    return range_, first, second, counts, begun


def _pairs_asked(parts: int):
    names, types = ["part", "block", "first", "second", "counts"], [pa.int32(), *[pa.binary()] * 4]

    def rows(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        _complete(blocks, answers)
        out = []
        if blocks.num_rows and answers.num_rows:
            range_, first, second, counts, _ = _pairs(_ids(blocks, answers), parts)
            name = blocks.column("block")[0].as_py()
            out = [
                (p, name, _squeezed(np.diff(first[a:b], prepend=0)), _squeezed(second[a:b]), _squeezed(counts[a:b].astype(np.uint32)))
                for p, a, b in _runs(range_)
            ]
        return pa.Table.from_batches([_batch(names, out, types)])

    return rows


def _pairs_answered(least: int, hot: int):
    """For each block of a range, which of its pairs are rare, frequent, or so frequent that they are spread."""

    def rows(asked: pa.Table) -> pa.Table:
        told = list(zip(*(asked.column(n).to_pylist() for n in ("part", "block", "first", "second", "counts"))))
        first = [np.cumsum(_numbers(r[2], np.int64)) for r in told]
        _, total, group = _grouped(
            [np.concatenate(first), np.concatenate([_numbers(r[3], np.int64) for r in told])],
            np.concatenate([_numbers(r[4], np.uint32).astype(np.int64) for r in told]),
        )
        rank = np.where(total < least, RARE, np.where(total < hot, FREQUENT, SPREAD)).astype(np.uint8)[group]
        ends = np.cumsum([len(f) for f in first]).tolist()
        out = [(r[0], r[1], zstandard.compress(rank[a:b].tobytes(), 3)) for r, a, b in zip(told, [0, *ends], ends)]
        return pa.Table.from_batches([_batch(["part", "block", "ranks"], out, [pa.int32(), pa.binary(), pa.binary()])])

    return rows


# --- suffixes ----------------------------------------------------------------------------------------


def _suffixes(parts: int):
    """Distinct suffixes of a block with a frequent leading pair, as far as their pairs are frequent, with their
    counts: in ranges of leading pairs, and, one row for each of their beginnings, in ranges of the whole rows."""
    names, types = ["part", "spread", "columns", "counts"], [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]

    def rows(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        _complete(blocks, answers)
        out = []
        if blocks.num_rows and answers.num_rows:
            words = answers.filter(pc.is_valid(answers.column("ids")))
            ids = _ids(blocks, words)
            _, _, _, _, begun = _pairs(ids, parts)
            told = sorted(
                (p, r) for p, r in zip(answers.column("part").to_pylist(), answers.column("ranks").to_pylist()) if r is not None
            )
            # The last one is for words that begin no pair.
            rank = np.frombuffer(b"".join(zstandard.decompress(r) for _, r in told) + bytes([RARE]), np.uint8)[begun]
            at = np.flatnonzero(rank != RARE)
            columns = [ids[at], ids[at + 1]]
            goes_on = np.ones(len(at), bool)
            padded = np.concatenate([ids, np.zeros(DEPTH, np.int64)])
            ranks = np.concatenate([rank, np.zeros(DEPTH, np.uint8)])
            for k in range(2, DEPTH):
                goes_on &= ranks[at + k - 1] != RARE
                columns.append(np.where(goes_on, padded[at + k], 0))
            whole, counts, _ = _grouped([*columns, rank[at].astype(np.int64)], np.ones(len(at), np.int64))
            columns, spread = whole[:DEPTH], whole[DEPTH] == SPREAD
            sorted_ = [c[~spread] for c in columns]
            out += _packets(sorted_, counts[~spread], _part(_mixed(*sorted_[:2]), parts), False)
            for depth in range(2, DEPTH + 1):
                deep = spread & (columns[depth - 1] > 0)
                some = [c[deep] if k < depth else np.zeros(int(deep.sum()), np.int64) for k, c in enumerate(columns)]
                some, n, _ = _grouped(some, counts[deep])
                out += _packets(some, n, _part(_mixed(*some), parts), True)
        return pa.Table.from_batches([_batch(names, out, types)])

    return rows


def _packets(columns: list[np.ndarray], counts: np.ndarray, part: np.ndarray, spread: bool) -> list[tuple]:
    order = np.argsort(part, kind="stable")
    columns, counts = [c[order] for c in columns], counts[order].astype(np.uint32)
    return [
        (p, spread, _squeezed(np.concatenate([c[a:b] for c in columns])), _squeezed(counts[a:b]))
        for p, a, b in _runs(part[order])
    ]


def frequent(columns: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[tuple, int]]:
    """(phrase, count) of all beginnings of two words or more that occur `least` times, of suffixes given as
    columns of word numbers (0 behind the end), by multikey three-way quicksort of pointers to the suffixes."""
    todo: list[tuple[np.ndarray, int, tuple]] = [(np.arange(len(weights)), 0, ())]
    while todo:
        rows, depth, prefix = todo.pop()
        if int(weights[rows].sum()) < least:
            continue  # abandoned
        if len(rows) < SMALL:
            yield from _counted(columns[:, rows].T.tolist(), weights[rows].tolist(), depth, prefix, least)
            continue
        words = columns[depth, rows]
        a, b, c = int(words[0]), int(words[len(words) // 2]), int(words[-1])
        pivot = max(min(a, b), min(max(a, b), c))
        equal = rows[words == pivot]
        todo.append((rows[words < pivot], depth, prefix))
        todo.append((rows[words > pivot], depth, prefix))
        if pivot:
            n, phrase = int(weights[equal].sum()), (*prefix, pivot)
            if n >= least:
                if depth:
                    yield phrase, n
                if depth + 1 < DEPTH:
                    todo.append((equal, depth + 1, phrase))


def _counted(rows: list, weights: list, depth: int, prefix: tuple, least: int) -> Iterator[tuple[tuple, int]]:
    """The same for few suffixes."""
    found: Counter = Counter()
    for row, n in zip(rows, weights):
        for k in range(depth, DEPTH):
            if not row[k]:
                break
            found[tuple(row[depth : k + 1])] += n
    for rest, n in found.items():
        if n >= least and len(prefix) + len(rest) > 1:
            yield (*prefix, *rest), n


def _phrases(least: int):
    names, types = ["w1", "w2", "w3", "w4", "a"], [pa.int64()] * 5

    def rows(told: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for kind in (False, True):
            mine = told.filter(pc.equal(told.column("spread"), kind))
            if not mine.num_rows:
                continue
            columns = np.concatenate(
                [_numbers(c, np.int64).reshape(DEPTH, -1) for c in mine.column("columns").to_pylist()], axis=1
            )
            counts = np.concatenate([_numbers(c, np.uint32) for c in mine.column("counts").to_pylist()]).astype(np.int64)
            if kind:
                whole, n, _ = _grouped(list(columns), counts)
                keep = n >= least
                out += zip(*(c[keep].tolist() for c in whole), n[keep].tolist())
            else:
                out += [(*p, *[0] * (DEPTH - len(p)), a) for p, a in frequent(columns, counts, least)]
        return pa.Table.from_batches([_batch(names, out, types)])

    return rows


class Phrases:
    """Frequent words and phrases of `docs` (lang, text) as written tables.

    `words` has id, lang, word and n, `totals` lang and n (all occurrences of words), `phrases` w1 to w4 (ids, 0
    behind the last word) and a. A null lang is `und`, a null text empty; repeated rows count each time; an empty
    table has no phrases. Other columns are not read.
    """

    def __init__(self, docs: DataFrame, least: int = LEAST, hot: int = HOT):
        base = docs.select(
            F.coalesce(F.col("lang").cast("string"), F.lit(DEFAULT_LANG)).cast("binary").alias("lang"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        )
        size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(8, math.ceil(size / RANGE_BYTES))
        cut = written(base.mapInArrow(streaming(_cut(parts)), BLOCKS), "blocks")
        blocks = cut.filter("part is null").select("block", "codes")
        told = written(
            cut.filter("part is not null").drop("codes").groupBy("part").applyInArrow(grouped(_numbered(least)), WORDS), "words"
        )
        ids = told.filter("block is not null").select("block", "part", "ids")
        self.words = told.filter("id is not null").select("id", "lang", "word", "n")
        self.totals = told.filter("block is null and id is null").groupBy("lang").agg(F.sum("n").alias("n"))
        asked = blocks.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(
            cogrouped(_pairs_asked(parts)), "part int, block binary, first binary, second binary, counts binary"
        )
        ranks = asked.groupBy("part").applyInArrow(
            grouped(_pairs_answered(least, hot)), "part int, block binary, ranks binary"
        )
        answers = ids.select("block", "part", "ids", F.lit(None).cast("binary").alias("ranks")).unionAll(
            ranks.select("block", "part", F.lit(None).cast("binary"), "ranks")
        )
        suffixes = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            cogrouped(_suffixes(parts)), "part int, spread boolean, columns binary, counts binary"
        )
        self.phrases = written(
            suffixes.groupBy("part").applyInArrow(
                grouped(_phrases(least)), "w1 bigint, w2 bigint, w3 bigint, w4 bigint, a bigint"
            ),
            "phrases",
        )


# --- scores ------------------------------------------------------------------------------------------

KEYS = ["w1", "w2", "w3", "w4"]


def _slice(first: int, count: int) -> list[Column]:
    """The columns of `count` words from word `first` (from 0) on, as a phrase."""
    return [F.col(KEYS[first + k]) if k < count else F.lit(0).cast("bigint") for k in range(DEPTH)]


def _named(columns: list[Column]) -> Column:
    return F.struct(*[c.alias(k) for c, k in zip(columns, KEYS)])


def scored(found: Phrases) -> DataFrame:
    """w1 to w4, a, l, r and score of all candidates that no longer phrase covers."""
    phrases = found.phrases
    size = sum((F.col(k) > 0).cast("int") for k in KEYS)
    sized = phrases.withColumn("size", size)
    zero = F.lit(0).cast("bigint")
    counts = found.words.select(F.col("id").alias("w1"), *[zero.alias(k) for k in KEYS[1:]], F.col("n")).unionAll(
        phrases.select(*KEYS, F.col("a").alias("n"))
    )
    # Every cut of a candidate: the two parts as phrases of their own.
    parts = []
    for n in range(2, DEPTH + 1):
        for k in range(1, n):
            for side, (first, count) in enumerate(((0, k), (k, n - k))):
                parts.append(F.when(F.col("size") == n, F.struct(
                    F.lit(k).alias("k"), F.lit(side).alias("side"), _named(_slice(first, count)).alias("p")
                )))
    cuts = sized.select(
        F.struct(*KEYS).alias("of"), "a", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("c")
    ).select("of", "a", "c.k", "c.side", "c.p.*")
    known = cuts.join(counts, KEYS).groupBy("of", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r")
    )
    # Products may pass 64 bits, quotients don't: a is at most l and r.
    value = known.withColumn(
        "score", F.expr(f"(cast({SCALE} as decimal(38, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + r)")
    )
    lowest = value.groupBy("of", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select(
        "of.*", "a", "b.l", "b.r", "b.score"
    )
    # Of the longer phrases around each phrase the most frequent one decides.
    inside = []
    for n in range(3, DEPTH + 1):
        for count in range(2, n):
            for first in range(n - count + 1):
                inside.append(F.when(F.col("size") == n, _named(_slice(first, count))))
    around = (
        sized.filter("size > 2")
        .select(F.col("a").alias("longer"), F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())).alias("p"))
        .groupBy("p.w1", "p.w2", "p.w3", "p.w4").agg(F.max("longer").alias("longer"))
    )
    wide = lambda x: F.col(x).cast("decimal(20, 0)")
    return lowest.join(around, KEYS, "left").filter(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * COVERED)
    ).drop("longer")


def ranked(docs: DataFrame, top: int = 2000, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n and score of each language's `top` phrases of two to four words.

    a, l and r count the phrase and the parts of its lowest-scoring cut, n all words of the language; the score is
    floor(2000000 a / (l + r)). Phrases that occur less than `least` times, and those within a longer phrase that
    occurs at least four fifths as often, are left out. Order: score, a, then the phrase by its bytes. Else as
    `Phrases`.
    """
    found = Phrases(docs, least, hot)
    words = found.words
    spoken = scored(found).join(words.select(F.col("id").alias("w1"), "lang"), "w1")
    # Rows that tie with the last one stay until the phrases are spelled out.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = written(spoken.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place"), "ranked")
    spelled = (
        near.select(F.struct(*KEYS).alias("of"), F.posexplode(F.array(*KEYS)).alias("at", "id")).filter("id > 0")
        .join(words.select("id", "word"), "id").groupBy("of")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
        .select("of.*", "phrase")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        near.join(spelled, KEYS).withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
        .join(found.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
