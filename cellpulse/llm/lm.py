"""Language-model scoring by deleted interpolation.

A bigram model P(w | v) = a * c(v, w) / c(v) + b * c(w) / N + g / (V + 1), whose weights (a, b, g) depend on
the bucket of the context's frequency c(v). One fold of the training documents is deleted from the counts
while the weights are learned: expectation-maximisation maximises its likelihood under the counts of the
rest. Scores use the counts of all training documents and these weights.

How the counts travel: words and word pairs are keyed by 64-bit hashes. Consecutive documents form a block, which
is written once as one row, coded by its own dictionary. From there every block sends its own counts as sorted arrays,
one row per key range. Each range adds up what all blocks send and answers every block with the totals of its keys, in
the order in which it sent them.
A frequent word is one entry per block, and the number of ranges grows with the input, so no range outgrows a
task. The counts of the whole corpus are used; nothing is pruned.

Every block then writes, per document, the histogram of its (bigram, context, word) count triples. Learning
reads those of the deleted fold and scoring those of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.memory import cogrouped, grouped, streaming
from cellpulse.staging import discarded, written

#: A block ends with the document at which it has so many tokens; one range per so many bytes of the corpus.
BLOCK_TOKENS, RANGE_BYTES = 1 << 20, 12 << 20
ALPHA = 0.1  # fixed value of the base score
#: Upper ends of the context-frequency buckets: powers of two, the last is open; bucket 0 has unseen contexts.
BUCKETS = 24
ROUNDS, TOLERANCE = 20, 1e-5
# Begin and end of a text; words hold no space, so neither can be one.
FIRST, LAST = b" begin", b" end"
#: Kinds of documents in written tables.
TRAINED, DELETED, HELD_OUT = 0, 1, 2


def fold(doc_id: Column, folds: int = 10) -> Column:
    """crc32 of the id as text modulo `folds`; -1 for a null id, which belongs to no fold and is trained on."""
    return F.coalesce((F.crc32(doc_id.cast("string")) % folds).cast("int"), F.lit(-1))


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit key of two; words themselves use their hash with an even last bit, pairs an odd one."""
    key = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ second >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0x94D049BB133111EB)
    return (key ^ key >> np.uint64(29)) | np.uint64(1)


class Block:
    """Consecutive documents as codes of a common dictionary, each between begin and end."""

    def __init__(self, number: int):
        self.number = number
        self.codes: dict[bytes, int] = {FIRST: 0, LAST: 1}
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, doc_id, kind: int, text: str):
        codes = self.codes
        found = [codes.setdefault(w, len(codes)) for w in text.encode().lower().split()]
        self.rows.append((doc_id, kind, np.array([0, *found, 1], np.uint32)))
        self.size += len(found) + 1

    def name(self) -> bytes:
        digest = xxhash.xxh3_128(b" ".join(self.codes))
        # Blocks of equal content differ in their place.
        place = TaskContext.get().partitionId(), self.number
        digest.update(np.array([*place, *(len(c) for _, _, c in self.rows)]).tobytes())
        return digest.digest()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block = Block(0)
    for batch in batches:
        for doc_id, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
            block.add(doc_id, kind, text)
            if block.size >= BLOCK_TOKENS:
                yield block
                block = Block(block.number + 1)
    if block.rows:
        yield block


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & ~np.uint64(1)


class Keys:
    """The sorted distinct keys of a block, and where its words and pairs stand among them."""

    def __init__(self, hashes: np.ndarray, codes: np.ndarray, sizes: np.ndarray):
        h = hashes[codes]
        # A pair for every token but the last one of a document, which begins no pair.
        self.begins = np.ones(len(codes), bool)
        self.begins[np.cumsum(sizes) - 1] = False
        at = np.flatnonzero(self.begins)
        pairs, inverse = np.unique(_mixed(h[at], h[at + 1]), return_inverse=True)
        # Sorted and told apart by hand: without an inverse, the library's unique goes by hashing, which is slower here.
        keys = np.sort(np.concatenate([hashes, pairs]))
        self.keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        self.word = np.searchsorted(self.keys, hashes)[codes]
        self.pair = np.searchsorted(self.keys, pairs)[inverse]
        self.sizes = sizes

    def counts(self, counted: list[bool]) -> np.ndarray:
        """How often each key stands in the documents that are counted; the begin key counts documents."""
        chosen = np.repeat(counted, self.sizes)
        return np.bincount(
            np.concatenate([self.word[chosen], self.pair[chosen[self.begins]]]), minlength=len(self.keys)
        )


def _runs(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(range, first, behind last) of each run of equal ranges: only those that occur."""
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    return list(zip(part[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist()))


def _squeezed(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def _restored(data: bytes) -> bytes:
    return zstandard.decompress(data)


def _packed(values: np.ndarray) -> bytes:
    """Counts as bytes that compress well: low bytes first, then the next, and so on; four of each, or eight if one
    needs them, which the first byte tells."""
    width = 8 if len(values) and int(values.max()) >> 32 else 4
    wide = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + _squeezed(wide.tobytes())


def _counts(packed: bytes) -> np.ndarray:
    width = packed[0]
    wide = np.frombuffer(_restored(packed[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(wide.T).view(f"<u{width}").ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes together."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _squeezed(np.ascontiguousarray(steps).view(np.uint8).reshape(-1, 8).T.tobytes())


def _keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_restored(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _unique_sums(keys: list[np.ndarray], *counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of each list of counts."""
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
    sums = [np.add.reduceat(np.concatenate(c)[order], first) if len(flat) else np.empty(0, np.int64) for c in counts]
    return (flat[first], *sums)


def _parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range of each key: keys are spread evenly, so equal ranges of the key space are equal shares."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


BLOCK = "block binary, ids array<{kind}>, kinds binary, sizes binary, codes binary, words binary"


def _cut(arrow_id: pa.DataType):
    """One row per block: ids, kinds and numbers of codes of its documents, all their codes, and its dictionary."""
    schema = pa.schema([
        ("block", pa.binary()), ("ids", pa.list_(arrow_id)), ("kinds", pa.binary()), ("sizes", pa.binary()), ("codes", pa.binary()),
        ("words", pa.binary()),
    ])

    def rows(batches):
        for block in _blocks(batches):
            coded = [r[2] for r in block.rows]
            # Begin and end hold a space, so the dictionary is stored without them.
            words = _squeezed(b" ".join(list(block.codes)[2:]))
            yield _rows([(
                block.name(), [r[0] for r in block.rows], bytes(r[1] for r in block.rows),
                _packed(np.array([len(c) for c in coded])), _packed(np.concatenate(coded)), words,
            )], schema)

    return rows


def _opened(row: dict) -> tuple[Keys, bytes]:
    """The keys of a block and the kinds of its documents."""
    words = _restored(row["words"]).split()
    return Keys(_hashes([FIRST, LAST, *words]), _counts(row["codes"]), _counts(row["sizes"]).astype(np.int64)), row["kinds"]


def _asked(parts: int):
    """The keys of each block by range, with their counts in training documents and in the deleted fold."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.binary()), ("keys", pa.binary()), ("train", pa.binary()), ("deleted", pa.binary())])

    def rows(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                found, kinds = _opened(row)
                train, gone = found.counts([k != HELD_OUT for k in kinds]), found.counts([k == DELETED for k in kinds])
                told = [
                    (p, row["block"], _packed_keys(found.keys[a:b]), _packed(train[a:b]), _packed(gone[a:b]))
                    for p, a, b in _runs(_parts_of(found.keys, parts))
                ]
                yield _rows(told, schema)

    return rows


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _answers(asked: pa.Table) -> pa.Table:
    """Totals of a range for each block that asked, and in `fresh` how many distinct training words no block
    before it in the order of names has asked for."""
    rows = sorted(zip(*(asked.column(n).to_pylist() for n in ("block", "keys", "train", "deleted"))))
    keys, train, gone = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    for a in range(0, len(rows), 64):
        part = rows[a : a + 64]
        keys, train, gone = _unique_sums(
            [keys, *(_keys(r[1]) for r in part)],
            [train, *(_counts(r[2]).astype(np.int64) for r in part)],
            [gone, *(_counts(r[3]).astype(np.int64) for r in part)],
        )
    waiting = (keys & np.uint64(1) == 0) & (train > 0) & (keys != _hashes([FIRST])[0])
    out: list[list] = [[], [], [], [], []]
    for name, packed, _, _ in rows:
        at = np.searchsorted(keys, _keys(packed))
        fresh = int(waiting[at].sum())
        waiting[at] = False
        for column, value in zip(out, (asked.column("part")[0].as_py(), name, _packed(train[at]), _packed(gone[at]), fresh)):
            column.append(value)
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["part", "block", "train", "deleted", "fresh"])


class _Ranked:
    """Counts of the pairs of a block, of their contexts and of their words, as ranks packed into one number each."""

    def __init__(self, counts: np.ndarray, found: Keys):
        self.values, rank = np.unique(counts, return_inverse=True)
        at = np.flatnonzero(found.begins)
        word = rank[found.word].astype(np.uint64)
        # Fewer distinct counts than keys: 21 bits hold a rank, unless one document fills many blocks.
        self.bits = np.uint64(max(1, int(len(self.values)).bit_length()))
        self.wide = np.stack([rank[found.pair], rank[found.word][at], rank[found.word][at + 1]]) if 3 * self.bits > 64 else None
        self.packed = (rank[found.pair].astype(np.uint64) << self.bits | word[at]) << self.bits | word[at + 1]

    def pooled(self, a: int, b: int) -> np.ndarray:
        """Distinct (c(v, w), c(v), c(w)) of a stretch of pairs as columns, with the number of each as a last row."""
        if self.wide is not None:
            rows, n = np.unique(self.wide[:, a:b], axis=1, return_counts=True)
            return np.vstack([self.values[rows], n])
        packed, n = np.unique(self.packed[a:b], return_counts=True)
        low = (np.uint64(1) << self.bits) - np.uint64(1)
        ranks = [packed >> self.bits * np.uint64(2), packed >> self.bits & low, packed & low]
        return np.vstack([*(self.values[r.astype(np.int64)] for r in ranks), n])


def _histograms(arrow_id: pa.DataType):
    """Per document the distinct (c(v, w), c(v), c(w)) of its tokens with their number: `full` under the counts
    of all training documents, and for the deleted fold `rest` under those without the fold."""
    schema = pa.schema([
        ("doc_id", arrow_id), ("kind", pa.int32()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("fresh", pa.int64()), ("full", pa.binary()), ("rest", pa.binary()),
    ])

    def rows(docs: pa.Table, totals: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        row = docs.to_pylist()[0]
        found, kinds = _opened(row)
        parts = sorted(zip(*(totals.column(n).to_pylist() for n in ("part", "train", "deleted", "fresh"))))
        train = np.concatenate([_counts(r[1]) for r in parts]).astype(np.int64)
        left = train - np.concatenate([_counts(r[2]) for r in parts])
        if len(train) != len(found.keys):
            raise ValueError("a block has not got the counts of all its keys: the written blocks changed")
        fresh = sum(r[3] for r in parts)
        ranked = [_Ranked(train, found)] + ([_Ranked(left, found)] if DELETED in kinds else [])
        out: list[list] = [[] for _ in schema]
        end = 0
        for n, (doc_id, kind, size) in enumerate(zip(row["ids"], kinds, found.sizes.tolist())):
            # One pair less than tokens in every document before this one.
            a, b, end = end - n, end - n + size - 1, end + size
            full = ranked[0].pooled(a, b)
            rest = _packed(ranked[1].pooled(a, b).ravel()) if kind == DELETED else None
            for column, value in zip(out, (doc_id, kind, size - 1, int(full[3][full[2] > 0].sum()), fresh, _packed(full.ravel()), rest)):
                column.append(value)
            fresh = 0
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return rows


def _triples(packed: bytes) -> np.ndarray:
    return _counts(packed).reshape(4, -1).astype(np.int64)


def buckets(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count), at most BUCKETS - 1."""
    return np.where(context > 0, np.minimum(np.frexp(np.maximum(context, 1).astype(float))[1], BUCKETS - 1), 0)


def estimates(counts: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """The three estimates for rows of (c(v, w), c(v), c(w)): bigram, unigram, uniform."""
    pair, context, word = counts[0], counts[1], counts[2]
    return np.stack([
        np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0),
        word / total if total else np.zeros(len(pair)),
        np.full(len(pair), 1.0 / (distinct + 1)),
    ])


def _together(batches):
    """The histograms of many documents as one: rounds of learning read few large rows."""
    held, size = [], 0

    def done():
        values = np.concatenate(held, axis=1)
        order = np.lexsort(values[2::-1])
        values = values[:, order]
        first = np.flatnonzero(np.concatenate([[True], (values[:3, 1:] != values[:3, :-1]).any(axis=0)]))
        pooled = np.vstack([values[:3, first], np.add.reduceat(values[3], first)])
        return pa.RecordBatch.from_arrays([pa.array([_packed(pooled.ravel())], pa.binary())], names=["rest"])

    for batch in batches:
        for packed in batch.column(0).to_pylist():
            held.append(_triples(packed))
            size += held[-1].shape[1]
            if size >= BLOCK_TOKENS:
                yield done()
                held, size = [], 0
    if size:
        yield done()


def learned(rest: DataFrame, total: int, distinct: int) -> np.ndarray:
    """Weights by bucket from the deleted fold's histograms; every round is one aggregation whose result has
    BUCKETS rows of three expected counts."""
    rest = written(rest.select("rest").mapInArrow(streaming(_together), "rest binary"), "deleted")
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0, 0] = 0.0
    weights[0] /= weights[0].sum()
    before = -math.inf
    for _ in range(ROUNDS):
        now = weights

        def expected(batches):
            sums, likelihood = np.zeros((BUCKETS, 3)), 0.0
            for batch in batches:
                for packed in batch.column(0).to_pylist():
                    rows = _triples(packed)
                    bucket = buckets(rows[1])
                    shares = now[bucket].T * estimates(rows, total, distinct)
                    mixed = shares.sum(axis=0)
                    for k in range(3):
                        sums[:, k] += np.bincount(bucket, rows[3] * shares[k] / mixed, BUCKETS)
                    likelihood += float((rows[3] * np.log(mixed)).sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BUCKETS + 1)), *(pa.array(np.append(sums[:, k], likelihood if k == 0 else 0.0)) for k in range(3))],
                names=["bucket", "a", "b", "g"],
            )

        found = rest.select("rest").mapInArrow(streaming(expected), "bucket bigint, a double, b double, g double")
        sums = {r[0]: r[1:] for r in found.groupBy("bucket").agg(F.sum("a"), F.sum("b"), F.sum("g")).collect()}
        if not sums:
            break
        new = np.array([sums.get(k, (0.0, 0.0, 0.0)) for k in range(BUCKETS)])
        seen = new.sum(axis=1) > 0
        weights = np.where(seen[:, None], new / np.maximum(new.sum(axis=1, keepdims=True), 1e-300), weights)
        likelihood = sums[BUCKETS][0]
        if likelihood - before < TOLERANCE * abs(likelihood):
            break
        before = likelihood
    # Keep a share for unseen words in every bucket, so that no text has probability zero.
    weights = np.maximum(weights, 1e-6)
    weights[0, 0] = 0.0
    return weights / weights.sum(axis=1, keepdims=True)


def scored(docs: DataFrame, folds: int = 10, held_out: int = 0, deleted: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Texts are lower-cased (A-Z) and split at white space; one end token follows, so an empty or null text has
    one token. Training documents are those whose fold is not `held_out`; rows without an id are training
    documents, repeated rows count each time. `n_known` counts tokens with a training count, `base_score` is the
    add-0.1 unigram log10 probability, `score` the model's. Without training documents the unigram estimate is
    zero and `base_score` is the uniform one. Other columns are not read. The input is read once.
    """
    base = docs.select(
        "doc_id", fold(F.col("doc_id"), folds).alias("split"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    base = base.withColumn(
        "split", F.when(F.col("split") == held_out, HELD_OUT).when(F.col("split") == deleted, DELETED).otherwise(TRAINED)
    )
    kind = base.schema["doc_id"].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(kind, pa.string())
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, math.ceil(size / RANGE_BYTES))
    blocks = written(base.mapInArrow(streaming(_cut(arrow_id)), BLOCK.format(kind=kind)), "blocks")
    asked = blocks.select("block", "sizes", "kinds", "codes", "words").mapInArrow(
        streaming(_asked(parts)), "part int, block binary, keys binary, train binary, deleted binary"
    )
    # Written, so that the keys that went to the ranges needn't stay while the blocks travel.
    answers = written(
        asked.groupBy("part").applyInArrow(
            grouped(_answers), "part int, block binary, train binary, deleted binary, fresh bigint"
        ), "totals",
    )
    told = written(
        blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            cogrouped(_histograms(arrow_id)),
            f"doc_id {kind}, kind int, n_tokens bigint, n_known bigint, fresh bigint, full binary, rest binary",
        ),
        "histograms",
    )
    discarded(blocks, answers)
    of = lambda test: F.coalesce(F.sum(F.when(test, F.col("n_tokens"))), F.lit(0))
    total, fewer, distinct = told.agg(
        of(F.col("kind") != HELD_OUT), of(F.col("kind") == TRAINED), F.coalesce(F.sum("fresh"), F.lit(0))
    ).first()
    weights = learned(told.filter(F.col("kind") == DELETED), fewer, distinct)

    def score(batches):
        floor = math.log10(total + ALPHA * (distinct + 1))
        for batch in batches:
            base_scores, scores = [], []
            for packed in batch.column("full").to_pylist():
                rows = _triples(packed)
                base_scores.append(float((rows[3] * (np.log10(rows[2] + ALPHA) - floor)).sum()))
                mixed = (weights[buckets(rows[1])].T * estimates(rows, total, distinct)).sum(axis=0)
                scores.append(float((rows[3] * np.log10(mixed)).sum()))
            n = len(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.asarray(batch.column("kind")) == HELD_OUT), batch.column("n_tokens"),
                 batch.column("n_known"), pa.array([total] * n, pa.int64()), pa.array(base_scores), pa.array(scores)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return told.select("doc_id", "kind", "n_tokens", "n_known", "full").mapInArrow(
        streaming(score),
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
