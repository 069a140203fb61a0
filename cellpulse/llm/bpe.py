"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

Texts are split into words with their positions. Consecutive documents form a block with a dictionary of its
own: the block holds every document as positions coded by that dictionary, and its distinct words go to the
shuffle, packed by range of their hash. Equal words meet in a range, each is encoded once, and the ids return
to the blocks that asked, where documents are reassembled by position. A word is one entry per block at most,
so no word is a hot key, and the number of ranges grows with the input.

A block is named by a digest of its dictionary and its place. The input is read twice (words, positions) and
must give the same rows in the same order both times, as a stored table does; a block whose words don't come
back complete raises an error instead of giving other ids.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.llm.memory import cogrouped, grouped, streaming
from cellpulse.llm.pretokens import words

#: A block ends with the document at which it has so many distinct words, or so many positions.
BLOCK_WORDS, BLOCK_POSITIONS = 1 << 18, 1 << 21
#: One range of word hashes per so many bytes of text.
RANGE_BYTES = 12 << 20
#: Upper bound of a vocabulary file that is sent to the executors, in bytes.
VOCABULARY_BYTES = 1 << 26


def vocabulary(spark: SparkSession, path: str):
    """A broadcast of the rank file's bytes; its size is checked."""
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


@cache
def token_bytes(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}


@cache
def encoder(ranks: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=token_bytes(ranks), special_tokens={})


@cache
def token_table(ranks: bytes) -> list[bytes]:
    """Bytes by id."""
    table = [b""] * (max(token_bytes(ranks).values()) + 1)
    for token, rank in token_bytes(ranks).items():
        table[rank] = token
    return table


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[str], list, list[np.ndarray]]]:
    """Name, dictionary, ids and coded documents of each block of a partition."""
    codes: dict[str, int] = {}
    ids: list = []
    docs: list[np.ndarray] = []
    held = number = 0

    def done():
        # Blocks of equal content differ in their place.
        digest = xxhash.xxh3_128("\x00".join(codes).encode())
        place = TaskContext.get().partitionId(), number
        digest.update(np.array([*place, *map(len, docs)], np.int64).tobytes())
        return digest.digest(), list(codes), ids, docs

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            coded = [codes.setdefault(w, len(codes)) for w in words(text)]
            ids.append(doc_id)
            docs.append(np.array(coded, np.uint32))
            held += len(coded)
            if len(codes) >= BLOCK_WORDS or held >= BLOCK_POSITIONS:
                yield done()
                codes, ids, docs, held, number = {}, [], [], 0, number + 1
    if ids:
        yield done()


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes, lowest first."""
    return zlib.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _asked(parts: int):
    """One row per block and range: codes, lengths and bytes of the block's words in that range."""
    names = ["part", "block", "codes", "sizes", "words"]

    def rows(batches):
        for name, dictionary, _, _ in _blocks(batches):
            words_ = [w.encode() for w in dictionary]
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words_), np.uint64, len(words_))
            part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
            some = [(p, order[a:b]) for p, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
            taken = [[words_[c] for c in codes.tolist()] for _, codes in some]
            columns = [
                pa.array([p for p, _ in some], pa.int32()), pa.array([name] * len(some), pa.binary()),
                pa.array([_packed(codes) for _, codes in some], pa.binary()),
                pa.array([_packed(np.fromiter(map(len, t), np.int64)) for t in taken], pa.binary()),
                pa.array([zlib.compress(b"".join(t), 1) for t in taken], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def _answers(ranks, pattern: str):
    """Encodes each distinct word of a range once; one row per block with the ids of its words in its order."""

    def rows(asked: pa.Table) -> pa.Table:
        model, memo = encoder(ranks.value, pattern), {}
        out: list[list] = [[], [], []]
        for sizes, packed in zip(asked.column("sizes").to_pylist(), asked.column("words").to_pylist()):
            ends = np.cumsum(_unpacked(sizes)).tolist()
            text, ids = zlib.decompress(packed), []
            for a, b in zip([0, *ends], ends):
                word = text[a:b]
                found = memo.get(word)
                if found is None:
                    found = memo[word] = model.encode_ordinary(word.decode())
                ids.append(found)
            out[0].append(_packed(np.fromiter(map(len, ids), np.int64)))
            out[1].append(_packed(np.fromiter((i for x in ids for i in x), np.int64)))
        columns = [asked.column("block"), asked.column("codes"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())]
        return pa.Table.from_arrays(columns, names=["block", "codes", "sizes", "ids"])

    return rows


def _coded(id_type: pa.DataType):
    """Documents as positions coded by the dictionary of their block."""
    names = ["block", "size", "doc_id", "codes"]

    def rows(batches):
        for name, dictionary, ids, docs in _blocks(batches):
            for a in range(0, len(ids), 256):
                part = docs[a : a + 256]
                columns = [
                    pa.array([name] * len(part), pa.binary()), pa.array([len(dictionary)] * len(part), pa.int32()),
                    pa.array(ids[a : a + 256], id_type), pa.array([_packed(d) for d in part], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def _id_lists(id_type: pa.DataType):
    """Rows (doc_id, ids) of documents given as little-endian ids."""

    def table(doc_ids: pa.Array, texts: Iterator[bytes]) -> pa.Table:
        texts = list(texts)
        ends = np.cumsum([0, *(len(t) // 4 for t in texts)])
        flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(texts))])
        return pa.Table.from_arrays([doc_ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc_id", "ids"])

    return table, pa.schema([("doc_id", id_type), ("ids", pa.list_(pa.int32()))])


def _digested(id_type: pa.DataType, ranks):
    """Rows of `digests`: the ids of each document are counted, written out, decoded and let go."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    types = [id_type, pa.int64(), pa.string(), pa.string()]

    def table(doc_ids: pa.Array, texts: Iterator[bytes]) -> pa.Table:
        tokens, columns = token_table(ranks.value), [[], [], []]
        numbers = [b"%d" % i for i in range(len(tokens))]
        for text in texts:
            ids = np.frombuffer(text, np.uint32).tolist()
            columns[0].append(len(ids))
            columns[1].append(hashlib.sha256(b" ".join([numbers[i] for i in ids])).hexdigest())
            columns[2].append(hashlib.sha256(b"".join([tokens[i] for i in ids])).hexdigest())
        return pa.Table.from_arrays([doc_ids, *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names=names)

    return table, pa.schema(list(zip(names, types)))


def _reassembled(finish, schema: pa.Schema):
    """Documents from their coded positions and the ids of their block's words; `finish` makes the result."""

    def rows(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        word_ids: list = [None] * docs.column("size")[0].as_py()
        for codes, sizes, ids in zip(*(answers.column(n).to_pylist() for n in ("codes", "sizes", "ids"))):
            ends = (4 * np.cumsum(_unpacked(sizes), dtype=np.int64)).tolist()
            flat = _unpacked(ids).tobytes()
            for code, a, b in zip(_unpacked(codes).tolist(), [0, *ends], ends):
                word_ids[code] = flat[a:b]
        if None in word_ids:
            raise ValueError("the input changed between two reads of it; encode a stored table")
        coded = docs.column("codes").to_pylist()
        return finish(
            docs.column("doc_id").combine_chunks(),
            (b"".join([word_ids[c] for c in _unpacked(d).tolist()]) for d in coded),
        )

    return rows


def _encoded(docs: DataFrame, ranks, pattern: str, finish, columns: str) -> DataFrame:
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, math.ceil(size / RANGE_BYTES))
    answers = (
        base.mapInArrow(streaming(_asked(parts)), "part int, block binary, codes binary, sizes binary, words binary")
        .groupBy("part").applyInArrow(grouped(_answers(ranks, pattern)), "block binary, codes binary, sizes binary, ids binary")
    )
    coded = base.mapInArrow(streaming(_coded(id_type)), f"block binary, size int, doc_id {kind}, codes binary")
    return (
        coded.groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(cogrouped(_reassembled(*finish(id_type))), f"doc_id {kind}, {columns}")
    )


def encoded(docs: DataFrame, ranks, pattern: str) -> DataFrame:
    """doc_id and `ids`, the token ids of the whole text, as the rank file's library would encode it.

    A null or empty text has no ids. Repeated rows and null ids give a row each. Other columns are not read.
    `ranks` is what `vocabulary` gives. Special tokens are not recognised.
    """
    return _encoded(docs, ranks, pattern, _id_lists, "ids array<int>")


def round_trip(docs: DataFrame, ranks, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: what `digests(decoded(encoded(docs)))` gives, without
    the ids or the decoded texts leaving the task that reassembles them."""
    return _encoded(
        docs, ranks, pattern, lambda id_type: _digested(id_type, ranks),
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def decoded(tokens: DataFrame, ranks) -> DataFrame:
    """doc_id, ids and `bytes`: the bytes of the ids, looked up in the token-byte table, which has one entry per
    vocabulary entry and is joined in place. Null ids count as none; an id outside the table is an error."""
    kinds = dict(tokens.dtypes)

    def rows(batches):
        table = token_table(ranks.value)
        for batch in batches:
            lists = batch.column("ids")
            ends, flat = np.asarray(lists.offsets).tolist(), np.asarray(lists.values)
            # One document's ids at a time; a null list is empty.
            texts = [b"".join([table[i] for i in flat[a:b].tolist()]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=["doc_id", "ids", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kinds['doc_id']}, ids array<int>, bytes binary")


def digests(tokens: DataFrame) -> DataFrame:
    """Counts and digests of what `decoded` gives."""
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
