"""Token counts with a digest cache.

The cache is a Parquet table (version, digest, n_tokens). `version` is a digest of the tokenizer file and
library, `digest` one of the normalised text. Documents are reduced to distinct texts, those without a stored
count are encoded, and their counts are appended; every document then takes its count from the cache.

Normalising must not change a count, so a null text becomes the empty text and nothing else is changed.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.llm.memory import streaming
from cellpulse.llm.pretokens import words
from cellpulse.operators.lookup import spread_lookup

CACHE = "version string, digest binary, n_tokens bigint"
#: Words whose counts a task remembers, characters of texts looked at together, and the bound of a tokenizer file in bytes.
MEMO, CHARACTERS, FILE_BYTES = 1 << 18, 1 << 20, 1 << 26


def tokenizer_file(spark: SparkSession, path: str):
    """The kind and bytes of a tokenizer file as a broadcast of checked size."""
    with open(path, "rb") as file:
        data = file.read(FILE_BYTES + 1)
    if len(data) > FILE_BYTES:
        raise ValueError(f"{path} is larger than {FILE_BYTES} bytes")
    return spark.sparkContext.broadcast((os.path.splitext(path)[1], data))


def version(kind: str, data: bytes) -> str:
    """Digest of everything that decides a count: the file and the library that reads it."""
    if kind == ".model":
        import sentencepiece as library
    else:
        import tokenizers as library
    return hashlib.sha256(data + f"{library.__name__} {library.__version__}".encode()).hexdigest()


@cache
def _loaded(kind: str, data: bytes):
    """The tokenizer, and the special strings if its words can be counted one by one."""
    if kind == ".model":
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=data), None
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    settings = json.loads(data)
    split = settings.get("pre_tokenizer") or {}
    plain = (
        settings.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in settings["added_tokens"])
    )
    made = Tokenizer.from_str(data.decode())
    made.no_truncation()
    made.no_padding()
    return made, [t["content"] for t in settings["added_tokens"]] if plain else None


@cache
def _letters() -> dict[int, int]:
    """The character by which byte-level tokenizers write each byte: printable ones are themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


class Counter:
    """Counts tokens as the library does; words of byte-level tokenizers are encoded once while remembered."""

    def __init__(self, kind: str, data: bytes):
        self.kind = kind
        self.tokenizer, self.special = _loaded(kind, data)
        self.memo: dict[str, int] = {}

    def _parts(self, text: str) -> tuple[list[str], int]:
        """Ordinary parts of a text and the number of special strings between them."""
        import re

        if not self.special or not any(s in text for s in self.special):
            return [text], 0
        pieces = re.split("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))), text)
        return pieces, len(pieces) - 1

    def __call__(self, texts: list[str]) -> list[int]:
        if self.kind == ".model":
            return [len(x) for x in self.tokenizer.encode(texts, num_threads=1)]
        if self.special is None:
            return [len(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts: list[int] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CHARACTERS):
                size += len(texts[end])
                end += 1
            counts += self._by_words(texts[at:end])
            at = end
        return counts

    def _by_words(self, texts: list[str]) -> list[int]:
        """Counts of texts as sums of the counts of their words; new words of all texts are encoded together."""
        found, totals = [], []
        for text in texts:
            parts, special = self._parts(text)
            found.append([w for part in parts for w in words(part)] if special else words(text))
            totals.append(special)
        memo, every = self.memo, set().union(*found)
        new = every.difference(memo)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = every
        # Words need no more splitting: the library's model takes them as the characters of their bytes.
        tokens, letters = self.tokenizer.model.tokenize, _letters()
        for w in new:
            memo[w] = len(tokens(w.encode().decode("latin-1").translate(letters)))
        return [special + sum(map(memo.__getitem__, f)) for special, f in zip(totals, found)]


def counted(docs: DataFrame, tokenizer, cache_path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row; appends new counts to the cache at `cache_path`.

    Null and empty texts have no tokens. Repeated rows and null ids give a row each; other columns are not
    read. An empty input gives no rows and appends nothing. Two runs at a time may store a count twice; equal
    (version, digest) rows hold equal counts and are read once.
    """
    spark = docs.sparkSession
    named = version(*tokenizer.value)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))

    def stored() -> DataFrame:
        rows = spark.read.schema(CACHE).parquet(cache_path).filter(F.col("version") == named)
        return rows.groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))

    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)  # so that there is a table to read

    def count(batches):
        counter = Counter(*tokenizer.value)
        schema = pa.schema([("version", pa.string()), ("digest", pa.binary()), ("n_tokens", pa.int64())])
        for batch in batches:
            n = counter(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([named] * len(n)), batch.column("digest"), pa.array(n, pa.int64())], schema=schema
            )

    distinct = keyed.select("digest", "text").dropDuplicates(["digest"])
    misses = distinct.join(stored().select("digest"), "digest", "left_anti")
    misses.mapInArrow(streaming(count), CACHE).write.mode("append").parquet(cache_path)
    sizes = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    # A text that many documents have is looked up in place and its rows are dealt out.
    held = sizes.groupBy("digest").agg(F.count(F.lit(1)).alias("held"))
    found = spread_lookup(sizes, stored().join(held, "digest"), "digest", "held", ["doc_id"])
    return found.select("doc_id", "n_bytes", "n_tokens")
