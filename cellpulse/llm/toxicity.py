"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A window of words is compressed
with the ordinary dictionary alone and with the toxic one in front of it; the bytes that the toxic dictionary
saves are the window's distance. A document is described by how its windows' distances are spread, and
thresholds and weights of this description are calibrated on labelled documents of their own.

Both compressors share the ordinary dictionary at the same offsets, and its match finder indexes every third
byte, so the toxic part has a length that keeps this alignment and is held three times, shifted by a byte
each: text without toxic matches compresses to the same length with both.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.memory import streaming
from cellpulse.staging import written

#: Bound of the labelled sample that is fitted on, per class (a documented parameter): training documents with
#: the smallest hashes of their ids.
SAMPLE_TOXIC, SAMPLE_ORDINARY = 1500, 6000
#: Share of each sample that trains the dictionaries; the rest calibrates.
TRAINING = 0.6
#: Windows of a training document that the dictionaries see: those of least hash, from all of its text.
WINDOWS = 48
ORDINARY_BYTES, TOXIC_BYTES, WINDOW = 200_000, 2048, 16
#: A beginning of words is toxic text if so many toxic documents have it and it is so many times as frequent in them.
LEAST_DOCUMENTS, LEAST_RATIO = 4, 10
LEVELS = (1, 2, 3, 4, 6)
EDGE = b".,;:!?\"'()"


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce((F.crc32(doc_id.cast("string")) % folds).cast("int"), F.lit(-1))


def windows(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()
    return [b" %b " % b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]


def some_windows(text: str | None) -> list[bytes]:
    """At most WINDOWS windows of a text, in its order, chosen by their hashes."""
    found = windows(text)
    if len(found) <= WINDOWS:
        return found
    chosen = sorted(range(len(found)), key=lambda i: (zlib.crc32(b"%d %b" % (i, found[i])), i))[:WINDOWS]
    return [found[i] for i in sorted(chosen)]


def _beginnings(word: bytes) -> list[bytes]:
    """The word without punctuation at its ends, marked as whole, and its beginnings of four bytes or more,
    longest first."""
    word = word.strip(EDGE)
    return [word + b" ", *(word[:n] for n in range(min(len(word), 16), 3, -1))]


def _trained(size: int, samples: list[bytes], k: int) -> bytes:
    """Content of a trained dictionary; too little text to train on is its own dictionary."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """The ordinary dictionary, and the toxic one trained on what toxic texts say and ordinary ones don't; texts are
    lists of windows."""
    seen = [
        Counter(p for t in texts for p in {p for w in {w for x in t for w in x.split()} for p in _beginnings(w)})
        for texts in (toxic, ordinary)
    ]
    rate = LEAST_RATIO * len(toxic) / max(1, len(ordinary))
    own = {p for p, n in seen[0].items() if n >= LEAST_DOCUMENTS and n > rate * (seen[1][p] + 0.5)}
    longest = (next((p for p in _beginnings(w) if p in own), None) for t in toxic for x in t for w in x.split())
    said = [b" %b" % p for p in longest if p]
    samples = [b"".join(said[i : i + 16]) for i in range(0, len(said), 16)]
    base = _trained(ORDINARY_BYTES, [x for t in ordinary for x in t], 32)
    one = _trained(TOXIC_BYTES, samples * 3, 16) if samples else b""
    one = one[len(one) % 24 :]
    shifted = b"".join(one + b" " for _ in range(3))
    return base, b" " * (-len(shifted) % 24) + shifted


@cache
def _compressors(base: bytes, toxic: bytes):
    settings = zstandard.ZstdCompressionParameters(
        window_log=19, hash_log=18, chain_log=14, search_log=1, min_match=5, target_length=1,
        strategy=zstandard.STRATEGY_FAST, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    made = []
    for content in (base, toxic + base):
        # Content below eight bytes is no dictionary for the library.
        content = zstandard.ZstdCompressionDict(content.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=settings)
        made.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings))
    return made


def description(text: str | None, base: bytes, toxic: bytes) -> np.ndarray:
    """How the distances of all windows of a text are spread; all zero without words."""
    plain, with_toxic = _compressors(base, toxic)
    found = windows(text)
    if not found:
        return np.zeros(2 + 2 * len(LEVELS) + 2)
    saved = np.array([len(plain.compress(w)) - len(with_toxic.compress(w)) for w in found])
    over = [(saved >= level) for level in LEVELS]
    return np.array(
        [saved.max(), saved.mean(), *(10 * o.mean() for o in over), *(np.log1p(o.sum()) for o in over),
         10 * (saved < 0).mean(), np.log(len(saved))]
    )


class Classifier:
    """Dictionaries and calibration; small and of bounded size, so tasks get a copy."""

    def __init__(self, base: bytes, toxic: bytes, rows: np.ndarray, labels: np.ndarray):
        self.base, self.toxic = base, toxic
        rows = rows.reshape(len(rows), 4 + 2 * len(LEVELS))
        self.mean = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
        self.scale = (rows.std(axis=0) if len(rows) else np.zeros(rows.shape[1])) + 1e-9
        self.weights = _logistic((rows - self.mean) / self.scale, labels)

    def score(self, text: str | None) -> float:
        rows = description(text, self.base, self.toxic)
        z = self.weights[0] + ((rows - self.mean) / self.scale) @ self.weights[1:]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Penalised logistic weights by Newton steps; a single class gives its smoothed share."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    weights = np.zeros(rows.shape[1] + 1)
    weights[0] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return weights
    x = np.c_[np.ones(len(rows)), rows]
    ridge = penalty * len(labels) * np.diag(np.r_[0.0, np.ones(rows.shape[1])])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(weights)), x.T @ (p - labels) + ridge @ weights)
        step /= max(1.0, np.abs(step).max())  # steps of at most one keep nearly separated classes from overshooting
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fitted(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Classifier:
    """A classifier from at most SAMPLE_TOXIC and SAMPLE_ORDINARY labelled documents outside the held-out fold.

    Rows with a null id, text or label aren't used; of contradicting labels both are; of rows with equal ids one is.
    The sample is a fixed function of the ids. Without labels every document gets the same score. Whole texts stay in
    the tasks: the driver gets WINDOWS windows of each training document, drawn from all of its text, and the
    description, a dozen numbers, of the whole text of each calibrating one.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    usable = marked.filter(fold(F.col("doc_id"), folds) != held_out).distinct()
    chosen = []
    for toxic, bound in ((True, SAMPLE_TOXIC), (False, SAMPLE_ORDINARY)):
        chosen.append(usable.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    sample = chosen[0].unionAll(chosen[1])
    texts = docs.filter("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    # One text of each id and label, so that rows that repeat an id aren't taken: at most the two bounds.
    rows = written(
        texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(
            F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
        ), "sample",
    )
    kind = dict(rows.dtypes)["doc_id"]
    ids = sorted(((r.doc_id, r.toxic) for r in rows.select("doc_id", "toxic").collect()), key=lambda r: (hash_of(r[0]), str(r[0])))
    cut = {toxic: int(TRAINING * sum(r[1] == toxic for r in ids) + 0.5) for toxic in (True, False)}
    part: dict[bool, list] = {True: [], False: []}
    for doc_id, toxic in ids:
        part[toxic].append(doc_id)
    order = {(doc_id, toxic): n for n, (doc_id, toxic) in enumerate(ids)}
    trains = [(doc_id, toxic) for toxic in part for doc_id in part[toxic][: cut[toxic]]]
    training = docs.sparkSession.createDataFrame(trains, f"doc_id {kind}, toxic boolean").withColumn("trains", F.lit(True))
    split = rows.join(F.broadcast(training), ["doc_id", "toxic"], "left")

    def cut_up(batches):
        for batch in batches:
            found = [some_windows(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.binary()))], names=["doc_id", "toxic", "windows"]
            )

    taken = split.filter("trains").select("doc_id", "toxic", "text").mapInArrow(
        streaming(cut_up), f"doc_id {kind}, toxic boolean, windows array<binary>"
    ).collect()
    taken.sort(key=lambda r: order[r.doc_id, r.toxic])
    said = {toxic: [[bytes(w) for w in r.windows] for r in taken if r.toxic == toxic] for toxic in (True, False)}
    base, toxic_ = dictionaries(said[True], said[False])

    def described(batches):
        for batch in batches:
            found = [description(t, base, toxic_).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "toxic", "row"]
            )

    told = split.filter("trains is null").select("doc_id", "toxic", "text").mapInArrow(
        streaming(described), f"doc_id {kind}, toxic boolean, row array<double>"
    ).collect()
    told.sort(key=lambda r: (not r.toxic, order[r.doc_id, r.toxic]))
    return Classifier(base, toxic_, np.array([r.row for r in told], float), np.array([float(r.toxic) for r in told]))


def hash_of(doc_id) -> int:
    return zlib.crc32(f"order {doc_id}".encode())


def scored(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id and score of every row: every window of the whole text is compared.

    Null and empty texts get the score of a text without windows. Repeated rows are scored alike; null ids stay.
    Other columns are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches):
        for batch in batches:
            scores = [classifier.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(streaming(rows), f"doc_id {kind}, score double")


def rejected_removed(docs: DataFrame, classifier: Classifier, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below `threshold`.

    Null and empty texts get the score of a text without windows, rows without an id that of their text, and repeated
    rows stay or go together; an empty table stays empty.
    """
    schema = docs.schema

    def rows(batches):
        for batch in batches:
            keep = [classifier.score(t) < threshold for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(streaming(rows), schema)
