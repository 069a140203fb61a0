"""Operators that judge each document: tokens, counts, rules, toxicity, language model."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import regex

import numpy as np
from pyspark.sql import functions as F
from cellpulse.llm import bpe, counts, lm, queries, rules, toxicity
from cellpulse.llm.pretokens import CHUNK, chunks, words


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_words_equal_pattern():
    pattern, chance = regex.compile(public_tokenizers.PATTERN), random.Random(1)
    pieces = [*" \n\t'sdtmrevl ab12.,!?é\x1c\x85　中٣Ⅷ²ﬁ", "'s", "'re", "'ll", " '", "  ", "\n\n"]
    for _ in range(20_000):
        text = "".join(chance.choice(pieces) for _ in range(chance.randint(0, 14)))
        assert words(text) == pattern.findall(text)


def test_long_texts_are_cut_where_words_start():
    text = ("some words, 12 of\n\nthem  " * (CHUNK // 12))[: 2 * CHUNK + 17]
    assert len(list(chunks(text))) > 1
    assert words(text) == regex.findall(public_tokenizers.PATTERN, text)


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def expected_tokens(ranks, text):
    ids = bpe.encoder(ranks.value, public_tokenizers.PATTERN).encode_ordinary(text or "")
    return len(ids), sha(" ".join(map(str, ids))), sha(text or "")


def test_bpe_query(spark, folder, texts, ranks):
    got = queries.op2_byte_level_bpe(spark, folder).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: expected_tokens(ranks, t) for i, t in texts.items()}
    assert len(got) == len(texts)


def test_bpe_hard_rows(hard, ranks):
    got = bpe.digests(bpe.decoded(bpe.encoded(hard, ranks, public_tokenizers.PATTERN), ranks)).collect()
    want = Counter((r.doc_id, *expected_tokens(ranks, r.text)) for r in hard.select("doc_id", "text").collect())
    assert Counter(map(tuple, got)) == want


def test_bpe_small_blocks(documents, texts, ranks, monkeypatch):
    """Many blocks give the same ids; blocks are formed in tasks, so only the range size can be patched here."""
    monkeypatch.setattr(bpe, "RANGE_BYTES", 1000)
    got = bpe.encoded(documents, ranks, public_tokenizers.PATTERN).select("doc_id", F.size("ids")).collect()
    assert {r[0]: r[1] for r in got} == {i: expected_tokens(ranks, t)[0] for i, t in texts.items()}


def test_bpe_empty(table, ranks):
    assert bpe.encoded(table([]), ranks, public_tokenizers.PATTERN).count() == 0


def test_counts(spark, hard, tmp_path):
    file = counts.tokenizer_file(spark, public_tokenizers.path("byte_bpe_50k.json"))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter(
        (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in hard.select("doc_id", "text").collect()
    )
    cache = str(tmp_path / "cache")
    assert Counter(map(tuple, counts.counted(hard, file, cache).collect())) == want
    stored = spark.read.parquet(cache)
    rows = stored.count()
    assert rows == hard.select(F.coalesce("text", F.lit(""))).distinct().count()
    # A second run takes everything from the cache; another version of the tokenizer doesn't.
    assert Counter(map(tuple, counts.counted(hard, file, cache).collect())) == want
    assert spark.read.parquet(cache).count() == rows
    other = counts.tokenizer_file(spark, public_tokenizers.path("piece_bpe_32k.model"))
    counts.counted(hard, other, cache)
    assert spark.read.parquet(cache).count() == 2 * rows


def test_counts_read_the_cache(spark, table, tmp_path):
    """A stored count is believed, so it was not encoded again."""
    file = counts.tokenizer_file(spark, public_tokenizers.path("byte_bpe_50k.json"))
    digest = hashlib.sha256(b"hello there").digest()
    cache = str(tmp_path / "cache")
    spark.createDataFrame([(counts.version(*file.value), digest, 77)], counts.CACHE).write.parquet(cache)
    got = counts.counted(table([(1, "hello there"), (2, "hello")]), file, cache).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {1: 77, 2: 1}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_other_tokenizers(spark, texts, name):
    kind, data = counts.tokenizer_file(spark, public_tokenizers.path(name)).value
    some = list(texts.values())[:20]
    if name.endswith(".model"):
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_proto=data).encode(some)]
    else:
        from tokenizers import Tokenizer

        want = [len(x.ids) for x in Tokenizer.from_str(data.decode()).encode_batch(some, add_special_tokens=False)]
    assert counts.Counter(kind, data)(some) == want


def test_counts_by_words_are_the_librarys(monkeypatch):
    """Words of many texts go to the library's model at once, each only once while remembered."""
    kind, data = ".json", open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    chance = random.Random(4)
    pieces = [*map(chr, range(0x180)), *"中文٣Ⅷ😀\u2028\u3000", " the", "ing", "<|endoftext|>", "\n\n", "'ll"]
    texts = ["", "".join(map(chr, range(256))), "<|endoftext|>", "ab " * 1000]
    texts += ["".join(chance.choice(pieces) for _ in range(chance.randint(0, 200))) for _ in range(400)]
    counter = counts.Counter(kind, data)
    want = [len(x.ids) for x in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]

    class Model:
        def __init__(self, model):
            self.asked, self.tokenize = [], lambda w: self.asked.append(w) or model.tokenize(w)

    class Library:
        model = Model(counter.tokenizer.model)

    counter.tokenizer = Library
    assert counter(texts) == want
    assert len(set(Library.model.asked)) == len(Library.model.asked) == len(counter.memo)
    monkeypatch.setattr(counts, "MEMO", 50)
    monkeypatch.setattr(counts, "CHARACTERS", 300)
    assert counter(texts) == want


def measured(text):
    text = text or ""
    found = regex.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    many = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    return (
        len(found), sum(map(len, found)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)),
        len(repeated), len(lines),
    )


def test_rules_hard_rows(hard, texts):
    got = rules.measured(hard).drop("n_capitals").collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *measured(r.text)) for r in hard.select("doc_id", "text").collect())


def test_rules_policies_and_ablations(table):
    rows = [(1, "word " * 80), (2, "a b c"), (3, " ".join(f"w{i}" for i in range(90))), (4, " ".join(f"word{i}#" for i in range(60))), (5, None)]
    book = rules.ledger(table(rows)).cache()
    kept = lambda p: {r.doc_id for r in rules.applied(book, p).filter("kept").collect()}
    assert kept("base") == {3, 4} and kept("v1") == {3} and kept("v2") <= kept("v1")
    failed = [r.failed for r in book.collect()]
    for r in rules.ablations(book).collect():
        mask = rules.mask(r.policy)
        without = mask & ~(1 << rules.RULES[r.rule])
        assert (r.kept, r.kept_without_rule) == (sum(not f & mask for f in failed), sum(not f & without for f in failed))
    assert rules.ledger(table([])).count() == 0 and rules.ablations(rules.ledger(table([]))).count() == 0


def test_rules_stay_native(hard):
    plan = rules.ledger(hard)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Exchange"))


INSULTS = ["vilegrub", "dreckwort", "fulmaldo", "naskrept"]


def toxic_rows(n=1500):
    chance = random.Random(4)
    common = ["".join(chance.choice("abcdefghilmnorstu") for _ in range(chance.randint(2, 9))) for _ in range(3000)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        said = [chance.choice(common) for _ in range(chance.randint(20, 200))]
        for _ in range(chance.randint(2, 6) if toxic else 0):
            said.insert(chance.randrange(len(said)), chance.choice(INSULTS))
        rows.append((i, " ".join(said)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark, table):
    rows, labels = toxic_rows()
    docs = table(rows)
    classifier = toxicity.fitted(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    label, score = dict(labels), {r.doc_id: r.score for r in toxicity.scored(docs, classifier).collect()}
    held = [i for i in score if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((score[i] >= 0.5) == label[i] for i in held)
    assert len(score) == len(rows) and right / len(held) > 0.9
    kept = {r.doc_id for r in toxicity.rejected_removed(docs, classifier).collect()}
    assert kept == {i for i in score if score[i] < 0.5}


def test_toxicity_labels_outside_training_change_nothing(spark, table):
    rows, labels = toxic_rows(400)
    docs = table(rows)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    made = [toxicity.fitted(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned)]
    assert (made[0].base, made[0].toxic) == (made[1].base, made[1].toxic)
    assert np.array_equal(made[0].weights, made[1].weights)


def test_toxicity_hard_rows(spark, hard, table):
    rows, labels = toxic_rows(300)
    classifier = toxicity.fitted(table(rows), spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int"))
    got = toxicity.scored(hard, classifier).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fitted(table([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert len({r.score for r in toxicity.scored(hard, none).collect()}) == 1
    one = toxicity.fitted(table(rows), spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, toxic int"))
    assert all(r.score > 0.5 for r in toxicity.scored(table(rows), one).collect())


def brute_model(texts):
    """Counts and base scores of the contract by plain dictionaries."""
    split = {i: [*(t or "").encode().lower().split(), None] for i, t in texts}
    trained = Counter(w for i, ws in split.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, distinct = sum(trained.values()), len(trained)
    base = lambda w: math.log10((trained[w] + 0.1) / (total + 0.1 * (distinct + 1)))
    return {i: (len(ws), sum(trained[w] > 0 for w in ws), total, sum(map(base, ws))) for i, ws in split.items()}


def test_lm_query(spark, folder, texts):
    got = queries.op8_lm_scoring(spark, folder).collect()
    want = brute_model(texts.items())
    assert len(got) == len(want)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one():
    """Over all words that were seen, and one for the rest, after any context."""
    counts_, weights = Counter({"a": 5, "b": 3, "c": 2}), np.full((lm.BUCKETS, 3), [0.5, 0.3, 0.2])
    pairs = Counter({("a", "b"): 3, ("a", "c"): 2})
    rows = np.array([[pairs["a", w] for w in "abcx"], [5] * 4, [counts_[w] for w in "abcx"], [1] * 4])
    p = (weights[lm.buckets(rows[1])].T * lm.estimates(rows, 10, 3)).sum(axis=0)
    assert p.sum() == pytest.approx(1)


def test_lm_hard_rows(hard, table):
    got = lm.scored(hard).collect()
    assert len(got) == hard.count() and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert lm.scored(table([])).count() == 0
    # Nothing to train on: the uniform estimate has its third of every context but the unseen ones', there half.
    alone = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    assert lm.scored(table([(alone, "a b")])).first().score == pytest.approx(3 * math.log10(0.5), abs=1e-3)


def test_toxicity_sample_is_bounded_in_rows(spark, table, monkeypatch):
    """Rows that repeat a sampled id are one text of the sample."""
    taken = []
    made = toxicity.dictionaries
    monkeypatch.setattr(toxicity, "dictionaries", lambda *texts: taken.extend(texts) or made(*texts))
    monkeypatch.setattr(toxicity, "Classifier", lambda base, toxic, rows, labels: taken.append(rows))
    ids = [i for i in range(99) if zlib.crc32(str(i).encode()) % 5][:4]
    rows = [(ids[0], f"text {k}") for k in range(50)] + [(i, "other text") for i in ids[1:]]
    toxicity.fitted(table(rows), spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int"))
    assert len(taken[0]) + len(taken[1]) + len(taken[2]) == 4


def test_toxicity_sees_all_of_a_long_text():
    """Windows that train come from a whole text, whatever its length, and so does a description."""
    text = " ".join(f"word{i}" for i in range(80_000))
    found = toxicity.some_windows(text)
    places = [int(w.split()[0][4:]) for w in found]
    assert len(found) == toxicity.WINDOWS and places == sorted(places)
    assert places[0] < 20_000 and places[-1] > 60_000
    rows, labels = toxic_rows(300)
    said = [toxicity.some_windows(t) for i, t in rows]
    toxic = [w for w, (_, t) in zip(said, labels) if t]
    base, own = toxicity.dictionaries(toxic, [w for w, (_, t) in zip(said, labels) if not t])
    late = text + " " + b" ".join(toxic[0]).decode()
    assert toxicity.description(late, base, own)[0] > toxicity.description(text, base, own)[0]


def test_rejected_rows_on_hard_and_empty_tables(spark, hard, table):
    rows, labels = toxic_rows(300)
    classifier = toxicity.fitted(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    kept = toxicity.rejected_removed(hard, classifier)
    assert kept.schema == hard.schema and kept.exceptAll(hard).count() == 0
    scores = {(r.doc_id, r.text): classifier.score(r.text) for r in hard.collect()}
    assert {(r.doc_id, r.text) for r in kept.collect()} == {k for k, v in scores.items() if v < 0.5}
    assert toxicity.rejected_removed(hard.limit(0), classifier).count() == 0


def plain_scores(texts):
    """The interpolated model by dictionaries: expectation-maximisation over the tokens of the deleted fold."""
    split = {i: [" begin", *(t or "").encode().lower().split(), " end"] for i, t in texts}
    fold = {i: zlib.crc32(str(i).encode()) % 10 for i in split}

    def counted(ids):
        words, pairs, contexts = Counter(), Counter(), Counter()
        for i in ids:
            words.update(split[i][1:])
            contexts.update(split[i])
            pairs.update(zip(split[i], split[i][1:]))
        return words, pairs, contexts, sum(words.values())

    def parts(counts, v, w, distinct):
        words, pairs, contexts, total = counts
        n = contexts[v]
        bucket = min(int(math.log2(n)) + 1, lm.BUCKETS - 1) if n else 0
        return bucket, (pairs[v, w] / n if n else 0.0, words[w] / total if total else 0.0, 1 / (distinct + 1))

    full = counted([i for i in split if fold[i] != 0])
    rest = counted([i for i in split if fold[i] > 1])
    distinct = len(full[0])
    weights = [[0.0, 0.5, 0.5]] + [[1 / 3] * 3 for _ in range(lm.BUCKETS - 1)]
    before = -math.inf
    for _ in range(lm.ROUNDS):
        sums, likelihood = [[0.0] * 3 for _ in range(lm.BUCKETS)], 0.0
        for i in split:
            if fold[i] == 1:
                for v, w in zip(split[i], split[i][1:]):
                    bucket, e = parts(rest, v, w, distinct)
                    shares = [a * b for a, b in zip(weights[bucket], e)]
                    likelihood += math.log(sum(shares))
                    for k in range(3):
                        sums[bucket][k] += shares[k] / sum(shares)
        weights = [[x / sum(row) for x in row] if sum(row) else old for row, old in zip(sums, weights)]
        if likelihood - before < lm.TOLERANCE * abs(likelihood):
            break
        before = likelihood
    weights = [[max(x, 1e-6) for x in row] for row in weights]
    weights[0][0] = 0.0
    weights = [[x / sum(row) for x in row] for row in weights]
    found = {}
    for i, words_ in split.items():
        total = 0.0
        for v, w in zip(words_, words_[1:]):
            bucket, e = parts(full, v, w, distinct)
            total += math.log10(sum(a * b for a, b in zip(weights[bucket], e)))
        found[i] = total
    return found


def test_lm_scores_equal_plain_expectation_maximisation(table):
    chance = random.Random(11)
    vocabulary = [f"w{int(chance.paretovariate(0.7))}" for _ in range(500)]
    texts_ = [(i, " ".join(chance.choices(vocabulary, k=chance.randint(0, 60)))) for i in range(150)] + [(200, None), (201, "")]
    want = plain_scores(texts_)
    got = {r.doc_id: r.score for r in lm.scored(table(texts_)).collect()}
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_counts_of_any_size_are_kept():
    for values in ([], [0, 5, 2**32 - 1], [7, 2**32, 2**45], [2**62]):
        assert lm._counts(lm._packed(np.array(values, np.int64))).tolist() == values
