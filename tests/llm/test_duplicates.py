"""Operators that compare documents, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from cellpulse.llm import components, decontaminate, paragraphs, queries, repeats, simhash
from cellpulse.staging import written


class Groups(dict):
    def __missing__(self, x):
        return x

    def root(self, x):
        while self[x] != x:
            x = self[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self[max(x, y)] = min(x, y)


def test_components(spark):
    chance = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 500)]
    edges += [(chance.randrange(1000, 1400), chance.randrange(1000, 1400)) for _ in range(300)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    assert got == {x: groups.root(x) for a, b in edges for x in (a, b) if a != b}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_what_spark_hashes(spark):
    value = spark.sql("select xxhash64('a b c') as h").first().h
    assert simhash.fingerprint("A  b\tc") == value % (1 << 64)


def test_simhash_query(spark, folder, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    groups, ids = Groups(), sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                groups.join(i, j)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash_near_dedup(spark, folder).collect()}
    assert got == {i: (f"{prints[i]:016x}", groups.root(i)) for i in ids}


@pytest.mark.parametrize("block", [2048, 40])
def test_simhash_links(spark, monkeypatch, block):
    """Chains and a dense group of fingerprints; small blocks cut every cell into pairs of blocks."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    chance = random.Random(5)
    values = {chance.getrandbits(64) for _ in range(200)}
    for value in list(values)[:20]:
        for _ in range(6):
            for _ in range(chance.randint(1, 3)):
                value ^= 1 << chance.randrange(64)
            values.add(value)
    centre = chance.getrandbits(64)
    values |= {centre ^ (1 << chance.randrange(64)) ^ (1 << chance.randrange(64)) for _ in range(150)}
    fps = sorted(np.array(list(values), np.uint64).view(np.int64).tolist())
    groups = Groups()
    for n, x in enumerate(fps):
        for y in fps[:n]:
            if ((x ^ y) % (1 << 64)).bit_count() <= 3:
                groups.join(x, y)
    distinct = written(spark.createDataFrame([(x,) for x in fps], "fp long"), "fps")
    roots = {r.node: r.root for r in components.connected(simhash.links(distinct)).collect()}
    assert {x: roots.get(x, x) for x in fps} == {x: groups.root(x) for x in fps}


def test_simhash_hard_rows(hard, table):
    got = simhash.components(hard).collect()
    assert len(got) == hard.count()
    zero = [r.component_id for r in got if r.doc_id in (1, 2, 3)]
    assert zero == [1, 1, 1]
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    kept = simhash.near_duplicates_removed(hard)
    assert kept.columns == hard.columns and {2, 3, 6}.isdisjoint(r.doc_id for r in kept.collect())
    assert simhash.components(table([])).count() == 0


def brute_repeats(rows):
    """Covered bytes of every document in order of ids."""
    seen, covered = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                mark[p : p + 100] = b"\x01" * 100
            seen.add(window)
        kept = bytes(c for c, m in zip(data, mark) if not m)
        spans = sum(m and (k == 0 or not mark[k - 1]) for k, m in enumerate(mark))
        covered.append((doc_id, len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return covered


def test_repeats_query(spark, folder, texts):
    got = queries.op1_suffix_array_dedup(spark, folder).collect()
    assert sorted(map(tuple, got)) == brute_repeats(sorted(texts.items()))


def test_repeats_of_random_pieces(table):
    """Few letters, pieces of many lengths, edits, and runs of one character."""
    chance = random.Random(8)
    pieces = ["".join(chance.choice("ab ") for _ in range(chance.randint(60, 400))) for _ in range(12)] + ["z" * 350, "xy" * 200]
    rows = []
    for i in range(120):
        text = "".join(
            x[chance.randint(0, 20) :] if chance.random() < 0.5 else "".join(chance.choice("abc") for _ in range(chance.randint(1, 40)))
            for x in chance.choices(pieces, k=chance.randint(1, 6))
        )
        rows.append((i, text))
    made = repeats.Repeats(table(rows))
    assert sorted(map(tuple, made.removed().collect())) == brute_repeats(rows)
    # Every occurrence is one: members of a group have equal bytes, at least two places and one first.
    groups = defaultdict(list)
    for r in made.occurrences().collect():
        groups[r.group_id].append(r)
    data = {i: t.encode() for i, t in rows}
    for members in groups.values():
        assert len({data[r.doc_id][r.start : r.start + r.size] for r in members}) == 1
        assert len({(r.doc_id, r.start) for r in members}) > 1 and any(r.is_first for r in members)
        assert all(r.size >= 100 for r in members)


def test_maximal_repeats_by_definition():
    chance = random.Random(3)
    for _ in range(200):
        gram = b"g" * repeats.GRAM
        some = {
            (bytes(chance.choices(b"ab", k=chance.randint(60, 80))), gram + bytes(chance.choices(b"ab", k=chance.randint(30, 80))))
            for _ in range(chance.randint(2, 8))
        }
        # Shared beginnings make long repeats likely.
        some = [(l[:3] + b"a" * 60, r[: 20 + chance.randint(0, 3)] + b"b" * 50) for l, r in some] + list(some)
        some = list(dict.fromkeys(some))
        got = {(l, r, tuple(sorted(m))) for l, r, m in repeats.maximal(some)}
        want = set()
        for i in range(len(some)):
            for j in range(i):
                l, r = repeats.common(some[i][0], some[j][0]), repeats.common(some[i][1], some[j][1])
                if l + r >= repeats.LENGTH:
                    want.add((l, r, tuple(
                        k for k in range(len(some)) if some[k][0][:l] == some[i][0][:l] and some[k][1][:r] == some[i][1][:r]
                    )))
        assert got == want


def test_reach_of_large_groups():
    """Variants of one text with a letter or two changed, above and below the size that is handled by arrays."""
    chance = random.Random(12)
    for n in (5, 15, 16, 40, 120):
        text = bytes(chance.choices(b"abcd", k=repeats.SIDE)) + b"g" * repeats.GRAM + bytes(chance.choices(b"abcd", k=repeats.SIDE))
        some = set()
        while len(some) < n:
            new = bytearray(text)
            for _ in range(chance.randint(1, 2)):
                at = chance.choice([*range(repeats.SIDE), *range(repeats.LENGTH, len(text))])
                new[at] = chance.choice(b"wxyz")
            begin, end = chance.choice([0, 0, 0, 30]), len(text) - chance.choice([0, 0, 0, 25])
            some.add((bytes(new[begin : repeats.SIDE][::-1]), bytes(new[repeats.SIDE : end])))
        contexts, ages = list(some), chance.sample(range(1000), n)
        want = np.zeros((2, n), int)
        for i in range(n):
            for j in range(n):
                l, r = repeats.common(contexts[i][0], contexts[j][0]), repeats.common(contexts[i][1], contexts[j][1])
                if ages[j] < ages[i] and l + r >= repeats.LENGTH:
                    want[:, i] = np.maximum(want[:, i], [l, r])
        assert np.array_equal(repeats.reach(contexts, ages), want)


def test_repeats_hard_rows(hard, table):
    got = repeats.Repeats(hard).removed().collect()
    assert len(got) == hard.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].n_removed < by_id[6].n_removed == by_id[6].n_bytes
    assert by_id[9].n_removed == 299_999  # the first letter is in no later window
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert repeats.Repeats(table([])).removed().count() == 0


def test_repeats_of_equal_ids(table):
    text = " ".join(f"w{i}" for i in range(60))
    got = Counter(r.n_removed for r in repeats.Repeats(table([(1, text), (1, text), (None, text), (None, text)])).removed().collect())
    assert got == {0: 3, len(text): 1}


def test_repeats_of_input_that_is_split_anew(spark, table):
    """The files are dealt to other partitions between making the operator's tables and reading the result."""
    chance = random.Random(4)
    passage = "".join(chance.choice("abcdefgh ") for _ in range(300))
    rows = [(i, f"{chance.getrandbits(90)} {passage}") for i in range(60)]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    made = repeats.Repeats(table(rows, files=6)).removed()
    try:
        spark.conf.set(key, "700")
        got = made.collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(map(tuple, got)) == brute_repeats(rows)


def test_spans_without_documents_raise():
    with pytest.raises(ValueError):
        repeats._complete(repeats.pa.table({"row": []}), repeats.pa.table({"block": [b"x"]}))


def planted(chance, k, text):
    letters = list(text)
    for _ in range(k):
        at, kind = chance.randrange(len(letters)), chance.randrange(3)
        if kind == 0:
            letters[at] = chance.choice("abcd ")
        elif kind == 1:
            letters.insert(at, chance.choice("abcd "))
        else:
            del letters[at]
    return "".join(letters)


def test_leaks(spark, folder, texts, table):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    got = defaultdict(set)
    for r in queries.op7_benchmark_decontamination(spark, folder).collect():
        got[r.doc_id].add(r.item_id)
    want = {d: {i for i, b in bench.items() if b in t} for d, t in texts.items()}
    assert all(items <= got[d] for d, items in want.items())
    index, chance = decontaminate.Index(list(bench.items())), random.Random(6)
    names = list(bench)
    for _ in range(60):
        n = chance.randrange(len(names))
        k = chance.randint(0, decontaminate.budget(len(bench[names[n]])))
        host = chance.choice(list(texts.values()))[:1500]
        text = host[:400] + planted(chance, k, bench[names[n]]) + host[400:]
        assert any(i == n and edits <= k for i, _, _, edits in index.leaks(text))


def test_leaks_hard_rows(spark, hard, table):
    items = [(1, "no id here at all"), (2, None), (3, ""), (None, "naïve  12x and more"), (4, "no id here"), (4, "no id here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(hard, bench).collect()
    assert [(r.doc_id, r.item_id, r.start, r.end, r.edits) for r in got] == [(None, 4, 0, 10, 0)] * 2
    assert decontaminate.leaking_removed(hard, bench).count() == hard.count() - 1
    assert decontaminate.leaks(table([]), bench).count() == 0
    assert decontaminate.leaks(hard, bench.limit(0)).count() == 0


def test_leaks_in_blocks_and_long_texts(spark, monkeypatch, table):
    chance = random.Random(9)
    text = lambda n: "".join(chance.choice("abcdefgh ") for _ in range(n))
    items = [(i, text(150)) for i in range(6)]
    long = text(2 * decontaminate.CHUNK)
    at = [100, decontaminate.CHUNK - 70, decontaminate.CHUNK + 5000]
    for place, (_, item) in zip(at, items):
        long = long[:place] + item + long[place + 150 :]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    got = decontaminate.leaks(table([(1, long)]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.start, r.item_id) for r in got) == [(a, i) for i, a in enumerate(at)]


def repeated_windows(texts, size):
    where = defaultdict(set)
    for i, t in texts.items():
        words = (t or "").encode().lower().split()
        for k in range(len(words) - size + 1):
            where[tuple(words[k : k + size])].add(i)
    return {i for ids in where.values() if len(ids) > 1 for i in ids}


def test_paragraphs(documents, texts, spark, folder):
    got = {r.doc_id: r for r in queries.op9_substring_dedup(spark, folder).collect()}
    assert repeated_windows(texts, 51) <= set(got)
    within = {
        i for i, t in texts.items()
        if max(Counter(zip(*[t.encode().lower().split()[k:] for k in range(paragraphs.WORDS)])).values(), default=0) > 1
    }
    # Nothing else is touched: each shares a paragraph's five-word shingles with another place.
    for i in set(got) - repeated_windows(texts, paragraphs.WORDS) - within:
        assert i in repeated_windows(texts, 20)
    after = {r.doc_id: r.text for r in paragraphs.duplicates_removed(documents).collect()}
    assert set(after) == set(texts) and not repeated_windows(after, 51)
    assert all(after[i] == t for i, t in texts.items() if i not in got)


def test_similar_is_exact():
    chance = random.Random(7)
    base = [f"w{i}" for i in range(24)]
    words = [" ".join(base)]
    for _ in range(60):
        new = chance.choice(words).split()
        new[chance.choice([0, 1, 22, 23, chance.randrange(24)])] = f"x{chance.randrange(40)}"
        words.append(" ".join(new))
    sets = [{tuple(w.split()[i : i + 5]) for i in range(20)} for w in words]
    want, got = Groups(), Groups()
    for i in range(len(words)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                want.join(i, j)
    for a, b in paragraphs.similar(list(range(len(words))), words):
        got.join(a, b)
    assert [got.root(i) for i in range(len(words))] == [want.root(i) for i in range(len(words))]


@pytest.mark.parametrize("block", [2048, 7])
def test_links_of_a_hot_band(spark, monkeypatch, block):
    """Many different paragraphs in one band: no task compares more than two blocks, and no link is lost."""
    monkeypatch.setattr(paragraphs, "BLOCK", block * paragraphs.WORDS)
    chance = random.Random(17)
    texts_ = []
    for n in range(40):
        base = [f"w{n}x{k}" for k in range(24)]
        texts_ += [" ".join(base), " ".join([*base[:-1], "end"]), " ".join(["begin", *base[1:]])]
    chance.shuffle(texts_)
    rows = [(n, 24, t, [5]) for n, t in enumerate(texts_)]
    found = written(spark.createDataFrame(rows, "content long, size int, words string, bands array<bigint>"), "hot")
    groups, similar = Groups(), paragraphs.similar

    def bounded(contents, words):
        # Blocks are dealt by hash: a pair of them is at most a few times its expected size.
        assert len(contents) <= max(64, 4 * block) if block < 100 else True
        return similar(contents, words)

    monkeypatch.setattr(paragraphs, "similar", bounded)
    for r in paragraphs.links(found).collect():
        groups.join(r.a, r.b)
    names = defaultdict(set)
    for n, t in enumerate(texts_):
        names[groups.root(n)].add(t.split()[5].split("x")[0])
    assert len(names) == 40 and all(len(x) == 1 for x in names.values())


def test_paragraphs_hard_rows(hard, table):
    assert paragraphs.bands(0.8, 0.99) == 3
    made = paragraphs.duplicates_removed(hard)
    assert made.columns == hard.columns and made.count() == hard.count()
    before, after = ({(r.doc_id, r.text) for r in x.collect()} for x in (hard, made))
    assert {x for x in before if x[0] not in (5, 6, 9)} <= after
    # Words between two paragraphs stay.
    assert len(next(t for i, t in after if i == 6)) < 0.1 * len(next(t for i, t in before if i == 6))
    assert paragraphs.by_document(table([])).count() == 0


def test_stages_pass_all_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, docs, folder), name)
        assert kept.schema.names == docs.schema.names and 0 < kept.count() <= docs.count()
        assert kept.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        docs = kept
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_whole_passages_go(table):
    """Of planted passages among different texts only the first copy stays, up to their ends, also where the first
    document holds less of a passage than the second. A paragraph that goes two words past the end of a passage is a
    near copy and goes with these words, and so does one that is a near copy of that."""
    chance = random.Random(21)
    words = lambda n: [f"w{chance.getrandbits(40)}" for _ in range(n)]
    rows, stays, beside = [], {}, {}
    for size in [51, 60, 80, 120] * 10:
        passage = words(size)
        for k in range(3):
            held = passage[: size - 9] if k == 0 and size == 80 else passage
            a, b = words(chance.randint(0, 40)), words(chance.randint(0, 40))
            stays[len(rows)] = held if k == 0 else passage[size - 9 :] if size == 80 and k == 1 else []
            beside[len(rows)] = a, b
            rows.append((len(rows), "  ".join([*a, *held, *b])))
    got = {r.doc_id: r.text.split() for r in paragraphs.duplicates_removed(table(rows)).collect()}
    for i, (a, b) in beside.items():
        own = {*a, *b}
        assert set(stays[i]) == {*got[i]} - own or i % 3 == 1 and set(stays[i]) >= {*got[i]} - own
        assert {*a[:-6], *b[6:]} <= {*got[i]}


def test_near_copies_of_marked_paragraphs_are_found(table):
    """Of paragraphs with scattered changed words that still are 0.8 alike as a whole, nine in ten go."""
    chance = random.Random(31)
    words = lambda n: [f"w{chance.getrandbits(40)}" for _ in range(n)]
    grams = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    rows, edited = [], {}
    for size, changes in [(60, 1), (100, 2), (200, 4), (200, 1)] * 40:
        first = words(size)
        second = list(first)
        for k in chance.sample(range(size), changes):
            second[k] = f"new{chance.getrandbits(40)}"
        for text in (first, second):
            rows.append((len(rows), "\n".join(" ".join(x) for x in (words(chance.randint(0, 30)), text, words(chance.randint(0, 30))))))
        edited[len(rows) - 1] = first, second
    got = {r.doc_id: r.text for r in paragraphs.duplicates_removed(table(rows)).collect()}
    alike = gone = 0
    for i, (first, second) in edited.items():
        a, b = grams(first), grams(second)
        if len(a & b) >= 0.8 * len(a | b):
            alike += 1
            gone += not set(second) & set(got[i].split())
        # The first copy stays, and the lines around but for words of a piece that is a near copy itself.
        assert got[i - 1] == rows[i - 1][1]
        before, _, after = (x.split() for x in rows[i][1].split("\n"))
        assert {*before[:-6], *after[6:]} <= set(got[i].split())
    assert alike > 80 and gone >= 0.9 * alike


def test_chunks_equal_texts_one_by_one(monkeypatch):
    """Words, lines, pieces, bands and contents of joined texts are those of each text, by plain loops."""
    chance = random.Random(5)
    texts_ = [
        "\n".join(" ".join(chance.choice(["Wörd", f"w{chance.randrange(60)}", "x" * 5000]) for _ in range(n)) for n in sizes)
        for sizes in [(3, 24, 0, 40, 23, 100, 24), (), (30,), (23,), (24, 24), (200,), (60, 2), (28,), (35,)]
    ]
    raw = [t.encode() for t in texts_]
    monkeypatch.setattr(paragraphs, "CHUNK", 1 << 20)
    found = paragraphs._Chunk(raw)
    begin, stop, start, end, content = found.told(np.arange(len(found.row)))
    at = defaultdict(set)
    for k in range(len(found.row)):
        text, (a, n) = texts_[found.row[k]], (int(found.first[k]), int(found.size[k]))
        words = text.split()[a : a + n]
        assert text[start[k] : end[k]].split() == words and raw[found.row[k]][begin[k] : stop[k]].decode().split() == words
        at[found.row[k], k < found.pieces].add((a, n))
        alone = paragraphs._Chunk([" ".join(words).lower().encode()])
        mine = next(j for j in range(len(alone.row)) if (alone.size[j] == n and alone.first[j] == 0 and (j < alone.pieces) == (k < found.pieces)))
        assert (alone.keys[:, mine] == found.keys[:, k]).all()
        assert alone.told(np.array([mine]))[4][0] == content[k]
    for row, text in enumerate(texts_):
        lines, here = set(), 0
        for line in text.split("\n"):
            if len(line.split()) >= 24:
                lines.add((here, len(line.split())))
            here += len(line.split())
        assert at[row, False] == lines
        own = paragraphs.shingles(paragraphs.word_hashes(*split_up(raw[row].lower())))
        pieces = {0} if 20 <= len(own) < 28 else {
            w + min(range(28), key=lambda k: (int(own[w + k]) >> 24, k)) for w in range(len(own) - 27)
        }
        assert at[row, True] == {(p, 24) for p in pieces if p + 20 <= len(own)}


def split_up(text):
    data, first, last = np.frombuffer(text, np.uint8), [], []
    here = 0
    for word in text.split():
        here = text.index(word, here)
        first.append(here)
        here += len(word)
        last.append(here)
    return data, np.array(first, np.int64), np.array(last, np.int64)


def test_word_hashes_tell_words_apart():
    words_ = [b"a", b"b", b"ab", b"ba", b"aa", b"a\x00", b"\x00a", b"\x00", b"x" * 4096, b"x" * 4097, b"x" * 9000, "é".encode()]
    text = b" ".join(words_ * 3)
    got = paragraphs.word_hashes(*split_up(text)).tolist()
    assert got[: len(words_)] == got[len(words_) : 2 * len(words_)] == got[2 * len(words_) :]
    assert len(set(got)) == len(words_)
    # The same in any chunk.
    far = b"y " * 700_000 + text
    assert paragraphs.word_hashes(*split_up_fast(far)).tolist()[-len(words_) :] == got[: len(words_)]


def split_up_fast(text):
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    return data, np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])


def test_shared_reach_equals_comparing_all_pairs():
    chance = np.random.default_rng(6)
    words = chance.integers(0, 3, (60, 7)).astype(np.uint64)
    sizes = chance.integers(0, 8, 60)
    got = paragraphs.shared_reach(words, sizes)
    for i in range(60):
        best = 0
        for j in range(i):
            n = 0
            while n < min(sizes[i], sizes[j]) and words[i, n] == words[j, n]:
                n += 1
            best = max(best, n)
        assert got[i] == best


def test_paragraphs_of_documents_with_text_ids(table):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [("b", f"own x\n{passage}"), ("a", f"{passage}\nother y"), (None, passage), ("c", None)]
    docs = table(rows, "doc_id string, text string")
    assert {(r.doc_id, r.component_id, r.n_removed > 0) for r in paragraphs.by_document(docs).collect()} == {("a", "a", False), ("b", "a", True)}
    got = {r.doc_id: r.text for r in paragraphs.duplicates_removed(docs).collect()}
    assert got == {"a": rows[1][1], "b": "own x\n", None: passage, "c": None}
    empty = table([], "doc_id string, text string")
    assert paragraphs.duplicates_removed(empty).count() == 0 and paragraphs.duplicates_removed(empty).schema == empty.schema


def test_stages_on_hard_and_empty_tables(spark, folder, table):
    """Every stage handles nulls, empty, long and repeated rows, and tables without rows."""
    long = " ".join(f"word{i % 700} text{i % 31}" for i in range(20_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (None, "no id here", None, "b", 9),
        (None, None, None, None, None), (5, long, "de", "a", 1), (6, long, "de", "a", 1), (7, "same same", "en", "c", 1),
        (7, "same same", "en", "c", 1), (7, "other text", "fr", "c", 1), (9, "a" * 300_000, "en", "d", 2),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (table(rows, schema), table([], schema)):
        size = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, folder), name)
            assert docs.schema.names == schema.replace(" long", "").replace(" string", "").split(", ")
            assert docs.count() <= size
        last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert last.count() == docs.count() and (size == 0 or docs.count() >= 6)


def test_words_beside_pieces_equal_plain_loops(monkeypatch):
    """Chunks of texts, white space of all kinds, other scripts, and sides that end with the text."""
    monkeypatch.setattr(paragraphs, "CHUNK", 500)
    chance = random.Random(12)
    words = ["Ab", "c", "\u00e9t\u00e9", "\u4e2d\u6587", "D.", "x" * 30]
    texts = [
        "".join(chance.choice(words) + chance.choice([" ", "  ", "\n", "\t \r\n", "\x0b"]) for _ in range(n)).encode()
        for n in (24, 25, 50, 51, 52, 200, 30, 90)
    ]
    asked = [(r, f, s) for r, t in enumerate(texts) for f in range(len(t.split()) - paragraphs.WORDS + 1) for s in (0, 1)]
    chance.shuffle(asked)
    row, first, side = (np.array(x) for x in zip(*asked))
    found = paragraphs._beside(texts, row, first, side == 1)
    equal = defaultdict(set)
    for k, (r, f, s) in enumerate(asked):
        spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", texts[r])]
        a, b = (f + paragraphs.WORDS, f + paragraphs.WORDS + paragraphs.SIDE) if s else (max(0, f - paragraphs.SIDE), f)
        beside = [texts[r][x:y].lower() for x, y in spans[a:b]]
        assert found["count"][k] == len(beside)
        if beside:
            begin, stop = (spans[a - 1][1], spans[min(b, len(spans)) - 1][1]) if s else (spans[a][0], spans[b][0])
            assert (found["begin"][k], found["stop"][k]) == (begin, stop)
            assert found["letters"][k] == len(texts[r][begin:stop].decode())
            equal[tuple(beside)].add(found["said"][k])
            equal[beside[0 if s else -1], "near"].add(found["near"][k])
    assert all(len(v) == 1 for v in equal.values())
    assert len({*map(min, equal.values())}) == len(equal)


def test_plain_words():
    for text in (b"A b", b"A\tb\xc3\x89", b"a  B\r\nc", b"a\x0b\x0cB"):
        assert paragraphs._plain(text) == b" ".join(text.lower().split())
