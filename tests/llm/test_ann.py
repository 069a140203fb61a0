"""Nearest neighbours against an exhaustive search."""

from __future__ import annotations

import math

import numpy as np
import pytest

from cellpulse.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>"


def clustered(seed: int, n: int, dim: int, unit: bool) -> np.ndarray:
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(12, dim))
    found = centres[chance.integers(0, 12, n)] + chance.normal(size=(n, dim)) * 0.6
    return (found / np.linalg.norm(found, axis=1, keepdims=True) if unit else found * chance.exponential(2, (n, 1))).astype(np.float32)


def exhaustive(vectors: dict, wanted: list, k: int) -> dict:
    """Best ids for each wanted id, ties to the smaller one."""
    found = {}
    for q in wanted:
        scores = sorted((-float(np.dot(v.astype(float), vectors[q].astype(float))), i) for i, v in vectors.items() if i != q)
        found[q] = [(i, -s) for s, i in scores[:k]]
    return found


def answers(rows) -> dict:
    found: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("unit", [True, False])
def test_recall_against_an_exhaustive_search(spark, table, monkeypatch, unit):
    # Several shards, each wider than the beam.
    monkeypatch.setattr(ann, "SHARD_ROWS", 1000)
    found = clustered(1, 3000, 24, unit)
    vectors = dict(enumerate(found))
    stored = table([(i, v.tolist()) for i, v in vectors.items()], SCHEMA)
    index = ann.indexed(stored)
    assert index.count() >= 3 and all(len(r.ids) for r in index.collect())
    made = answers(ann.searched(index, stored.filter("vec_id % 20 = 0")).collect())
    exact = exhaustive(vectors, list(range(0, 3000, 20)), 20)
    assert set(made) == set(exact)
    hits = sum(len({i for i, _ in made[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits >= 0.95 * 20 * len(exact)
    for q, rows in made.items():
        assert len(rows) == 20 and rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        np.testing.assert_allclose([s for _, s in rows], [np.dot(vectors[i].astype(float), vectors[q].astype(float)) for i, _ in rows])


def test_everything_is_found_in_small_tables_whatever_the_norms(table):
    """Copies, ties, norms over many powers of two, ids that repeat: as an exhaustive search finds them."""
    chance = np.random.default_rng(3)
    rows = [(i, (chance.integers(-2, 3, 3) * 2.0 ** chance.integers(-60, 60)).tolist()) for i in range(90)]
    rows += [(i, [1.0, 2.0, 3.0]) for i in range(100, 140)]
    rows += [(100, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (None, [0.5, 0.5, 0.5])]
    rows += [(7, None), (8, []), (9, [0.0, 0.0, 0.0]), (11, [1.0, None, 2.0]), (20, [float("nan"), 1.0, 1.0]), (40, [1.0, float("inf"), 0.0])]
    rows += [(200, [1.0, 1.0]), (201, [2.0, 1.0])]
    made = {}
    for r in ann.searched(ann.indexed(table(rows, SCHEMA)), table(rows, SCHEMA), k=30).collect():
        made.setdefault((r.query_id, r.vec_id, r.score), 0)
        made[r.query_id, r.vec_id, r.score] += 1
    assert set(made.values()) == {1}
    usable = {(i, tuple(np.float32(x) for x in v)) for i, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)}
    expected = set()
    for q, v in usable:
        if q is None:
            continue
        others = sorted(
            (-sum(float(a) * float(b) for a, b in zip(v, w)), i is None, i or 0)
            for i, w in usable if i != q and len(w) == len(v)
        )
        expected |= {(q, None if none else i, -s) for s, none, i in others[:30]}
    assert set(made) == expected


def test_hot_vector_is_one_node(table):
    rows = [(i, [1.0, 0.5]) for i in range(400)] + [(i, [math.cos(i), math.sin(i)]) for i in range(400, 600)]
    index = ann.indexed(table(rows, SCHEMA))
    assert sum(len(r.ends) // 8 for r in index.collect()) == 201
    made = answers(ann.searched(index, table([(40, [1.0, 0.5]), (999, [1.0, 0.5])], SCHEMA), k=3).collect())
    assert [i for i, _ in made[40]] == [0, 1, 2] and [i for i, _ in made[999]] == [0, 1, 2]


def test_every_node_is_reachable():
    chance = np.random.default_rng(5)
    # Tight groups far apart: their members only list each other.
    vectors = np.repeat(np.eye(40), 30, axis=0) + chance.normal(size=(1200, 40)) * 1e-3
    graph = ann.Graph(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    reached = np.zeros(1200, bool)
    graph._reached(reached, np.zeros(1, int))
    assert reached.all()
    found = graph.search(graph.nodes[:50], 1200)
    assert all(len(set(r.tolist())) == 1200 for r in found)


def test_empty_tables_and_extra_columns(spark, table):
    empty = table([], SCHEMA)
    assert ann.indexed(empty).count() == 0
    some = table([(1, [1.0]), (2, [2.0])], SCHEMA).selectExpr("*", "1 as id", "'x' as v", "3 as dim", "4 as bucket", "5 as query")
    assert ann.searched(ann.indexed(empty), some).count() == ann.searched(ann.indexed(some), empty).count() == 0
    assert answers(ann.searched(ann.indexed(some), some).collect()) == {1: [(2, 2.0)], 2: [(1, 2.0)]}


def test_registered_query_finds_nine_tenths(spark):
    """Over the given 2,000 vectors."""
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: np.array(r.embedding, np.float32) for r in rows}
    made = queries.op13_nearest_neighbours(spark, folder)
    assert dict(made.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    made, exact = answers(made.collect()), exhaustive(vectors, [i for i in vectors if i % 20 == 0], 20)
    hits = sum(len({i for i, _ in made[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert set(made) == set(exact) and hits >= 0.9 * 20 * len(exact)
