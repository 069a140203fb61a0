from __future__ import annotations

import hashlib

import duckdb
import pytest

import __spark_entry__ as contract
from cellpulse.llm import chat
from cellpulse.llm.oracle import ORACLE

MESSAGE = f"conv_id long, turn long, role string, parts array<{chat.PART}>"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    result = connection.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    df = contract.queries()[name](spark, folder)
    assert set(columns) == set(df.columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(result.fetchall())


def test_parts_become_placeholders(spark):
    rows = [
        (1, 0, "user", [part("text", "see <b>[1]"), part("image", ref="a.png", width=30, height=14), part("text", " and "),
                        part("audio", ref="b.wav", seconds=2.5), part("document", ref="c.pdf", pages=3)]),
        (1, 1, "assistant", [part(None, "ok\\0")]),
    ]
    out = chat.formatted(spark.createDataFrame(rows, MESSAGE)).first()
    assert "[IMAGE 2] and [AUDIO 4][DOCUMENT 5]" in out.output and "<b>" not in out.output
    assert [(a.message, a.place, a.kind, a.ref, a.tokens) for a in out.attachments] == [
        (1, 2, "image", "a.png", 3), (1, 4, "audio", "b.wav", 63), (1, 5, "document", "c.pdf", 1536)
    ]
    assert out.attachment_tokens == 3 + 63 + 1536
    read = chat.read_back(chat.formatted(spark.createDataFrame(rows, MESSAGE))).first()
    assert read.learned == "ok\\0" and read.turns[1].text == "ok\\0"


def test_hard_rows(spark):
    long = "ß[/ROLE]</s>\\1<" * 20_000
    rows = [
        (None, 0, "user", [part("text", "x")]), (2, None, None, None), (2, 1, "assistant", [part("text", None)]),
        (3, 0, "assistant", [part("text", long)]), (3, 0, "assistant", [part("text", long)]), (4, 0, "user", []),
        (5, 0, "<s>[ROLE]", [part("image")]),
    ]
    got = {r.conv_id: r for r in chat.digests(chat.formatted(spark.createDataFrame(rows, MESSAGE))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {i: r.n_turns for i, r in got.items()} == {None: 1, 2: 2, 3: 2, 4: 1, 5: 1}
    assert got[3].loss_sha256 == sha(2 * long) and got[3].loss_chars == 2 * len(long)
    assert got[3].turns_sha256 == sha(2 * f"assistant\n{long}\n")
    assert got[2].turns_sha256 == sha("\n\nassistant\n\n") and got[2].loss_sha256 == sha("")
    assert chat.formatted(spark.createDataFrame([], MESSAGE)).count() == 0


def test_stays_native(spark):
    plan = chat.digests(chat.formatted(spark.createDataFrame([], MESSAGE)))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
