from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table(spark, tmp_path_factory):
    """Stores rows as a Parquet table of a few files, as the operators that read twice expect."""

    def make(rows, schema="doc_id long, text string", files=3):
        path = str(tmp_path_factory.mktemp("table") / "rows.parquet")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def hard(table):
    """Null ids and texts, empty, white, very long and repeated rows, and extra columns with clashing names."""
    long = " ".join(f"word{i % 700} text{i % 31}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (4, "one"), (5, long), (6, long),
        (7, "same same"), (7, "same same"), (7, "other text"), (8, "'s it's　 naïve\x1c 12x\r\n\n  end "),
        (9, "a" * 300_000), (10, "<|endoftext|> </s>[INST]"), (11, "x\x00y"),
    ]
    schema = "doc_id long, text string, n_tokens int, block string, component_id int, cuts int, score double, root int, fp int"
    return table([(*r, 5, "b", 6, 7, 0.5, 8, 9) for r in rows], schema)
