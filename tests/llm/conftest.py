from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, row string, key long, size long, id long, n long, block long, shards string, score string, nodes long"
PROSE = "the cat sat on the mat and looked at the moon while rain fell on every roof of the old town. nobody was there to see it."


@pytest.fixture
def edge(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and extra columns named like inner ones."""
    extra = ("x", 1, 2, 3, 4, 5, "s", "t", 6)
    rows = [
        (None, PROSE, "en", "a"), (1, None, "en", "a"), (2, "", None, "b"), (3, " \t\n\x0b ", "en", None), (4, PROSE, "en", "a"),
        (4, PROSE, "en", "a"), (5, PROSE * 3000, "en", "b"), (6, "Ünïcödé 漢字   　 x", None, None), (7, "one", "en", "c"),
    ]
    return spark.createDataFrame([r + extra for r in rows], SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
