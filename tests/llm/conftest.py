"""Small document tables with every odd case."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, key long, comp int, shard string, token string"


def odd_rows() -> list[tuple]:
    words = [f"Wort{i}" for i in range(40)]
    texts = [
        None, "", " ", " \n\t ", "a", "A", "The quick brown fox jumps over the lazy dog.", "the  quick\tbrown fox\njumps over the lazy dog.",
        "x" * 30_000, " ".join(words * 500), "naïve café £5 — 日本語 テスト 🙂🙂", "1234 5678", "Don't x.'s  $'s  end \n\n", "﻿é é", "<|endoftext|> inside",
        "The quick brown fox jumps over the lazy dog.",
    ]
    rows = [(i, t, "en" if i % 3 else None, "s", 1, "n", 2, 3, "q", "t") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "a", None, None, None, None, None, None, None, None), (None, None, "en", None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
