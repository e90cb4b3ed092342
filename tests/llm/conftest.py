"""Documents that try every operator: nulls, empties, long texts, ties, repeats, odd characters, clashing columns."""

from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ("mark", "fp", "rank", "count", "n", "kept", "tag", "mini", "group", "side_doc_id", "component_id", "w")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(1, 9))) for _ in range(400)]
    return " ".join(r.choice(words) + r.choice(["", "", ".", ",", "\n"]) for _ in range(n)).strip()


@pytest.fixture(scope="session")
def odd_rows():
    shared = prose(1, 60)
    texts = [
        None, "", "   \n\t ", "word", "two words", "Ünïcode ß 漢字 — …  double  spaces\n\n  and lines   x y", "a\x00b nul",
        "<|endoftext|> 12 345's it's", "1234 56 !!", shared, shared, "Head one. " + shared, shared + " tail two.",
        prose(2, 5000), "same " * 300, "All Rights Reserved. CC-BY all rights reserved", prose(3, 120),
        prose(3, 120).upper(), "Released under the MIT License.", "line\n" * 40, "x" * 3000,
    ]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[9], rows[13], (3, "another text under a known id " + shared, "en", "s", 9), (None, shared, "en", None, 1)]
    return rows


@pytest.fixture()
def odd(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3, "n_chars")
    return df.select("*", *(F.lit(7).alias(c) for c in EXTRA))


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
