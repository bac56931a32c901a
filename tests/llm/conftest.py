"""A small corpus with every awkward case, and the same tables without a row."""

import random

import pytest
from pyspark.sql import functions as F

LANGUAGES = {
    "en": "the house that stands by the river was built for the old people of the town and with care".split(),
    "fr": "la maison qui se trouve dans la ville est une grande maison pour les gens avec des enfants".split(),
}


def prose(seed, words, lang="en"):
    draw = random.Random(seed)
    return " ".join(draw.choice(LANGUAGES[lang]) + draw.choice(["", "ly", "ed", "er", "."]) for _ in range(words))


PASSAGE = prose(1000, 90)
SECRET = 'token = "0123456789abcdef0123456789abcdef01234567"'


def rows():
    long = prose(7, 6000)
    found = [(i, prose(i, 20 + 9 * i, "fr" if i % 3 else "en"), "fr" if i % 3 else "en") for i in range(40)]
    found += [(100 + i, f"{prose(50 + i, 30)}\n{PASSAGE}\n{prose(90 + i, 25)}", "en") for i in range(6)]
    found += [(200 + i, found[9][1], "fr") for i in range(5)]  # copies
    found += [(206, found[20][1] + " one", "fr"), (207, found[30][1].upper(), "fr")]
    found += [(300, f"Our {SECRET} is here, and AKIA{'Q1' * 8} too.", "en"), (301, "API_KEY: 'shortone'", "en")]
    found += [(302, "passwd=" + "x" * 40 + " <|endoftext|> x", None), (303, long, "en"), (304, long[:9000] + " new end", "en")]
    found += [(400, None, "en"), (401, "", "en"), (402, " \n\t ", None), (403, "123 456 !!", "en"), (404, "日本語のテキスト😀 é́", None)]
    found += [(405, "ab" * 3000, "en"), (406, "one", "en"), (407, "a  b   c\n \n  d ", "en"), (408, "İstanbul ſecret KEY", None)]
    found += [(9, found[9][1], "fr"), (9, "another text for the id nine", "en"), (None, "no id at all here", "en"), (None, None, None)]
    return found


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    """Folder of the awkward corpus. The extra columns have names that operators use inside."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, lang string")
    docs = docs.select(
        "doc_id", "text", "lang", F.lit("src0").alias("source"), F.length("text").cast("long").alias("n_chars"),
        *[F.lit(7).alias(n) for n in ("row", "key", "piece", "fp", "spans", "maybe", "score", "sequence_id")],
    )
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(40)] + [(9, None, 0), (None, 1, 0), (777, 1, 0), (3, 0, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in {
        "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
        "labels": "doc_id bigint, quality int, toxic int",
        "pages": "page_id bigint, url string, html string",
        "embeddings": "vec_id bigint, embedding array<float>, label int",
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="session")
def texts():
    """The rows of the corpus as (doc_id, text)."""
    return [(i, t) for i, t, _ in rows()]
