"""A training-data pipeline over ``documents``: five stages, each on all that the one before it kept.

Language identification drops what it rejects, one document of each near-duplicate group is kept, repeated
passages are cut out of the texts, secrets are replaced, and what is left is packed into token sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm import language, near, packing, repeats, secret_scan
from tablesnap.llm.common import map_rows, ready_checkpoints

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PASSAGE_WORDS = 50  # many passages of so many words have fewer than 400 bytes

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number each. They are read from files, so the numbers are the same every time."""
    return docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not recognised with enough confidence, null texts and texts without a
    letter among them. Learns from all languages that the documents are marked with."""
    model = language.train_on(docs.select(F.col("doc_id").alias("key"), "text", "lang"))

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            kept = [not model.predict(t)[2] for t in batch["text"]]
            yield {n: [v for v, k in zip(batch[n], kept, strict=True) if k] for n in COLUMNS}

    docs = docs.select(*COLUMNS)
    return map_rows(docs, work, docs.schema)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents of a near-duplicate group the first by ``doc_id`` stays. Of repeated or null ids in a group
    one row stays. Documents whose SimHashes differ in two bits at most, found as the operator finds them, and further
    ones that share a MinHash band link if the Jaccard similarity of their five-word shingles is 0.8 or more: SimHashes
    of such pairs are often too far apart for the operator's cells."""
    rows = numbered(docs)
    found = near.near_duplicates(rows.select(F.struct("doc_id", "row").alias("at"), "row", "text"))
    kept = found.where(F.col("at").eqNullSafe(F.col("component"))).select(F.col("at.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage of 400 bytes or more, or of ``PASSAGE_WORDS`` words or more, that occurs elsewhere out of
    all texts; a letter that is cut in two goes. Documents of which nothing remains go, too."""
    rows = numbered(docs)
    changed = repeats.without_repeats(rows, "row", "text", as_text=True, words=PASSAGE_WORDS)
    changed = changed.where("n_removed > 0").select("row", "kept")
    # Documents that certainly have no repeat pass without being moved.
    split = repeats.marked(rows, changed, ["row"])
    joined = split.where("maybe").join(changed, "row", "left").where("kept IS NULL OR trim(kept) <> ''")
    new = {"text": F.coalesce("kept", "text"), "n_chars": F.coalesce(F.length("kept").cast("long"), "n_chars")}
    return joined.withColumns(new).select(*COLUMNS).unionByName(split.where("NOT maybe").select(*COLUMNS))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of every secret that the patterns or the field find."""
    field = secret_scan.train_on(docs.select(F.col("doc_id").alias("key"), "text"))

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = [
                t and secret_scan.redacted(t, secret_scan.all_spans(field, t)[1]) for t in batch["text"]
            ]
            sizes = [None if t is None else len(t) for t in texts]
            yield batch | {"text": texts, "n_chars": sizes}

    docs = docs.select(*COLUMNS)
    return map_rows(docs, work, docs.schema)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all texts into sequences of 1024 tokens, one row per piece."""
    import public_tokenizers

    return packing.pack_texts(
        docs,
        "doc_id",
        "text",
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("suffix-array dedup", drop_repeated_passages),
    ("secret scans", replace_secrets),
    ("best-fit packing", pack_sequences),
]

# Models, fingerprints of word hashes and byte-wise repeats are beyond SQL; tests compare the stages with plain
# versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet, in the shared folder, and read
    again as the next one's documents."""
    ready_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
