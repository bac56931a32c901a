"""What the operators of this subpackage share: reading a given table, and cutting lineage."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ROWS_AT_ONCE = 2048  # held as Python objects, with what is made of them


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; whatever else it holds is not read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def ready_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder the cluster names. Only a local session without one gets a
    temporary folder: it has no other machine that would have to see it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        shared = tempfile.mkdtemp(prefix="tablesnap-")
    sc.setCheckpointDir(shared)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept where losing an executor does not lose them. The shuffle files they were
    computed through go at once; else they stay on disk until the driver's garbage is collected."""
    spark = df.sparkSession
    ready_checkpoints(spark)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        # Spark asks the setting when a plan is made, and only for some operations; a filter is one of them.
        return df.where(F.lit(True)).checkpoint()
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def sparse(rows: DataFrame, mark: Column, wanted: int, total: int) -> DataFrame:
    """About twice ``wanted`` of ``total`` rows, those whose hash ``mark`` falls under a threshold; all if there
    are no more. What each partition keeps shrinks as their number grows, so the sum stays bounded."""
    share = min(1.0, 2 * wanted / max(total, 1))
    return rows.where(F.pmod(mark, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))


def parallelism(spark: SparkSession) -> int:
    """The number of partitions that the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, whatever folder they start in."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def small_batches(spark: SparkSession) -> None:
    """Texts can be long, so fewer rows than by default go to a Python worker at a time; both the worker and
    the JVM hold a batch outside of Spark's own memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_AT_ONCE:
        spark.conf.set(name, str(ROWS_AT_ONCE))


def map_rows(
    df: DataFrame, rows: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]], schema: str
) -> DataFrame:
    """``rows`` turns column lists into column lists, some rows at a time, within each partition."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    importable(df.sparkSession)
    small_batches(df.sparkSession)
    spark_schema = df.sparkSession.createDataFrame([], schema).schema if not isinstance(schema, StructType) else schema
    arrow = to_arrow_schema(spark_schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE))
        lists = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns, strict=True)} for b in parts)
        for out in rows(lists):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        # Workers are used again; what this partition needed must not stay with them.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(work, spark_schema)


SALTS = 8  # tasks that the rows of one key are dealt to


def salted(
    rows: DataFrame, facts: DataFrame, keys: str | Sequence[str], of: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Rows joined with what is told about their ``keys``, once for each. Rows that share their keys are dealt by
    ``of``, so a frequent key is not one task's work; null keys meet nothing."""
    keys, of = ([c] if isinstance(c, str) else list(c) for c in (keys, of))
    salt = F.pmod(F.xxhash64(*of), F.lit(SALTS)).cast("int")
    every = facts.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return rows.withColumn("salt", salt).join(every, [*keys, "salt"], how).drop("salt")
