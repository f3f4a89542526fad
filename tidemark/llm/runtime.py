"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: By application, the folder of a session that has none; the setting itself cannot be changed once Spark runs.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or one of our own where that is unset and all runs in this process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tidemark-")
        _own[spark.sparkContext.applicationId] = base
    return base.rstrip("/")


def store(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, mb: int = 16) -> None:
    """Bounds the bytes of one Arrow batch, so that long texts do not add up to more than a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def held(docs: DataFrame) -> DataFrame:
    """docs' rows as one column `held`, so that names of its columns cannot clash with those that an operator adds."""
    return docs.select(F.struct("*").alias("held"))


def released(rows: DataFrame, docs: DataFrame, *added) -> DataFrame:
    """held() undone, with columns added; a column of docs with the name of an added one gives way to it."""
    names = set(rows.select(*added).columns)
    return rows.select(*[F.col("held").getField(c).alias(c) for c in docs.columns if c not in names], *added)


def row_key(text: str = "text"):
    """Tells apart rows that repeat a doc_id with another text."""
    return F.xxhash64(F.col(text))


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of arrays of `size` doubles that tasks hold in slices: (part, salt, payload). Two levels, so that no task gets more than about the root of all."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(len(group["payload"][0].as_py()) // 8)
        for x in group["payload"]:
            total += np.frombuffer(x.as_py())
        return pa.table({"part": group["part"][:1], "salt": pa.array([0], pa.int32()), "payload": pa.array([total.tobytes()], pa.binary())})

    rows = parts.groupBy("part", "salt").applyInArrow(add, SLICE).groupBy("part").applyInArrow(add, SLICE).orderBy("part").collect()
    return np.concatenate([np.frombuffer(r["payload"]) for r in rows]) if rows else np.zeros(size)


SLICE = "part int, salt int, payload binary"


def slices(total: np.ndarray, salts: int, number: int = 16) -> pa.RecordBatch:
    """A task's array as rows for summed()."""
    from pyspark import TaskContext

    flat = np.array_split(total.astype(np.float64).ravel(), number)
    salt = TaskContext.get().partitionId() % salts
    return pa.RecordBatch.from_arrays([pa.array(range(number), pa.int32()), pa.array([salt] * number, pa.int32()), pa.array([x.tobytes() for x in flat], pa.binary())], names=["part", "salt", "payload"])


def salts_of(df: DataFrame) -> int:
    return max(1, math.isqrt(df.rdd.getNumPartitions()))
