"""Small files in whatever file system Spark can reach, and digests of large ones by its executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{name}/{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to a shared folder of its own and read back, for what is read several times."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    found = spark.read.option("wholetext", True).text(path).first()
    return "" if found is None else found[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the path and renames over it, so that a reader sees the old text or the new one."""
    fs, fresh = _at(spark, f"{path}.new")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    choice = gateway.new_array(options, 1)
    choice[0] = options.valueOf("OVERWRITE")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), fs.makeQualified(_at(spark, path)[1]), choice)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def digests(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(path below the folder, bytes, sha256) of files, read and hashed where the tasks are."""
    fs, p = _at(spark, folder)
    base = fs.makeQualified(p).toString().rstrip("/") + "/"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    except AnalysisException:
        return spark.createDataFrame([], "path string, bytes long, sha256 string")
    bare = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    name = F.substr(bare(F.col("path")), F.length(bare(F.lit(base))) + 1)
    return files.select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
