"""Written tables in the cluster's shared folder, and atomic steps on its file system."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of its own only in local mode without that setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corvidex-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, label: str, most_rows_in_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that lineage ends there. The files go with the session."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corvidex/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", most_rows_in_file).parquet(path)
    file_system, at = hadoop(spark, path)
    file_system.deleteOnExit(at)
    found = spark.read.schema(df.schema).parquet(path)
    found._written_to = path
    return found


def hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and its name there; any one that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    file_system, at = hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in file_system.listStatus(at)) if file_system.exists(at) else []


def n_bytes(spark: SparkSession, path: str) -> int:
    file_system, at = hadoop(spark, path)
    return file_system.getContentSummary(at).getLength()


def remove(spark: SparkSession, path: str) -> None:
    file_system, at = hadoop(spark, path)
    file_system.delete(at, True)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch."""
    file_system, at = hadoop(spark, path)
    return file_system.getFileStatus(at).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    file_system, at = hadoop(spark, path)
    stream = file_system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file_system, at = hadoop(spark, path)
    out = file_system.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish(spark: SparkSession, draft: str, final: str) -> bool:
    """Rename ``draft`` to ``final`` unless something has that name: of several writers one succeeds."""
    file_system, source = hadoop(spark, draft)
    _, target = hadoop(spark, final)
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(file_system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(file_system.makeQualified(source), file_system.makeQualified(target), options)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or file_system.exists(target):
            return False
        raise
    return True
