"""Tables, staged results and files that the operators of this subpackage share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peernet.config import shared_dir
from peernet.sources.tables import delete

# Fixed value: characters that separate words; every other character belongs to a word.
NOT_WORD = r"[^\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/llm/{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, lineage cut, no executor holds the only copy."""
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    df.sparkSession._jvm.System.gc()  # lets Spark's cleaner drop the shuffle files of the finished job
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, column: str, what: str) -> DataFrame:
    """Like `stage`, with the rows dealt by `column` once: joins and groups by it do not shuffle them again."""
    spark = df.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"staged_{uuid.uuid4().hex}"
    write = df.repartition(buckets, F.col(f"`{column}`")).write.option("compression", "snappy").option("path", scratch(spark, what))
    write.bucketBy(buckets, column).saveAsTable(name)
    spark._jvm.System.gc()
    dealt = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name goes, the files stay
    return dealt


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing refers to any more."""
    spark._jvm.System.gc()


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing will read any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def open_store(uri: str):
    """(file system, path) of a shared path, inside a task. pyarrow reaches local, HDFS and object stores."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def normal_words(text: Column) -> Column:
    """Lower-case words joined by single spaces; '' for a text without words."""
    return F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " "))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
