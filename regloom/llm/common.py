"""Helpers that the corpus operators share: staged tables and small settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and RE2 agree on this class: everything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir, or a local one where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="regloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df to the shared folder, in one subfolder for each value of `by` if named, and read it back.

    This cuts the lineage: a lost executor costs a reread of these files, not a second run of what made them.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more. What is returned to a caller must not rest on them."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def salts(spark: SparkSession) -> int:
    """Pieces into which hot groups are dealt; it follows the shuffle width, so pieces stay small as data and width grow."""
    return max(64, partitions(spark))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def importable(spark: SparkSession) -> None:
    """Let Python workers that start in another folder find this package; a cluster has it installed."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
