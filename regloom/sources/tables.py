"""Readers and writers. Schemas are given, never inferred; what is missing reads as an empty table."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def importable(spark: SparkSession) -> None:
    """Let Python workers that start in another folder find this package; a cluster has it installed."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def parquet(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    importable(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, rows: int = 5_000) -> DataFrame:
    """df over so many tasks that each holds about `rows` rows: for tables of few bytes, which are read in one task, where a row takes long."""
    return df.repartition(max(1, -(-df.count() // rows)))


def json_envelope(spark: SparkSession, path: str, schema: T.StructType, rows: str) -> tuple[DataFrame, DataFrame]:
    """(one-row metadata, rows) of a JSON document that wraps an array; a missing file gives empty tables."""
    try:
        doc = spark.read.schema(schema).option("multiLine", True).json(path)
        doc.isEmpty()
    except AnalysisException:
        doc = spark.createDataFrame([], schema)
    return doc.drop(rows), doc.select(F.inline_outer(rows)) if isinstance(schema[rows].dataType.elementType, T.StructType) else doc.select(F.explode(rows))


def csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"', encoding="UTF-8").csv(path)


def keyed(df: DataFrame, keys: DataFrame, on: str, distinct: Sequence[str] | None = None) -> DataFrame:
    """Rows of the wanted keys, each once."""
    out = df.join(keys.select(on).distinct(), on, "left_semi")
    return out.dropDuplicates(list(distinct)) if distinct else out


def literal_rows(spark: SparkSession, path: str, keys: Sequence[str], flags: Sequence[str] = (), stop: str | None = None) -> DataFrame:
    """Rows from text lines that hold key:"value" pairs and key:true flags, with pos; lines from a stop line on go."""
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    if stop:
        end = lines.where(F.col("value").rlike(stop)).agg(F.min("pos").alias("end"))
        lines = lines.crossJoin(F.broadcast(end)).where(F.col("end").isNull() | (F.col("pos") < F.col("end"))).drop("end")
    plain = lambda k: F.regexp_replace(F.regexp_extract("value", rf'\b{k}\s*:\s*"((?:[^"\\]|\\.)*)"', 1), r"\\(.)", "$1")
    out = lines.select("pos", *[plain(k).alias(k) for k in keys], *[F.col("value").rlike(rf"\b{f}\s*:\s*true\b").alias(f) for f in flags])
    return out.where(F.col(keys[0]) != "")


def harvested_keys(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Distinct values of "name":"…" in generated text."""
    text = spark.read.text(path)
    return text.select(F.explode(F.regexp_extract_all("value", F.lit(rf'"{name}"\s*:\s*"([^"]+)"'), F.lit(1))).alias(name)).distinct()


def snippets(attachments: DataFrame, array: str, carry: Sequence[str]) -> DataFrame:
    return attachments.select(*carry, F.posexplode_outer(array).alias("pos", "s")).select(*carry, "pos", "s.*")


def binary_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, sha256 of files."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def records(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json", lines: bool = False) -> DataFrame:
    """JSON records in a folder tree, one a file or one a line; malformed ones go."""
    return spark.read.schema(schema).options(mode="DROPMALFORMED", multiLine=not lines, recursiveFileLookup=True, pathGlobFilter=pattern).json(path)


def aliased(df: DataFrame, names: Sequence[str], blanks: Sequence[str] = ("", "None", "NULL")) -> Column:
    """The first filled of the columns whose names equal or else hold one of the preferred names."""
    plain = {c: c.lower().replace("-", "_") for c in df.columns}
    wanted = [n.lower().replace("-", "_") for n in names]
    hits = [c for n in wanted for c, p in plain.items() if p == n] + [c for n in wanted for c, p in plain.items() if n in p and p != n]
    value = lambda c: F.when(~F.trim(F.col(c).cast("string")).isin(*blanks), F.trim(F.col(c).cast("string")))
    return F.coalesce(*[value(c) for c in dict.fromkeys(hits)]) if hits else F.lit(None).cast("string")


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir, or in local mode a folder of this machine where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="regloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def kept(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"kept-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete what kept() has written, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_compact(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header in every file; bom: with the mark in front that spreadsheets ask for, which csv() readers must strip."""
    if bom:
        df = df.select(*[F.col(c).alias(("\ufeff" if i == 0 else "") + c) for i, c in enumerate(df.columns)])
    df.write.options(header=True, escape='"', lineSep="\n", encoding="UTF-8").csv(path)


def write_lines(report: DataFrame, path: str) -> None:
    report.orderBy("section", "pos").select("line").write.text(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_if_changed(df: DataFrame, path: str, ignore: Sequence[str] = (), check: bool = False) -> bool:
    """Replace the table under path only if the new one differs beyond volatile columns; whether it does.

    check: only tell. The new version is written beside; then the old one steps aside, the new one moves into place, and the
    old one is deleted last. A move that fails stops the call and puts the old one back, so that one of them is whole at any
    time, under path or beside it. A table of other columns differs. For readers that must never find the path empty, see
    versions.Versions.
    """
    from ..operators.diff import changed

    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    place, beside, before = hadoop(path), *(hadoop(f"{path}.{name}-{uuid.uuid4().hex}") for name in ("new", "old"))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    there = files.exists(place)
    if there:
        old = spark.read.parquet(path)
        if dict(old.dtypes) == dict(df.dtypes) and not changed(old.select(*df.columns), df, ignore):
            return False
    if check:
        return True
    df.write.parquet(beside.toString())
    if there and not files.rename(place, before):
        files.delete(beside, True)
        raise OSError(f"{path} could not be moved aside; it stays as it is")
    if not files.rename(beside, place):
        if there:
            files.rename(before, place)
        raise OSError(f"the new version could not be moved to {path}; the old one is {'back' if there else 'missing'}")
    if there:
        files.delete(before, True)
    return True


def store_evidence(store: DataFrame, new: DataFrame, key: str, sha: str = "sha256") -> DataFrame:
    """Rows to append to a content-addressed store: known hashes are reused, other content gets a versioned name."""
    fresh = new.join(store.select(key, sha), [key, sha], "left_anti")
    taken = store.select(key).distinct().withColumn("_taken", F.lit(True))
    name = F.when(F.col("_taken"), F.concat(F.col(key), F.lit("-"), F.substring(sha, 1, 12))).otherwise(F.col(key))
    return fresh.join(taken, key, "left").withColumn("name", name).drop("_taken")
