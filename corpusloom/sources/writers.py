"""Sinks: tables that appear whole or not at all, summaries, text dumps and checksums."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import word_count
from ..schema import assert_schema
from .readers import discover, open_path


def write_table(df: DataFrame, path: str, sort_within: Sequence[str] = (), partition_by: Sequence[str] = (), rows_a_file: int = 0) -> None:
    """Parquet that nobody sees before it is whole; an existing folder is an error, never overwritten.

    ``sort_within`` orders rows inside files, for narrow statistics, without a global sort.
    """
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode("errorifexists").option("compression", "zstd")
    if rows_a_file:
        writer = writer.option("maxRecordsPerFile", rows_a_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_shards(df: DataFrame, path: str, target_bytes: int = 256 * 2**20, text: str = "text") -> None:
    """Files of about ``target_bytes`` of text each: as many partitions as the texts' sum asks for, filled by hash of the rows."""
    total = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    write_table(df.repartition(max(1, -(-int(total) // target_bytes))), path)


def write_by_subset(df: DataFrame, path: str, provenance: dict[str, str]) -> None:
    """One folder a subset, with provenance columns the same in every row."""
    write_table(df.withColumns({k: F.lit(v) for k, v in provenance.items()}), path, partition_by=["subset"])


def write_summary(df: DataFrame, path: str, order: Sequence[str], kind: str = "csv") -> None:
    """A small result as one ordered CSV or JSON file in a new folder."""
    out = df.orderBy(*order).coalesce(1).write.mode("errorifexists")
    out.option("header", "true").csv(path) if kind == "csv" else out.json(path)


def write_training_text(df: DataFrame, path: str, longest: int = 1_000_000) -> dict[str, int]:
    """Texts as lines, LF after each document; U+0000 and over-long lines are an error before anything is written. Gives documents and words."""
    bad = F.contains("text", F.lit("\0"))
    lengths = F.array_max(F.transform(F.split("text", "\n"), F.length))
    told = df.agg(
        F.count(F.lit(1)).alias("documents"), F.sum(word_count("text")).alias("words"), F.count_if(bad).alias("zero"), F.count_if(lengths > longest).alias("long"), F.count_if(F.col("text").isNull()).alias("null")
    ).first()
    if told.zero or told.long or told.null:
        raise ValueError(f"{told.zero} texts with U+0000, {told.long} with lines above {longest} characters, {told.null} missing")
    df.select("text").write.mode("errorifexists").text(path)
    return {"documents": told.documents, "words": told.words or 0}


def save_sample(df: DataFrame, path: str, schema: StructType) -> None:
    """A table of a fixed schema."""
    write_table(assert_schema(df, schema), path)


def load_sample(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that must have a fixed schema; other columns or types are an error."""
    return assert_schema(spark.read.parquet(path), schema)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, bytes, sha256)`` of every file under a folder of any file system, hashed in tasks; marks of the writer and the manifest are left out."""
    root = files_root(spark, folder)
    names = [n for n in discover(spark, folder, (), "") if n.rsplit("/", 1)[-1][0] not in "._" and n != f"{root}manifest.json"]

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name in batch["file"]:
                h, size = hashlib.sha256(), 0
                with open_path(name) as f:
                    while part := f.read(2**20):
                        h.update(part)
                        size += len(part)
                rows.append((name.removeprefix(root), size, h.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "bytes", "sha256"])

    listed = spark.createDataFrame([(n,) for n in names], "file string")
    return listed.repartition(max(1, min(len(names), 200))).mapInPandas(digest, "path string, bytes long, sha256 string")


def files_root(spark: SparkSession, folder: str) -> str:
    """A folder's full name with its file system, ending in a slash."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"


def write_manifest(spark: SparkSession, folder: str, told: dict) -> str:
    """``manifest.json`` beside the files of a folder: what was told and the inventory; gives its own SHA-256. An existing one is an error."""
    files = [r.asDict() for r in inventory(spark, folder).orderBy("path").collect()]  # names and digests, one a file
    text = json.dumps(told | {"files": files}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest.json")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return hashlib.sha256(text.encode()).hexdigest()


def manifest_errors(spark: SparkSession, folder: str) -> list[str]:
    """What differs between a folder and its manifest: files missing, not listed, or changed; paths that leave the folder."""
    with open_path(f"{files_root(spark, folder)}manifest.json") as f:
        told = json.loads(f.read())
    listed = {f["path"]: f for f in told["files"]}
    have = {r.path: r.asDict() for r in inventory(spark, folder).collect()}
    errors = [f"{p}: path leaves the folder" for p in listed if p.startswith("/") or ".." in p.split("/")]
    errors += [f"{p}: missing" for p in listed.keys() - have.keys()] + [f"{p}: not listed" for p in have.keys() - listed.keys()]
    errors += [f"{p}: changed" for p in listed.keys() & have.keys() if listed[p] != have[p]]
    return sorted(errors)
