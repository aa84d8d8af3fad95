"""Readers of raw collections. Each gives documents and, where rows can be bad, rejects with a reason."""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip_wrapper
from ..operators.normalize import titled

#: Lines that open and close the body of a book.
BOOK_START = r"(?i)\*{3} ?START OF (?:THE|THIS) PROJECT"
BOOK_END = r"(?i)\*{3} ?END OF (?:THE|THIS) PROJECT"
#: Fixed value: elements of an encoded text whose content is one block of its body.
BLOCKS = ("p", "head", "l", "item", "ab", "u")


def row_ordinals(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet rows with ``source_shard`` (file name) and ``row_ordinal`` (place in the file): identity by position."""
    df = spark.read.parquet(path)
    return df.select(*(columns or df.columns), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("source_shard"), F.col("_metadata.row_index").alias("row_ordinal"))


def read_books(spark: SparkSession, path: str, source: str = "books") -> tuple[DataFrame, DataFrame]:
    """One file, one document: UTF-8 with or without a mark at its head, wrapper lines stripped.

    Files that are no UTF-8, or empty, are rejects. The file name without its ending is the id.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    text, bad = bytes(content).decode("utf-8-sig"), None
                except UnicodeDecodeError as e:
                    text, bad = None, f"not_utf8_at_{e.start}"
                rows.append((name, text, bad))
            yield pd.DataFrame(rows, columns=["path", "text", "reason"])

    read = files.mapInPandas(decode, "path string, text string, reason string")
    name = F.element_at(F.split("path", "/"), -1)
    body = strip_wrapper("text", BOOK_START, BOOK_END)
    rows = read.select(
        F.lit(source).alias("source"), F.regexp_replace(name, r"\.txt$", "").alias("original_id"), name.alias("raw_source_file"), F.lit("0").alias("raw_record_identifier"),
        body.alias("text"), F.coalesce("reason", F.when(F.trim(body) == "", "empty")).alias("reason"),
    )
    return rows.where(F.col("reason").isNull()).drop("reason"), rows.where(F.col("reason").isNotNull()).drop("text")


def read_lines(spark: SparkSession, path: str, source: str = "lines") -> tuple[DataFrame, DataFrame]:
    """One line, one document, blank lines too; lines with bytes that are no UTF-8 are rejects. The id is the number of the line in its file, from 0.

    Lines are numbered within the block that a task reads, blocks by the lines
    before them, so numbers do not depend on how files are cut into blocks.
    """
    lines = spark.read.text(path).select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text")
    )
    lines = lines.withColumn("n", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1)
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(sizes.select("file", "block", before.alias("before")), ["file", "block"])
    rows = placed.select(
        F.lit(source).alias("source"), F.col("file").alias("raw_source_file"), (F.col("before") + F.col("n")).cast("string").alias("raw_record_identifier"), "text", F.is_valid_utf8("text").alias("valid")
    )
    bad = rows.where(~F.col("valid")).select("source", "raw_source_file", "raw_record_identifier", F.lit("not_utf8").alias("reason"))
    return rows.where("valid").drop("valid"), bad


def read_titled(spark: SparkSession, path: str, source: str = "encyclopedia") -> DataFrame:
    """Parquet rows ``id, url, title, text``; the title is put before texts that do not begin with it."""
    rows = row_ordinals(spark, path, "id", "url", "title", "text")
    return rows.select(
        F.lit(source).alias("source"), F.col("id").cast("string").alias("original_id"), F.col("url").alias("original_url"), "title", titled("title", "text").alias("text"),
        F.col("source_shard").alias("raw_source_file"), F.col("row_ordinal").cast("string").alias("raw_record_identifier"),
    )


def read_partitioned(spark: SparkSession, path: str, known: tuple[str, ...], source: str = "web", extra: str = "upstream_metadata_json") -> tuple[DataFrame, DataFrame]:
    """Parquet under ``subset=<name>/``: the columns of ``known``, all others as one JSON object in the order of their names.

    Rows whose own column ``declared_subset`` names another subset than their folder are rejects.
    """
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    others = sorted(set(df.columns) - set(known) - {"subset", "declared_subset"})
    told = F.to_json(F.struct(*others)) if others else F.lit(None).cast("string")
    wrong = F.col("declared_subset").isNotNull() & (F.col("declared_subset") != F.col("subset").cast("string")) if "declared_subset" in df.columns else F.lit(False)
    rows = df.select(*[c for c in known if c in df.columns and c != "subset"], F.col("subset").cast("string").alias("subset"), F.lit(source).alias("source"), told.alias(extra), wrong.alias("__wrong"))
    return rows.where(~F.col("__wrong")).drop("__wrong"), rows.where("__wrong").drop("__wrong").withColumn("reason", F.lit("subset_differs_from_folder"))


def parse_encoded(content: bytes) -> Iterator[tuple[str, str, str]]:
    """(id, body, metadata as JSON) of every encoded text in a file, read as a stream; blocks of the body are parted by blank lines."""
    local = lambda tag: tag.rsplit("}", 1)[-1]
    stream = gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    for _, node in ElementTree.iterparse(stream, events=("end",)):
        if local(node.tag) != "TEI":
            continue
        header, blocks, name = {}, [], node.get("{http://www.w3.org/XML/1998/namespace}id") or node.get("id") or ""
        for child in node:
            if local(child.tag) == "teiHeader":
                for x in child.iter():
                    text = " ".join((x.text or "").split())
                    if text and local(x.tag) not in header:
                        header[local(x.tag)] = text
            elif local(child.tag) == "text":
                for body in (b for b in child.iter() if local(b.tag) == "body"):
                    blocks += [" ".join("".join(x.itertext()).split()) for x in body.iter() if local(x.tag) in BLOCKS]
        yield name, "\n\n".join(b for b in blocks if b), json.dumps(header, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        node.clear()


def read_encoded(spark: SparkSession, path: str, source: str = "encoded") -> tuple[DataFrame, DataFrame]:
    """Encoded texts from XML files, compressed or not, several to a file; the folder above a file is its subset. Files that cannot be parsed are rejects."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml*").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(name, i, key, body, meta, None) for i, (key, body, meta) in enumerate(parse_encoded(bytes(content)))]
                except (ElementTree.ParseError, OSError, EOFError) as e:
                    rows.append((name, -1, None, None, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "n", "id", "text", "meta", "reason"])

    read = files.mapInPandas(parse, "path string, n int, id string, text string, meta string, reason string")
    parts = F.split("path", "/")
    rows = read.select(
        F.lit(source).alias("source"), F.element_at(parts, -2).alias("subset"), F.nullif("id", F.lit("")).alias("original_id"), F.element_at(parts, -1).alias("raw_source_file"),
        F.col("n").cast("string").alias("raw_record_identifier"), "text", F.col("meta").alias("upstream_metadata_json"), "reason",
    )
    return rows.where(F.col("reason").isNull()).drop("reason"), rows.where(F.col("reason").isNotNull()).select("source", "raw_source_file", "reason")


def read_benchmark(spark: SparkSession, path: str, roles: dict[str, str], name: str, identity: tuple[str, ...], unmatched: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines to benchmark fields: one row for each item and role, with ``roles`` from keys of the file to field roles.

    A key that is missing or not expected anywhere in the file is an error, as is a broken line. Roles in ``unmatched`` are not matchable.
    """
    found = set(spark.read.json(path).columns) if Path(path).exists() or "://" in path else set()
    expected = set(roles) | set(identity)
    if found != expected:
        raise ValueError(f"keys differ: missing {sorted(expected - found)}, not expected {sorted(found - expected)}")
    rows = spark.read.schema(", ".join(f"`{k}` string" for k in sorted(expected))).option("mode", "FAILFAST").json(path)
    example = F.substring(F.sha2(F.concat_ws("\0", F.lit(name), *[F.coalesce(c, F.lit("")) for c in identity]), 256), 1, 24)
    fields = F.explode(F.array(*[F.struct(F.lit(role).alias("field_role"), F.col(key).alias("original_text")) for key, role in roles.items()]))
    made = rows.select(F.lit(name).alias("benchmark_name"), example.alias("example_id"), fields.alias("f"))
    return made.select(
        "benchmark_name", "example_id", F.concat_ws(":", "example_id", "f.field_role").alias("field_id"), "f.field_role", "f.original_text", (~F.col("f.field_role").isin(*unmatched)).alias("matchable")
        if unmatched else F.lit(True).alias("matchable"),
    )


#: Readers by kind of collection.
REGISTRY: dict[str, Callable] = {"books": read_books, "lines": read_lines, "titled": read_titled, "partitioned": read_partitioned, "encoded": read_encoded, "benchmark": read_benchmark}


def reader(kind: str) -> Callable:
    """The reader of a kind of collection; an error names the kinds there are."""
    if kind not in REGISTRY:
        raise KeyError(f"no reader for {kind!r}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[kind]


def discover(spark: SparkSession, folder: str, skip: tuple[str, ...] = ("test", "smoke"), ending: str = ".parquet") -> list[str]:
    """All files of an ending under a folder of any file system, in order, without those in folders below it whose names hold a word of ``skip``."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toString().rstrip("/") + "/"
    found, names = fs.listFiles(root, True), []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    return sorted(n for n in names if n.endswith(ending) and not any(s in part.lower() for part in n.removeprefix(base).split("/")[:-1] for s in skip))


def open_path(path: str):
    """A binary stream over a file of any file system that Arrow knows, for tasks."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def constant_columns(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, column, value)`` of columns that hold one value and no NULL, from the statistics of all row groups of a file; columns whose statistics do not tell are left out, so are files without rows."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for file in batch["file"]:
                with open_path(file) as f:
                    meta = pq.read_metadata(f)
                told: dict[str, set] = {}
                groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                for group in (g for g in groups if g.num_rows):
                    for c in (group.column(i) for i in range(group.num_columns)):
                        s = c.statistics
                        sure = s is not None and s.has_min_max and s.has_null_count and s.null_count == 0 and s.min == s.max
                        told.setdefault(c.path_in_schema, set()).add(s.min if sure else ...)
                rows += [(file, c, str(next(iter(v)))) for c, v in told.items() if len(v) == 1 and ... not in v]
            yield pd.DataFrame(rows, columns=["file", "column", "value"])

    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return listed.repartition(max(1, min(len(files), 200))).mapInPandas(read, "file string, column string, value string")


def row_groups(spark: SparkSession, files: list[str], columns: tuple[str, ...] = ()) -> DataFrame:
    """Footers of files: ``file, row_group, start, rows, bytes`` (compressed bytes of ``columns``, all if none are named). Footers are read by tasks."""
    wanted = list(columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for file in batch["file"]:
                with open_path(file) as f:
                    meta, start = pq.read_metadata(f), 0
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    parts = [group.column(i) for i in range(group.num_columns)]
                    size = sum(c.total_compressed_size for c in parts if not wanted or c.path_in_schema.split(".")[0] in wanted)
                    rows.append((file, g, start, group.num_rows, size))
                    start += group.num_rows
            yield pd.DataFrame(rows, columns=["file", "row_group", "start", "rows", "bytes"])

    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return listed.repartition(max(1, min(len(files), 200))).mapInPandas(read, "file string, row_group int, start long, rows long, bytes long")


def load_config(path: str) -> dict:
    """A JSON or, where a YAML library is installed, YAML file whose top level is a mapping."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        out = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML files need a YAML library") from e
        out = yaml.safe_load(text)
    if not isinstance(out, dict):
        raise ValueError(f"{path}: a mapping is needed at the top")
    return out
