"""CSV and XLSX scans as raw text with lineage."""

from __future__ import annotations

import csv
import io
import json
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.keys import row_hash
from ..functions.text import sanitize_names
from ..schemas import META
from ..session import materialize
from .records import scan_records
from .xlsx import read_rows


HEADER_CHARS = 1 << 20


@dataclass(frozen=True)
class FileInfo:
    path: str
    name: str  # relative to the project root
    size: int
    modified_ms: int


@dataclass(frozen=True)
class Ingested:
    rows: DataFrame | None
    files: DataFrame | None


def unescape_path(c: Column) -> Column:
    """``_metadata.file_path`` is URI-encoded; the plain path without a ``file:`` prefix."""
    plain = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "/")


def _plain(path: str) -> str:
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def list_files(spark: SparkSession, pattern: str, root: str = "") -> list[FileInfo]:
    """Files that match a glob, sorted by path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    prefix = _plain(fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)).toString()) if root else ""
    found = []
    for status in fs.globStatus(target) or []:
        if status.isFile():
            path = status.getPath().toString()
            name = _plain(path).removeprefix(prefix).lstrip("/") if root else _plain(path)
            found.append(FileInfo(path, name, status.getLen(), status.getModificationTime()))
    return sorted(found, key=lambda f: f.path)


def unique_headers(header: Sequence[str]) -> list[str]:
    """Header names made unique: later copies get .1, .2, ...; blanks are named by position."""
    names = [h if h.strip() else f"Unnamed: {i}" for i, h in enumerate(header)]
    out: list[str] = []
    for name in names:
        unique, n = name, 0
        while unique in out or (n and unique in names):
            n += 1
            unique = f"{name}.{n}"
        out.append(unique)
    return out


def open_quote(line: str, inside: bool = False) -> bool:
    """Whether a quoted field is still open after a line.

    A quote opens a field only at its start; elsewhere in an unquoted field it is text.
    """
    start, i = not inside, 0
    while i < len(line):
        c = line[i]
        if inside:
            if c == '"':
                if line[i + 1:i + 2] == '"':
                    i += 1
                else:
                    inside = False
        elif c == '"' and start:
            inside = True
        start = c == "," and not inside
        i += 1
    return inside


def read_header(spark: SparkSession, path: str) -> list[str]:
    """First record of a CSV file; its lines are read until no quoted field is open.

    A header above ``HEADER_CHARS`` is an error instead of a file pulled to the driver.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        lines, size, inside = [], 0, False
        while (line := reader.readLine()) is not None:
            inside = open_quote(line if lines else line.removeprefix("\ufeff"), inside)
            lines.append(line)
            size += len(line) + 1
            if size > HEADER_CHARS:
                raise ValueError(f"the header of {path} has more than {HEADER_CHARS} characters")
            if not inside and any(x.strip("\ufeff \t") for x in lines):
                break
        text = "\n".join(lines)
    finally:
        reader.close()
    text = text.removeprefix("\ufeff").strip("\r\n")
    return unique_headers(next(csv.reader(io.StringIO(text, newline="")), [])) if text else []


def survey(spark: SparkSession, files: Sequence[FileInfo]) -> dict[str, tuple[list[str], bool]]:
    """Of each file that isn't empty its header, and whether quoted fields span lines.  One pass over the text.

    Fields span lines where some line has an odd number of quotes; all other files can be split, so
    that one large file is read by many tasks.  The driver gets one line of each file and opens only those
    whose header goes on in the next line.
    """
    if not files:
        return {}
    value, path = F.col("value"), unescape_path(F.col("_metadata.file_path")).alias("path")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"')))
    first = (F.col("_metadata.file_block_start") == 0) & (F.btrim(value, F.lit("\ufeff \t")) != "")
    lines = spark.read.text([f.path for f in files]).select(
        path, F.when(first, value).alias("line"), F.monotonically_increasing_id().alias("at"), (quotes % 2 == 1).alias("odd"))
    found = lines.groupBy("path").agg(
        F.min_by("line", F.when(F.col("line").isNotNull(), F.col("at"))).alias("line"), F.bool_or("odd").alias("spans"))
    # A longer one is no header: it must not reach the driver.
    found = found.withColumn("line", F.when(F.length("line") <= HEADER_CHARS, F.col("line")))
    opened = {_plain(f.path): f.path for f in files}
    out = {}
    for row in found.collect():
        text = row.line.removeprefix("\ufeff") if row.line is not None else None
        if text is None or open_quote(text):
            header = read_header(spark, opened[row.path])
        else:
            header = unique_headers(next(csv.reader([text]), []))
        if header:
            out[opened[row.path]] = header, row.spans
    return out


def scan_texts(spark: SparkSession, found: dict[str, tuple[list[str], bool]]) -> list[tuple[list[str], DataFrame]]:
    """Header and numbered rows (columns _c0, _c1 ..., _path, source_row_number) of files of like header and layout."""
    groups: dict[tuple, list[str]] = defaultdict(list)
    for path, (header, spans) in found.items():
        groups[tuple(header), spans].append(path)
    scans = []
    for (header, spans), paths in groups.items():
        names = [f"_c{i}" for i in range(len(header))]
        if spans:
            rows = scan_records(spark, paths, names, unescape_path(F.col("_metadata.file_path")))
        else:
            rows = number_rows(materialize(scan_csv(spark, paths, names, False), "raw"))
        scans.append((list(header), rows))
    return scans


def scan_csv(spark: SparkSession, paths: list[str], header: Sequence[str], multi_line: bool) -> DataFrame:
    """Text columns plus path, block and order.  Blanks stay ``""`` and ``NA`` stays text.

    A row with more fields than the header raises an error: nothing is dropped unseen.
    """
    surplus = "_surplus"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, surplus]])
    df = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=True, quote='"', escape='"', multiLine=multi_line,
                 maxCharsPerColumn=-1, encoding="UTF-8")
        .csv(paths)
    )
    path = unescape_path(F.col("_metadata.file_path")).alias("_path")
    too_long = F.raise_error(F.concat(
        F.lit("a row has more fields than the header, "), F.col(surplus), F.lit(" among them: "), F.col("_metadata.file_path")))
    checked = F.when(F.col(surplus).isNotNull(), too_long.cast("string"))
    columns = [F.coalesce(checked, F.col(f"`{name}`"), F.lit("")).alias(name) if i == 0
               else F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) for i, name in enumerate(header)]
    return df.select(
        *columns, path, F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"),
    )


def number_rows(staged: DataFrame) -> DataFrame:
    """1-based ``source_row_number`` per file without sorting a file in one task.

    Rows of a block are consecutive, so a row's place is its distance from the block's first
    row plus the sizes of the file's earlier blocks.  ``staged`` must be a written table: its
    blocks and order then cannot change between the two reads.
    """
    w = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        staged.groupBy("_path", "_block").agg(F.min("_order").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    )
    number = F.col("_order") - F.col("_first") + F.col("_before") + 1
    return staged.join(materialize(blocks, "blocks"), ["_path", "_block"]).withColumn(
        "source_row_number", number
    ).drop("_order", "_first", "_before", "_block")


def _lineage(
    rows: DataFrame, header: Sequence[str], names: DataFrame, source: str, batch_id: str, now: str
) -> DataFrame:
    """Sanitised columns, metadata and the hash of the original headers and values."""
    safe = sanitize_names(header)
    internal = {h: f"_c{i}" for i, h in enumerate(header)}
    rows = rows.join(names, "_path").withColumns(
        {
            "batch_id": F.lit(batch_id), "ingested_at_utc": F.lit(now),
            "source_name": F.lit(source), "row_hash": row_hash(internal),
        }
    )
    values = [F.col(internal[h]).alias(s) for h, s in zip(header, safe)]
    return rows.select(*META, *values, "row_hash")


def ingest(
    spark: SparkSession, pattern: str, source: str, batch_id: str, now: str, root: str = "",
    only: Sequence[str] | None = None,
) -> Ingested:
    """Rows of all files of one source, and one registry row per file; ``only`` names some of the files.

    Files group by identical header and layout, each group is one scan, and the groups union
    by name.  Every file is parsed once, into the shared folder.
    """
    files = list_files(spark, pattern, root)
    if only is not None:
        wanted = {_plain(path) for path in only}
        files = [f for f in files if _plain(f.path) in wanted]
    if not files:
        return Ingested(None, None)
    for f in files:
        if not f.path.lower().endswith((".csv", ".xlsx")):
            raise ValueError(f"unsupported file type: {f.path}")
    sheets = [f for f in files if f.path.lower().endswith(".xlsx")]
    texts = [f for f in files if f not in sheets]
    found = survey(spark, texts)
    headers = {path: header for path, (header, _) in found.items()}
    scans = scan_texts(spark, found)
    if sheets:
        cells = materialize(read_rows(spark, [f.path for f in sheets]), "cells")
        first = cells.filter("line = 0").select("path", "cells").collect()
        by_header: dict[tuple, list[str]] = defaultdict(list)
        for r in first:
            path = next(f.path for f in sheets if _plain(f.path) == r.path)
            headers[path] = unique_headers(r.cells)
            by_header[tuple(headers[path])].append(r.path)
        for header, paths in by_header.items():
            rows = cells.filter(F.col("path").isin(paths) & (F.col("line") > 0)).select(
                *[F.coalesce(F.get("cells", i), F.lit("")).alias(f"_c{i}") for i in range(len(header))],
                F.col("path").alias("_path"), F.col("line").cast("bigint").alias("source_row_number"),
            )
            scans.append((list(header), rows))
    names = spark.createDataFrame([(_plain(f.path), f.name) for f in files], "_path string, source_file string")
    parts = [_lineage(rows, header, names, source, batch_id, now) for header, rows in scans]
    if not parts:
        return Ingested(None, None)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return Ingested(rows, _registry(spark, rows, files, headers, source, batch_id, now))


def _registry(spark, rows, files, headers, source, batch_id, now) -> DataFrame:
    """One row per file with its size, headers and number of rows."""
    listed = spark.createDataFrame(
        [
            (
                f.name, f.modified_ms, f.size,
                json.dumps(headers.get(f.path, []), ensure_ascii=False),
                json.dumps(sanitize_names(headers.get(f.path, [])), ensure_ascii=False),
            )
            for f in files
        ],
        "source_file string, modified_ms bigint, file_size_bytes bigint, "
        "original_columns_json string, sanitized_columns_json string",
    )
    counts = rows.groupBy("source_file").agg(F.count("*").alias("row_count"))
    return listed.join(counts, "source_file", "left").select(
        F.lit(batch_id).alias("batch_id"), F.lit(source).alias("source_name"), "source_file",
        F.date_format(F.timestamp_millis("modified_ms"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("file_modified_at"),
        "file_size_bytes", F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "original_columns_json", "sanitized_columns_json", F.lit(now).alias("ingested_at_utc"),
    )
