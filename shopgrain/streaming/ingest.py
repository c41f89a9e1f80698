"""Incremental CSV ingest into append-only raw tables."""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

AVAILABLE_NOW = {"availableNow": True}
EXTRA, CORRUPT = "_extra_columns", "_corrupt_record"
AUDIT = ["_ingested_at", "_source_file", EXTRA, CORRUPT]
FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"
MAX_FILES = 1000
HEADERS_PER_SCAN = 50
HEADER_READS = 16


def append_to(
    stream: DataFrame, sink_dir: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table; the checkpoint makes every input row count once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start(sink_dir)
    )


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines of text files that are not empty, with their file and the place of their split in it."""
    plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", f) for f in files]  # paths, not patterns
    lines = spark.read.text(plain).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return lines.where(F.length("value") > 0)


def file_headers(spark: SparkSession, files: list[str]) -> list[tuple[str, str, str]]:
    """Path, name in the table and first line of each file that has one. A read stops after that line."""

    def first(path: str) -> tuple[str, str, str] | None:
        row = _lines(spark, [path]).select("file", "value").first()
        return row and (path, row.file, row.value)

    with ThreadPoolExecutor(HEADER_READS) as pool:
        return [found for found in pool.map(first, files) if found]


def column_names(header: str) -> list[str]:
    """Names of a header: one without a name is called after its place, one that is repeated gets a number."""
    given = [n or f"_c{i}" for i, n in enumerate(next(csv.reader([header])))]
    taken = {n.lower() for n in given}
    seen, names = set(), []
    for n in given:
        name, k = n, 2
        while name.lower() in seen or (name != n and name.lower() in taken):
            name, k = f"{n}_{k}", k + 1
        seen.add(name.lower())
        names.append(name)
    return names


def _fields(header: str) -> Column:
    """The line cut into texts ``c0``, ``c1``, ..., and the whole line as ``bad`` if it has too many or too few."""
    raw = ", ".join(f"c{i} string" for i in range(len(column_names(header)))) + ", bad string"
    return F.from_csv("value", raw, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})


def _record(header: str, fields: Column, declared: StructType) -> Column:
    """The line as a struct: the declared columns, all others as a map, and the whole line if it is broken."""
    names = column_names(header)
    place = {n.lower(): fields.getField(f"c{i}") for i, n in enumerate(names)}
    kept, broken = [], fields.getField("bad").isNotNull()
    for f in declared:
        text = place.get(f.name.lower(), F.lit(None).cast("string"))
        kept.append(text.try_cast(f.dataType).alias(f.name))
        broken = broken | (text.isNotNull() & text.try_cast(f.dataType).isNull())
    known = {f.name.lower() for f in declared}
    rest = [F.struct(F.lit(n).alias("k"), place[n.lower()].alias("v")) for n in names if n.lower() not in known]
    extra = F.map_from_entries(F.array(*rest)) if rest else F.lit(None)
    line = F.when(broken, F.col("value"))
    return F.struct(*kept, extra.cast("map<string, string>").alias(EXTRA), line.alias(CORRUPT))


def _all_columns(headers: list[str]) -> StructType:
    spelled: dict[str, str] = {}
    for name in (n for h in headers for n in column_names(h)):
        spelled.setdefault(name.lower(), name)
    return StructType([StructField(n, StringType()) for n in spelled.values()])


def parse_by_name(
    spark: SparkSession, files: list[str], schema: StructType | None, headers_per_scan: int = HEADERS_PER_SCAN
) -> DataFrame | None:
    """Typed rows of CSV files that may differ in the order and number of columns; None if no file has a line.

    A file's header is its first line that is not empty; a line of its first split that repeats it word
    by word is a header too. Every file is scanned once: files with up to ``headers_per_scan``
    different headers share a scan, in which a row's file picks the parser. Names are compared without
    regard to case. Columns beside the schema go to a map; the line of a row with a value that can't be
    read, too many or too few values is kept. A name that a header repeats gets a number (``id``, ``id_2``).
    Without a schema all columns are text, and the table has those of all headers.
    """
    found = file_headers(spark, files)
    headers = sorted({header for _, _, header in found})
    declared = schema or _all_columns(headers)
    scans = []
    for start in range(0, len(headers), headers_per_scan):
        some = headers[start : start + headers_per_scan]
        here = [(path, file, some.index(header)) for path, file, header in found if header in some]
        # One row a file of the batch, which its reader bounds.
        kinds = spark.createDataFrame([(file, kind) for _, file, kind in here], "file string, kind int")
        rows = _lines(spark, [path for path, _, _ in here]).join(F.broadcast(kinds), "file", "left")
        is_header = F.get(F.array(*[F.lit(h) for h in some]), F.col("kind")) == F.col("value")
        kept = rows.where(~F.coalesce((F.col("block") == 0) & is_header, F.lit(False)))
        # A column of its own per header: the line is parsed once, not once for each use of one of its fields.
        cut = {f"__fields_{kind}": F.when(F.col("kind") == kind, _fields(h)) for kind, h in enumerate(some)}
        record = F.raise_error(F.concat(F.lit("no header is known of "), F.col("file")))
        for kind, header in enumerate(some):
            known = _record(header, F.col(f"__fields_{kind}"), declared)
            record = F.when(F.col("kind") == kind, known).otherwise(record)
        scans.append(kept.withColumns(cut).select("file", record.alias("record")))
    if not scans:
        return None
    return reduce(DataFrame.unionAll, scans).select(
        *[F.col("record")[f.name].alias(f.name) for f in declared],
        F.current_timestamp().alias("_ingested_at"),
        F.col("file").alias("_source_file"),
        F.col("record")[EXTRA].alias(EXTRA),
        F.col("record")[CORRUPT].alias(CORRUPT),
    )


def ingest_csv(
    spark: SparkSession,
    src_dir: str,
    schema: StructType | None,
    sink_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Start ingesting a CSV folder, each file once, into a table that ``read_evolving`` reads.

    Adds ``_ingested_at``, ``_source_file``, ``_extra_columns`` and ``_corrupt_record``. The stream is
    the list of new files, whose contents it doesn't read; ``max_files`` bounds a micro-batch. A batch
    that is delivered again replaces its own rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = parse_by_name(spark, sorted(r.path for r in batch.collect()), schema)
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{sink_dir}/batch={number}")

    reader = spark.readStream.format("binaryFile").schema(FILE_LISTING)
    listed = reader.option("maxFilesPerTrigger", max_files).load(src_dir)
    return (
        listed.select("path")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def append_evolving(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Union that widens to new columns; rows without them hold null."""
    if existing is None:
        return batch
    return existing.unionByName(batch, allowMissingColumns=True)


def read_evolving(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Read a raw table whose files may differ in columns."""
    return spark.read.option("mergeSchema", True).parquet(sink_dir).drop("batch")
