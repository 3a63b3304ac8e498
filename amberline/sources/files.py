"""Readers of the output folders. A folder that is not there yet reads as an empty frame."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.functions.columns import text
from amberline.operators.views import coerce_results
from amberline.schemas import ALERTS, CSV_OPTIONS, RESULTS, SCORED, Layout, ddl, names, struct
from amberline.session import remove, scratch_path

log = logging.getLogger(__name__)
_TEXT_FIRST = {"amount", "fraud_probability", "processed_time"}
#: Types of the folder columns that this library writes.
FOLDERS = {"run": "string", "batch_id": "int", "chunk": "string", "arrival_date": "date"}


def _or_empty(spark: SparkSession, layout: Layout, partitions: Sequence[str], read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], struct(layout))
        return empty.selectExpr("*", *(f"CAST(NULL AS {FOLDERS.get(name, 'string')}) AS `{name}`" for name in partitions))


def _folder_types(partitions: Sequence[str]) -> str:
    """Folder columns for a schema, so that a folder that has none left still has the columns."""
    return "".join(f", `{name}` {FOLDERS.get(name, 'string')}" for name in partitions)


def _folder_options(nested: bool, lenient: bool = True) -> dict[str, str]:
    # Recursive lookup turns partition discovery off, so it is for folders without partitions.
    options = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"} if lenient else {}
    return {**options, "recursiveFileLookup": "true"} if nested else options


def _scanned_heads(spark: SparkSession, path: str, nested: bool) -> DataFrame:
    """``file, line`` by a scan of all text, for stores that only Spark's readers can open."""
    lines = spark.read.options(**_folder_options(nested)).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # grows along a block
    )
    return lines.where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("line"))


def _head_reader(block: int, most: int):
    """A task that opens each listed file and reads blocks until its first record ends.

    It imports nothing of this library, which workers may lack.
    """

    def opened(uri: str):
        from urllib.parse import unquote, urlsplit

        from pyarrow import fs

        scheme = urlsplit(uri).scheme
        if scheme in ("", "file"):
            return fs.LocalFileSystem(), unquote(urlsplit(uri).path)
        return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if scheme == "s3a" else uri)

    def end_of(data: bytes) -> int:
        """Where the first line break outside quotes stands, or -1."""
        quoted = False
        for i, byte in enumerate(data):
            if byte == 34:
                quoted = not quoted
            elif byte in (10, 13) and not quoted:
                return i
        return -1

    def head(uri: str) -> tuple[bytes | None, int]:
        store, place = opened(uri)
        data, at = b"", -1
        with store.open_input_file(place) as raw:
            compressed = place.rsplit(".", 1)[-1] in ("gz", "bz2", "zst")
            import pyarrow as pa

            stream = pa.CompressedInputStream(raw, {"gz": "gzip", "bz2": "bz2", "zst": "zstd"}[place.rsplit(".", 1)[-1]]) if compressed else raw
            while at < 0 and len(data) < most:
                more = stream.read(block)
                if not more:
                    break
                data += more
                at = end_of(data)
            fetched = raw.tell()
        if at < 0 and len(data) >= most:  # a quote that is not closed: the line, as it is
            at = min((i for i in (data.find(b"\n"), data.find(b"\r")) if i >= 0), default=len(data))
        return (data[:at] if at >= 0 else data) or (b"" if data else None), fetched

    def run(batches):
        import csv

        import pyarrow as pa

        shape = pa.schema([("file", pa.string()), ("length", pa.int64()), ("line", pa.string()), ("header", pa.list_(pa.string())), ("readable", pa.bool_()), ("fetched", pa.int64())])
        for batch in batches:
            rows = []
            for uri, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    data, fetched = head(uri)
                    line = None if data is None else data.decode("utf-8", "replace")
                    header = None if line is None else next(csv.reader([line.removeprefix("\ufeff")], strict=False), [])
                    rows.append((uri, length, line, header, True, fetched))
                except (OSError, ValueError, pa.ArrowException, csv.Error):
                    rows.append((uri, length, None, None, False, 0))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)

    return run, head


#: Bytes read of a file at a time for its first record, and at most.
HEAD_BLOCK, HEAD_MOST = 1 << 16, 1 << 20


def first_records(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """``file, length, line, header, readable, fetched`` of the files under ``path`` that hold bytes: their first records.

    Tasks open the files for themselves and read one block of each, as a rule; ``fetched`` says how many
    bytes. A file whose bytes cannot be opened or unpacked is not ``readable``. A first record over
    ``HEAD_MOST`` bytes counts as its first line. In stores that tasks cannot open, Spark scans the text.
    """
    files = spark.read.format("binaryFile").options(**_folder_options(nested)).load(path)
    listed = files.select(F.col("_metadata.file_path").alias("file"), "length").where("length > 0")
    run, head = _head_reader(HEAD_BLOCK, HEAD_MOST)
    if not _opens(spark, path, listed, head):
        lines = _scanned_heads(spark, path, nested)
        found = listed.join(lines, "file", "left").withColumn("readable", F.col("line").isNotNull())
        options = {"sep": ",", "quote": '"', "escape": '"'}
        cells = ", ".join(f"c{i} string" for i in range(64))
        header = F.from_csv(F.regexp_replace("line", "^\ufeff", ""), cells, options)
        header = F.when(F.col("line").isNotNull(), F.filter(F.array(*(header[f"c{i}"] for i in range(64))), lambda x: x.isNotNull()))
        return found.select("file", "length", "line", header.alias("header"), "readable", F.lit(0).cast("long").alias("fetched"))
    return listed.mapInArrow(run, "file string, length long, line string, header array<string>, readable boolean, fetched long")


def _opens(spark: SparkSession, path: str, listed: DataFrame, head: Callable) -> bool:
    """Whether tasks can open the store of a path; that a file itself is damaged does not matter."""
    import pyarrow as pa

    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    some = None if place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file" else listed.first()
    try:
        if some is not None:
            head(some.file)
    except (OSError, ValueError, pa.ArrowException):
        return False
    return True


def unread_files(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """``file, length`` of the files under ``path`` that hold bytes but cannot be read as text."""
    try:
        return first_records(spark, path, nested).where("NOT readable").select("file", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, length bigint")


def read_results(
    spark: SparkSession,
    path: str,
    nested: bool = False,
    partitions: Sequence[str] = (),
    multiline: bool = True,
) -> DataFrame:
    """Result rows from CSV files with a header; unreadable files are skipped, and their number logged.

    Numbers and times that do not parse are null. ``partitions`` names folder columns to keep
    (``batch_id``), on which filters prune folders. Text may hold line breaks, so each file,
    one writer task's share of a micro-batch, is read by one task; for larger files known to
    have none, ``multiline=False`` lets Spark split them.

    Columns go by the name in each file's own first record: in another order, with columns missing
    (null) or added (left out). Where all are the standard one, that is all; else files are read by
    position and each row is put in order by its file's header. Headers stay a table, one row a file.
    """
    standard = names(RESULTS)

    def read() -> DataFrame:
        place = scratch_path(spark, "headers")
        first_records(spark, path, nested).select("file", "header", "readable").write.parquet(place)
        heads = spark.read.schema("file string, header array<string>, readable boolean").parquet(place)
        wanted = F.array(*map(F.lit, standard))
        found = heads.agg(
            F.count_if(~F.col("readable")).alias("skipped"),
            F.coalesce(F.bool_and(F.col("header") == wanted), F.lit(True)).alias("all_standard"),
            F.max(F.size("header")).alias("width"),
        ).first()
        if found.skipped:
            log.warning("%d unreadable files under %s are skipped", found.skipped, path)
        reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multiline).lower()).options(**_folder_options(nested))
        if found.all_standard:
            remove(spark, place)
            raw = {name: "string" if name in _TEXT_FIRST else kind for name, kind in RESULTS}
            rows = reader.schema(", ".join(f"`{name}` {kind}" for name, kind in raw.items())).csv(path)
        else:
            texts = reader.schema(", ".join(f"_c{i} string" for i in range(found.width))).csv(path)
            places = F.array(*(F.expr(f"nullif(array_position(header, {text(name)}), 0) - 1") for name in standard))
            by_file = heads.where("header IS NOT NULL").select(F.col("file").alias("_file"), places.alias("places"))
            cells = F.array(*(f"_c{i}" for i in range(found.width)))
            rows = texts.select(cells.alias("_cells"), F.col("_metadata.file_path").alias("_file"), *partitions).join(by_file, "_file")
            typed = [
                f"try_cast(get(_cells, CAST(places[{i}] AS INT)) AS {'string' if name in _TEXT_FIRST else kind}) AS `{name}`" for i, (name, kind) in enumerate(RESULTS)
            ]
            rows = rows.selectExpr(*typed, *partitions)
        return coerce_results(rows).select(*standard, *partitions)

    return _or_empty(spark, RESULTS, partitions, read)


def read_alerts(
    spark: SparkSession, path: str, nested: bool = False, partitions: Sequence[str] = ()
) -> DataFrame:
    """Alert rows from JSON lines. Only a line that is not JSON is dropped; absent keys are null.

    Unreadable files are skipped; ``unread_files`` lists them.
    """
    fields = names(ALERTS)

    def read() -> DataFrame:
        lines = (
            spark.read.schema(f"{ddl(ALERTS)}, `_bad` string{_folder_types(partitions)}")
            .options(
                mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", **_folder_options(nested)
            )
            .json(path)
        )
        # A wrong type in one field marks the line as bad too, but leaves other fields filled.
        usable = F.col("_bad").isNull() | F.coalesce(
            *(F.col(name).cast("string") for name in fields)
        ).isNotNull()
        return lines.where(usable).select(*fields, *partitions)

    return _or_empty(spark, ALERTS, partitions, read)


def read_predictions(
    spark: SparkSession, path: str, nested: bool = False, partitions: Sequence[str] = ()
) -> DataFrame:
    """Scored rows from Parquet, all 20 columns. A file that is damaged or vanishes is an error."""

    def read() -> DataFrame:
        files = spark.read.schema(ddl(SCORED) + _folder_types(partitions)).options(**_folder_options(nested, lenient=False)).parquet(path)
        return files.select(*names(SCORED), *partitions)

    return _or_empty(spark, SCORED, partitions, read)
