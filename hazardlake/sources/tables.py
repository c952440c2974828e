"""Tables, CSV copies and file listings."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazardlake.operators.aggregate import GROUP
from hazardlake.schemas import LISTING


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


# Quotes are doubled within quotes and a field may hold line breaks, as spreadsheets and
# other writers do. Null is an empty field, the empty text a pair of quotes.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# What the reader puts for a pair of quotes: were it the empty text, it would be taken for null.
_EMPTY = "\x01"


def read_csv(spark: SparkSession, path: str, schema: StructType, split: bool = False) -> DataFrame:
    """Columns by the names in the header, in the order of the schema; an absent one is null.

    By default the header of one file counts for all of them, and files are read whole, as a
    record may span lines. With ``split`` a record is one line: a large file is read by many
    tasks, and each file goes by its own header, whatever order or columns it has. The headers
    take a pass over the lines of the files' first blocks.
    """
    options = _CSV | {"emptyValue": _EMPTY}
    if split:
        return _split_csv(spark, path, schema, options)
    return _typed_csv(spark.read.options(**options, multiLine=True).csv(path), schema)


def _typed_csv(found: DataFrame, schema: StructType) -> DataFrame:
    def field(name: str) -> Column:
        if name not in found.columns:
            return F.lit(None).cast("string")
        text = F.col(f"`{name}`")
        return F.when(text == _EMPTY, "").otherwise(text)

    return found.select(*[field(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``(path, header)``: the first line of each CSV file below a folder."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    first = lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id())
    return first.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def _split_csv(spark: SparkSession, path: str, schema: StructType, options: dict) -> DataFrame:
    """Files of equal headers are one scan each, and the scans one table."""
    grouped = csv_headers(spark, path).groupBy("header").agg(F.collect_list("path").alias("paths"))
    # the driver lists the files of a scan in any case
    scans = []
    for header, paths in sorted((r.header, sorted(r.paths)) for r in grouped.collect()):
        names = next(csv.reader([header]), [])
        wanted = {f.name for f in schema.fields}
        # columns that nobody asks for may repeat or be nameless
        layout = StructType(
            [StructField(n if n in wanted and n not in names[:k] else f"_unread_{k}", StringType()) for k, n in enumerate(names)]
        )
        files = [unquote(p) for p in paths]
        scans.append(_typed_csv(spark.read.schema(layout).options(**options, enforceSchema=True).csv(files), schema))
    return reduce(DataFrame.unionByName, scans) if scans else empty_like(spark, schema)


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def rows_to_df(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """Small in-memory rows with an explicit schema; meant for fixtures."""
    return spark.createDataFrame(list(rows), schema)


def _path_missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def read_first_available(
    spark: SparkSession,
    readers: Sequence[Callable[[], DataFrame]],
    schema: StructType,
) -> DataFrame:
    """Result of the first reader whose path exists, an empty table when none does.

    Whether a path exists decides, not whether it has rows. Only missing paths are passed
    over; any other failure is raised.
    """
    for reader in readers:
        try:
            return reader()
        except AnalysisException as error:
            if not _path_missing(error):
                raise
    return empty_like(spark, schema)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
    fmt: str = "parquet",
    shares: int | None = None,
) -> None:
    """Write a table, by default in files of the size adaptive execution advises.

    Rebalancing on the partition columns gives each partition few files and splits a
    partition that holds most of the rows. ``files`` sets the number of files instead and
    is meant for small tables. ``shares`` is for rows that are planned without adaptive
    execution, where nothing is rebalanced: each partition is dealt to so many tasks at most.
    """
    if files is not None:
        out = df.coalesce(files)
    elif shares is not None:
        out = df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(shares)))
    else:
        out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = GROUP,
    fmt: str = "parquet",
    run: int | str | None = None,
    run_column: str = "run_id",
) -> None:
    """Add rows to a table partitioned by ``keys``.

    With ``run`` the append can be repeated: the rows of a run lie below ``<run_column>=<run>``,
    partitioned by the keys, and a run written again replaces all of its rows and no others,
    whatever groups it has this time. Readers see ``run_column`` as one more column, and a
    condition on a key opens only the files of its groups in every run. Without ``run`` every
    call adds its rows.
    """
    if run is None:
        write_table(df, path, mode="append", partition_by=keys, fmt=fmt)
    else:
        write_table(df, run_folder(path, run, run_column), partition_by=keys, fmt=fmt)


def run_folder(path: str, run: int | str, run_column: str = "run_id") -> str:
    """Folder of one run below a table."""
    if not re.fullmatch(r"[\w.-]+", str(run)):
        raise ValueError(f"not a name of a run: {run!r}")
    return f"{path.rstrip('/')}/{run_column}={run}"


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and length of the files below a folder.

    The content column is never selected, so no file is opened. A missing folder has no
    files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.option("pathGlobFilter", pattern).load(path)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return empty_like(spark, LISTING)
    return files.select("path", F.col("modificationTime").alias("modification_time"), "length")


def list_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The JSON snapshots below a folder, each with the folder it lies in as ``prefix``.

    A snapshot is a ``.json`` file, or a folder of that name with files in it, as the
    archive sink writes; such a folder counts once, with its latest modification.
    """
    snapshot = F.regexp_extract("path", r"^(.*\.json)(/[^/]*)?$", 1)
    files = list_files(spark, path).withColumn("path", snapshot).filter(F.col("path") != "")
    whole = files.groupBy("path").agg(
        F.max("modification_time").alias("modification_time"), F.sum("length").alias("length")
    )
    return whole.withColumn("prefix", F.regexp_extract("path", "^(.*)/[^/]*$", 1))


def _newest(files: DataFrame) -> str | None:
    """Path modified last; among equals the smallest."""
    row = files.orderBy(F.desc("modification_time"), "path").select("path").limit(1).first()
    return row.path if row else None


def read_latest_snapshot(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = True
) -> DataFrame:
    """The newest JSON snapshot of a folder; nothing else is read."""
    newest = _newest(list_snapshots(spark, path))
    if newest is None:
        return empty_like(spark, schema)
    return spark.read.schema(schema).option("multiLine", multi_line).json(newest)


def read_latest_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest CSV file of a folder."""
    newest = _newest(list_files(spark, path, "*.csv"))
    return empty_like(spark, schema) if newest is None else read_csv(spark, newest, schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark's file systems reach."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def archive_snapshot(
    df: DataFrame, path: str, kind: str, taken: datetime, batch: int = 0
) -> None:
    """Keep raw documents under ``<kind>_<yyyymmdd>_<hhmmss>_<batch>.json``, one per line.

    A line break inside a JSON document is only white space, so it becomes a blank. The
    same batch written again replaces itself.
    """
    target = f"{path}/{kind}_{taken:%Y%m%d_%H%M%S}_{batch}.json"
    line = F.regexp_replace("value", r"[\r\n]+", " ")
    df.select(line.alias("value")).write.mode("overwrite").text(target)


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Rewrite a table of many small files into a new folder with fewer, larger ones."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into a new folder")
    table = read_table(spark, source, fmt)
    if files is None and not partition_by:
        table = table.hint("rebalance")
    write_table(table, target, "errorifexists", partition_by, files, fmt)


#: Files below this size are worth putting together.
SMALL_FILE = 32 << 20


def small_partitions(
    spark: SparkSession, path: str, small: int = SMALL_FILE, fmt: str = "parquet"
) -> DataFrame:
    """``(folder, files, small_files)`` of the partitions that hold several small files."""
    files = list_files(spark, path, f"*.{fmt}").withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    sizes = files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") < small).alias("small_files")
    )
    return sizes.filter("small_files > 1")


def compact_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    small: int = SMALL_FILE,
    fmt: str = "parquet",
) -> list[str]:
    """Rewrite, in place, the partitions of a table that hold several small files; their folders.

    Only those partitions are read and replaced (dynamic partition overwrite), all others keep
    their files. ``partition_by`` names all partition columns in the order of the folders; their values
    are taken as text, so that ``01`` stays ``01``. The new files are complete before the old
    ones go; nobody should append to the same partitions meanwhile.
    """
    folders = sorted(r.folder for r in small_partitions(spark, path, small, fmt).collect())
    if folders:
        inferred = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(inferred)
        spark.conf.set(inferred, "false")
        try:
            rows = spark.read.format(fmt).option("basePath", path).load(folders)
        finally:
            spark.conf.set(inferred, before)
        writer = rows.hint("rebalance", *partition_by).write.format(fmt).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    return folders
