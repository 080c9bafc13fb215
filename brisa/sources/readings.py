"""Reading raw files, snapshots, and content fingerprints."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import spec as S
from brisa.functions import calendar as C
from brisa.functions.values import nan_as_null, row_hash
from brisa.operators.partitions import MONTH_FOLDER

# --- fixed values -----------------------------------------------------------
# Columns of a raw file, in file order.
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("No", "year", "month", "day", "hour")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("PM2.5", "PM10", "SO2", "NO2", "CO", "O3", "TEMP", "PRES", "DEWP", "RAIN")
    ]
    + [
        T.StructField("wd", T.StringType()),
        T.StructField("WSPM", T.DoubleType()),
        T.StructField("station", T.StringType()),
    ]
)
RAW_GLOB = "PRSA_Data_*.csv"
# ----------------------------------------------------------------------------


#: Column of a raw line that does not fit, and the part of a file that must hold its header.
CORRUPT, UNREAD = "_corrupt_record", "_unread"
HEADER_BYTES = 1 << 16
_OPENED_AT_ONCE = 16


def csv_headers(spark: SparkSession, folder: str, glob: str = RAW_GLOB) -> dict[str, tuple[str, ...]]:
    """Column names of every matching file below a folder: path -> names.

    Files are listed by Spark, and of each one only the first line is read, over the
    file system that Spark has for it, compressed files included. That is one small read
    a file, and no data but the header comes to the driver.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    paths = [r.path for r in listed.load(folder).select("path").collect()]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(path: str) -> tuple[str, ...]:
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            opened = codec.createInputStream(stream) if codec is not None else stream
            text = bytes(opened.readNBytes(HEADER_BYTES)).decode("utf-8-sig", "replace")
        finally:
            stream.close()
        lines = text.splitlines()
        return tuple(c.strip() for c in next(csv.reader(lines[:1]), ()))

    with ThreadPoolExecutor(_OPENED_AT_ONCE) as pool:
        return dict(zip(paths, pool.map(head, paths), strict=True))


def checked_csv(
    spark: SparkSession, folder: str, schema: T.StructType = RAW_SCHEMA, glob: str = RAW_GLOB
) -> DataFrame:
    """Every row of every matching CSV below a folder, with ``file``, ``_corrupt_record`` (the
    raw line where it has more or fewer cells than the header or a cell that is no number,
    null where the row is sound) and ``_unread`` (the columns of such cells). ``NA`` and
    empty cells are null. One read of the data.

    Columns are found by the header of each file, whatever their order. A file that lacks
    one or has others is an error, and so is a folder without matching files; files of no
    bytes are passed over.
    """
    wanted = sorted(f.name for f in schema)
    orders: dict[tuple[str, ...], list[str]] = {}
    for path, names in csv_headers(spark, folder, glob).items():
        if sorted(names) != wanted:
            missing, other = sorted(set(wanted) - set(names)), sorted(set(names) - set(wanted))
            raise S.MissingColumns(f"{path}: missing columns {missing}, other columns {other}, header {list(names)}")
        orders.setdefault(names, []).append(path)
    if not orders:
        raise FileNotFoundError(f"no file like {glob} below {folder}")
    tables = []
    for order, paths in orders.items():
        # Without pruning of columns, as a row is only checked where all of it is read.
        reader = spark.read.schema(T.StructType([*[schema[c] for c in order], T.StructField(CORRUPT, T.StringType())]))
        reader = reader.options(header=True, nullValue="NA", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        reader = reader.option("columnPruning", False)
        if len(orders) == 1:
            found = reader.options(recursiveFileLookup=True, pathGlobFilter=glob).csv(folder)
        else:
            found = reader.csv(paths)
        kept = [F.col(f"`{f.name}`") for f in schema]
        texts = F.from_csv(CORRUPT, ", ".join(f"`{c}` string" for c in order), {"nullValue": "NA"})
        # A cell that could not be read is null in the row though its text is none.
        lost = [F.when(F.col(f"`{f.name}`").isNull() & texts.getField(f.name).isNotNull(), f.name) for f in schema]
        unread = F.when(F.col(CORRUPT).isNotNull(), F.array_compact(F.array(*lost)))
        file = F.col("_metadata.file_path").alias("file")
        tables.append(found.select(*kept, file, CORRUPT, unread.alias(UNREAD)))
    return reduce(DataFrame.unionByName, tables)


def sound_rows(checked: DataFrame) -> DataFrame:
    # Only cells that a query names are read as numbers, and a row is only known to be
    # sound when all of them are: the filter names every column.
    cells = [F.col(f"`{c}`").isNull().cast("int") for c in checked.columns if c not in ("file", CORRUPT, UNREAD)]
    return checked.where(F.col(CORRUPT).isNull() & (reduce(Column.__add__, cells) >= 0)).drop("file", CORRUPT, UNREAD)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Rows of ``checked_csv`` that do not fit: (file, line, reason). ``line`` is the raw
    text; the reason is ``short`` or ``long`` (too few or too many cells) or ``value:`` with
    the names of the columns, in order of the schema, whose cells could not be read."""
    width = len(checked.columns) - 3
    cells = F.length(F.regexp_replace(F.regexp_replace(CORRUPT, '"[^"]*"', ""), "[^,]", "")) + 1
    return checked.where(F.col(CORRUPT).isNotNull()).select(
        "file",
        F.col(CORRUPT).alias("line"),
        F.when(cells < width, "short")
        .when(cells > width, "long")
        .otherwise(F.concat(F.lit("value:"), F.array_join(UNREAD, ",")))
        .alias("reason"),
    )


def scan_csv(spark: SparkSession, folder: str, schema: T.StructType = RAW_SCHEMA, glob: str = RAW_GLOB) -> DataFrame:
    """The sound rows of every matching CSV below a folder as one table, in no order; the
    others are in ``scan_csv_rejects``. See ``checked_csv``."""
    return sound_rows(checked_csv(spark, folder, schema, glob))


def scan_csv_rejects(
    spark: SparkSession, folder: str, schema: T.StructType = RAW_SCHEMA, glob: str = RAW_GLOB
) -> DataFrame:
    """The rows that ``scan_csv`` leaves out: (file, line, reason)."""
    return rejected_rows(checked_csv(spark, folder, schema, glob))


def ingest_csv(
    spark: SparkSession, folder: str, path: str, schema: T.StructType = RAW_SCHEMA, glob: str = RAW_GLOB
) -> tuple[DataFrame, DataFrame]:
    """Raw files to a table below ``path``, read once: (sound rows, rejected rows)."""
    checked = checked_csv(spark, folder, schema, glob)
    split = checked.withColumn("sound", F.col(CORRUPT).isNull())
    split.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("sound").parquet(path)
    stored = spark.read.schema(split.schema).parquet(path)
    return sound_rows(stored.where("sound").drop("sound")), rejected_rows(stored.where("NOT sound").drop("sound"))


def readings_from_raw(raw: DataFrame) -> DataFrame:
    """Event time from its four columns, the dotted target renamed, NaN as null."""
    return nan_as_null(raw).withColumn(S.TIME, C.event_time("year", "month", "day", "hour")).withColumnRenamed(
        "PM2.5", S.TARGET
    )


def impossible_times(raw: DataFrame) -> DataFrame:
    """Rows whose four time columns make no timestamp: one row with their count."""
    parts = F.array(*[F.col(c) for c in ("year", "month", "day", "hour")])
    complete = ~F.exists(parts, lambda x: x.isNull())
    t = C.event_time("year", "month", "day", "hour")
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(complete & t.isNull()).alias("n_impossible")
    )


def path_exists(spark: SparkSession, path: str, finished: bool = False) -> bool:
    """Whether a path exists on any file system Spark knows.

    ``finished`` also asks for the mark that a completed write leaves.
    """
    if finished:
        path = f"{path}/_SUCCESS"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_snapshot(df: DataFrame, path: str, time: str = S.TIME) -> None:
    """Columnar snapshot, one folder per month; slices of a loaded snapshot name the
    folders they need, so that other months' files are never opened.

    Rows are rebalanced by month: small months share a task and large ones are
    split by size, so files come out at the advisory size and no task writes a
    whole month.
    """
    monthly = df.withColumn(MONTH_FOLDER, F.date_format(time, "yyyy-MM"))
    (
        monthly.hint("rebalance", F.col(MONTH_FOLDER))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # the whole snapshot, and its _SUCCESS mark
        .partitionBy(MONTH_FOLDER)
        .parquet(path)
    )


def load_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The snapshot, or None where there is no finished one."""
    return spark.read.parquet(path) if path_exists(spark, path, finished=True) else None


def ensure_snapshot(spark: SparkSession, path: str, build, time: str = S.TIME) -> DataFrame:
    """Read a snapshot, building and writing it first if it is not there."""
    found = load_snapshot(spark, path)
    if found is None:
        write_snapshot(build(), path, time)
        found = spark.read.parquet(path)
    return found


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: row count, sum of row hashes, and both as one text.

    Does not depend on the order of rows or files; one aggregate, no shuffle of
    rows.
    """
    columns = columns or df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(row_hash(columns).cast("decimal(38,0)")), F.lit(0)).alias("h"),
    )
    return counted.select(
        "n_rows", F.concat_ws("-", F.col("n_rows").cast("string"), F.col("h").cast("string")).alias("fingerprint")
    )
