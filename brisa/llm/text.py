"""Word expressions and scratch tables that the operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.session import scratch_path

#: Fixed pattern of a word: a run without space, tab, line breaks, form feeds.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARS = " \t\n\x0b\f\r"

#: Arrow batches carry whole texts, so their bytes are bounded as well as their rows.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


def settled(spark: SparkSession) -> SparkSession:
    """A session ready for these operators: the package is with the workers, and Arrow
    batches are small unless the session's owner chose a size."""
    ship_package(spark)
    for key, value in ARROW.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)
    return spark


def trim() -> None:
    """Give memory that a worker has freed back to the machine. Workers outlive tasks and
    serve one operator after the other, so what each left would add up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_held: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None]) -> None:
    """Of all operators only ``owner`` goes on to hold what it learnt in this worker; what
    another one left is dropped by the function that it named. Workers serve one operator
    after the other, and what each has learnt would add up."""
    for name in [n for n in _held if n != owner]:
        _held.pop(name)()
    _held[owner] = drop


def with_arrow(df: DataFrame, inputs: list[str], added: str, fn) -> DataFrame:
    """``df`` with further columns (``added`` is a schema of them) that ``fn`` makes from an
    iterator of lists of Arrow arrays, the columns ``inputs`` of a batch each: a list of
    arrays for every batch. Columns of the added names are replaced. Workers load no pandas
    for it, which an Arrow or pandas function of a column does."""
    new = T.StructType.fromDDL(added)
    kept = [c for c in df.columns if c not in new.names]
    schema = T.StructType([*[T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(kept)], *new])
    given = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    read = [F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs) if c not in kept]
    names = [f"c{kept.index(c)}" if c in kept else f"__in{i}" for i, c in enumerate(inputs)]
    width = len(kept)

    def mapped(batches):
        now = None

        def arrays():
            nonlocal now
            for now in batches:
                yield [now.column(n) for n in names]

        for columns in fn(arrays()):
            yield pa.RecordBatch.from_arrays([*[now.column(i) for i in range(width)], *columns], schema.names)

    found = df.select(*given, *read).mapInArrow(mapped, schema)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *new.names)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: the lineage is cut
    and a lost executor costs nothing that came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_mark(df: DataFrame) -> Column:
    """A hash of a whole row: rows that differ in any column (but maps, which have no
    hash) have different ones."""
    columns = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_GAP_CHARS))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, GAP))).cast("long")


def n_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
