"""Versions of a dataset: written beside each other, switched by one ledger event.

A version is a snapshot in a folder of its own, never written again. Readers follow the
ledger's pointer, which moves after the write has left its mark, so nobody sees a half
written dataset and a failed write changes nothing. With the pointer go the rows and the
hash sum of every month: they add up to the dataset's fingerprint, and two versions'
changed months are told apart without reading either.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions.values import row_hash
from brisa.operators.partitions import MONTH_FOLDER
from brisa.sources.ledger import Ledger, current_state
from brisa.sources.readings import load_snapshot, path_exists, write_snapshot

PRINTS = "month string, n_rows bigint, h decimal(38,0)"


def month_prints(snapshot: DataFrame) -> DataFrame:
    """(month, n_rows, h) of a loaded snapshot: rows and sum of row hashes of each month.
    The sums of all months are those of the whole; one aggregate, combined map-side."""
    columns = [c for c in snapshot.columns if c != MONTH_FOLDER]
    return snapshot.groupBy(F.col(MONTH_FOLDER).cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row_hash(columns).cast("decimal(38,0)")).cast("decimal(38,0)").alias("h")
    )


def merged_print(prints: DataFrame) -> DataFrame:
    """The fingerprint of the whole dataset, in ``readings.fingerprint``'s form."""
    total = prints.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("h"), F.lit(0)).alias("h")
    )
    text = F.concat_ws("-", F.col("n_rows").cast("string"), F.col("h").cast("string"))
    return total.select("n_rows", text.alias("fingerprint"))


def changed_months(before: DataFrame, after: DataFrame) -> DataFrame:
    """(month, status, n_before, n_after) of the months whose prints differ: ``added``,
    ``removed`` or ``changed``."""
    a = before.select("month", F.col("n_rows").alias("n_before"), F.col("h").alias("h_before"))
    b = after.select("month", F.col("n_rows").alias("n_after"), F.col("h").alias("h_after"))
    status = (
        F.when(F.col("n_before").isNull(), "added")
        .when(F.col("n_after").isNull(), "removed")
        .when((F.col("n_before") != F.col("n_after")) | (F.col("h_before") != F.col("h_after")), "changed")
    )
    both = a.join(b, "month", "full").withColumn("status", status).where("status IS NOT NULL")
    return both.select("month", "status", "n_before", "n_after")


def folder_marks(spark: SparkSession, path: str) -> DataFrame:
    """(month, mark) of a snapshot's folders, from names, sizes and times of their files
    alone: a month whose mark stands has not been written again."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    month = F.regexp_extract("path", f"{MONTH_FOLDER}=([^/]+)/", 1)
    one = F.xxhash64(F.regexp_extract("path", "[^/]+$", 0), "length", "modificationTime").cast("decimal(38,0)")
    marks = files.select(month.alias("month"), "length", one.alias("one")).where("month <> ''").groupBy("month")
    counted = marks.agg(F.count("*").alias("n"), F.sum("length").alias("b"), F.sum("one").cast("string").alias("s"))
    return counted.select("month", F.concat_ws("-", "n", "b", "s").alias("mark"))


def refreshed_prints(spark: SparkSession, path: str, known: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """Prints of a snapshot folder that others write to, as (month, n_rows, h, mark), and the
    months that were read for them: those whose files' mark is new against ``known``, an
    earlier result. Months are metadata: a row for each of them comes to the driver."""
    marks = folder_marks(spark, path)
    if known is None:
        known = spark.createDataFrame([], PRINTS + ", mark string")
    stale = marks.join(known, ["month", "mark"], "left_anti")
    months = sorted(r.month for r in stale.select("month").collect())
    kept = known.join(marks, ["month", "mark"], "left_semi").select("month", "n_rows", "h", "mark")
    if not months:
        return kept, months
    snapshot = spark.read.parquet(path)
    read = month_prints(snapshot.where(F.col(MONTH_FOLDER).isin(*months))).join(marks, "month")
    return kept.unionByName(read.select("month", "n_rows", "h", "mark")), months


class Versions:
    """The versions of one named dataset."""

    def __init__(self, spark: SparkSession, path: str, ledger: Ledger, name: str):
        self.spark, self.path, self.ledger, self.name = spark, path.rstrip("/"), ledger, name

    def _own(self) -> DataFrame:
        return self.ledger.events().where(F.col("subject") == self.name)

    def publish(self, df: DataFrame, time: str = S.TIME, facts: dict[str, str] | None = None) -> str:
        """Write the next version and point readers to it; returns its number.

        Where the write fails, the error is passed on and the pointer stays. Writers at
        the same time have folders of their own; the last to end is the one that counts.
        ``facts`` are kept as the version's provenance.
        """
        numbers = self._own().where("kind = 'snapshot'").agg(F.max(F.col("version").try_cast("bigint")).alias("v"))
        version = str((numbers.first().v or 0) + 1)
        target = f"{self.path}/v{version}-{uuid.uuid4().hex[:8]}"
        write_snapshot(df, target, time)
        if not path_exists(self.spark, target, finished=True):
            raise OSError(f"{target} was not finished")
        prints = month_prints(self.spark.read.parquet(target)).collect()  # a row for each month
        events = [(self.name, version, "month", f"{version}/{r.month}", f"{r.n_rows}-{r.h}") for r in prints]
        total = f"{sum(r.n_rows for r in prints)}-{sum(r.h for r in prints)}"
        told = {"path": target, "fingerprint": total, **(facts or {})}
        events += [(self.name, version, "provenance", f"{version}/{k}", v) for k, v in told.items()]
        # One file: readers see all of these events or none.
        self.ledger.append([*events, (self.name, version, "snapshot", "current", target)])
        return version

    def version(self) -> str | None:
        """Number of the version that readers see; None where there is none."""
        row = current_state(self._own(), "snapshot").first()
        return None if row is None else row.version

    def read(self, version: str | None = None) -> DataFrame | None:
        """A version's snapshot, by default the current one; None where there is none."""
        if version is None:
            row = current_state(self._own(), "snapshot").first()
            path = None if row is None else row.value
        else:
            path = self.provenance(version).get("path")
        return None if path is None else load_snapshot(self.spark, path)

    def roll_back(self, version: str) -> None:
        """Point readers to an earlier version."""
        path = self.provenance(version).get("path")
        if path is None:
            raise KeyError(f"{self.name} has no version {version!r}")
        self.ledger.append([(self.name, version, "snapshot", "current", path)])

    def provenance(self, version: str) -> dict[str, str]:
        state = current_state(self._own().where(F.col("version") == version), "provenance")
        return {r.key.split("/", 1)[1]: r.value for r in state.collect()}

    def prints(self, version: str) -> DataFrame:
        """(month, n_rows, h) as recorded when the version was written."""
        state = current_state(self._own().where(F.col("version") == version), "month")
        parts = F.split("value", "-", 2)
        return state.select(
            F.split("key", "/", 2)[1].alias("month"),
            parts[0].cast("bigint").alias("n_rows"),
            parts[1].cast("decimal(38,0)").alias("h"),
        )

    def changed(self, before: str, after: str) -> DataFrame:
        """Months that differ between two versions, from the ledger alone."""
        return changed_months(self.prints(before), self.prints(after))
