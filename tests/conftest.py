import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from brisa import spec as S  # noqa: E402
from brisa.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-01 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared / "scratch"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def distributed(spark):
    """Force the plans meant for large inputs."""
    spark.conf.set("brisa.directRows", "0")
    spark.conf.set("brisa.broadcastRows", "0")
    yield spark
    spark.conf.unset("brisa.directRows")
    spark.conf.unset("brisa.broadcastRows")


def raw_rows(shift=0.0, n=120):
    """A valid batch of hourly readings, as lists that tests may break."""
    start = dt.datetime(2016, 1, 1)
    return [
        {
            "datetime": start + dt.timedelta(hours=i),
            "station": "Aotizhongxin",
            "wd": "N",
            "pm25": 20.0 + shift + i % 8,
            "PM10": 40.0 + shift + i % 8,
            "SO2": 10.0 + i % 3,
            "NO2": 30.0 + i % 5,
            "CO": 800.0 + i % 20,
            "O3": 50.0 + i % 7,
            "TEMP": 15.0 + i % 4,
            "PRES": 1010.0 + i % 3,
            "DEWP": 8.0 + i % 3,
            "RAIN": 0.0,
            "WSPM": 2.0 + i % 2,
        }
        for i in range(n)
    ]


RAW = "datetime timestamp_ntz, station string, wd string, " + ", ".join(
    f"{c} double" for c in ("pm25", *S.MEASURES)
)


def frame(spark, rows):
    names = [c.split()[0] for c in RAW.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], RAW)


@pytest.fixture
def raw(spark):
    return frame(spark, raw_rows())


@pytest.fixture
def holdout(spark):
    """A processed batch: 60 winter and 60 summer rows, target 20..59."""
    df = spark.range(120).select(F.col("id").cast("int").alias("i"))
    constants = dict(
        PM10=40.0, SO2=10.0, NO2=30.0, CO=800.0, O3=50.0, TEMP=15.0, PRES=1010.0, DEWP=8.0, RAIN=0.0, WSPM=2.0
    )
    df = df.select(
        "i",
        F.lit("Aotizhongxin").alias("station"),
        F.lit("N").alias("wd"),
        F.when(F.col("i") < 60, "invierno").otherwise("verano").alias("temporada"),
        *[F.lit(v).alias(c) for c, v in constants.items()],
        *[F.lit(0).cast("tinyint").alias(f"{c}_era_nulo") for c in constants],
        (F.col("i") % 24).cast("smallint").alias("hora"),
        F.lit(0).cast("smallint").alias("dia_semana"),
        F.lit(7).cast("smallint").alias("mes"),
        (F.lit(20.0) + F.col("i") % 40).alias("pm25"),
    )
    return df


class Offset:
    """A model whose MAE is the offset it was given."""

    def __init__(self, offset):
        self.offset = offset

    def transform(self, df):
        return df.withColumn("prediction", F.col("pm25") + self.offset)
