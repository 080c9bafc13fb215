import pytest
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.operators import contract as K
from brisa.operators.features import build_features
from brisa.operators.prepare import clean
from tests.conftest import frame, raw_rows

AS_OF = "2020-01-01 00:00:00"


def broken(rows, spark, **options):
    df = frame(spark, rows)
    return {(b["rule"], b["column"]): b["violations"] for b in K.broken_rules(df, K.raw_contract(as_of=AS_OF), **options)}


@pytest.mark.parametrize("shift", [0, 5, 10])
def test_valid_batches_pass(spark, shift):
    df = frame(spark, raw_rows(shift))
    assert K.enforce(df, K.raw_contract(as_of=AS_OF)) is df


def test_value_out_of_range(spark):
    rows = raw_rows()
    rows[0]["pm25"] = 1200.0
    assert broken(rows, spark) == {("range", "pm25"): 1}


def test_dead_sensor(spark):
    rows = raw_rows()
    for r in rows[:48]:
        r["CO"] = None
    assert broken(rows, spark) == {("coverage", "CO"): 1}


def test_coverage_bound_is_inclusive(spark):
    rows = raw_rows()
    for r in rows[:36]:  # exactly 70 % left
        r["CO"] = None
    assert broken(rows, spark) == {}


def test_dew_point_above_temperature(spark):
    rows = raw_rows()
    rows[0]["DEWP"] = rows[0]["TEMP"] + 1
    assert broken(rows, spark) == {("dew_point", "TEMP,DEWP"): 1}


def test_repeated_key(spark):
    rows = raw_rows()
    rows[1]["datetime"] = rows[0]["datetime"]
    assert broken(rows, spark) == {("one_reading_per_key", "station,datetime"): 1}


def test_nulls_pass_range_and_membership(spark):
    rows = raw_rows()
    rows[0]["wd"] = rows[0]["PM10"] = None
    assert broken(rows, spark) == {}


def test_unknown_sector_missing_station_and_future(spark):
    rows = raw_rows()
    rows[0]["wd"] = "XX"
    rows[1]["station"] = None
    rows[2]["datetime"] = rows[2]["datetime"].replace(year=2030)
    assert set(broken(rows, spark)) == {
        ("member", "wd"),
        ("not_null", "station"),
        ("not_in_future", "datetime"),
    }


def test_small_and_constant_batch(spark):
    rows = raw_rows(n=99)
    for r in rows:
        r["pm25"] = 7.0
    assert set(broken(rows, spark)) == {("min_volume", "*"), ("varies", "pm25")}


def test_empty_batch_breaks_batch_rules_only(spark):
    found = broken([], spark)
    assert ("min_volume", "*") in found and ("varies", "pm25") in found
    assert all(rule in ("min_volume", "varies", "coverage") for rule, _ in found)


def test_violation_lists_all_rules(spark):
    rows = raw_rows()
    rows[0]["pm25"], rows[1]["CO"] = 1200.0, -1.0
    with pytest.raises(K.ContractViolation) as error:
        K.enforce(frame(spark, rows), K.raw_contract(as_of=AS_OF))
    assert {b["column"] for b in error.value.broken} == {"pm25", "CO"}


def test_fail_fast_stops_at_one(spark):
    rows = raw_rows()
    rows[0]["pm25"], rows[1]["CO"] = 1200.0, -1.0
    assert len(broken(rows, spark, lazy=False)) == 1
    assert broken(raw_rows(), spark, lazy=False) == {}


def test_processed_contract_skips_filled_dew_points(spark):
    rows = raw_rows()
    rows[0]["TEMP"], rows[0]["DEWP"] = None, 39.0  # median TEMP is below 39
    done = build_features(clean(frame(spark, rows)))
    assert K.broken_rules(done, K.processed_contract()) == []
    unflagged = done.withColumn("TEMP_era_nulo", F.lit(0).cast("tinyint"))
    assert [b["rule"] for b in K.broken_rules(unflagged, K.processed_contract())] == ["dew_point"]


def test_user_rule_and_partitions(spark, raw):
    calm = K.row_rule("calm", "WSPM", F.col("WSPM") > 2)
    by = K.by_partition(raw.withColumn("particion", F.lit("p")), [calm]).collect()
    assert {(r["rule"], r["violations"]) for r in by} == {("rows", 120), ("calm", 60)}


def test_contract_as_data():
    parts = K.contract_columns()
    assert parts["target"] == ["pm25"]
    assert parts["categorical_features"] == ["temporada", "station", "wd"]
    assert len(parts["numeric_features"]) == 13 and len(S.READINGS.features) == 16


def test_text_that_is_no_number_is_counted_and_nulled(spark):
    df = frame(spark, raw_rows()).withColumn("CO", F.col("CO").cast("string"))
    df = df.withColumn("CO", F.when(F.col("SO2") == 10, "n/a").otherwise(F.col("CO")))
    broken = K.broken_rules(df, K.coercion_contract())
    assert [(b["rule"], b["column"], b["violations"]) for b in broken] == [("coerce", "CO", 40)]
    typed = K.coerce_readings(df)
    assert dict(typed.dtypes)["CO"] == "double" and typed.filter("CO IS NULL").count() == 40
