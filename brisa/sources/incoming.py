"""Readings that arrive as JSON text: a closed schema, valid rows or quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions.values import normalize_level, to_number

MAX_ENTITY_LENGTH = 80


def check_incoming(
    df: DataFrame, text: str, spec: S.ReadingSpec = S.READINGS
) -> DataFrame:
    """Parse a JSON column and list the rules it breaks in ``reasons``.

    Every field is required, ranges are the contract's, text is trimmed, and a
    field the schema does not know is an error. Values are read as text first, so
    a number sent as text still counts. Other columns are kept.
    """
    # Each step is generated from a one-element array: the optimizer does not merge
    # a generator into later filters, so text is parsed and cast once per row.
    others = df.drop(spec.entity, *spec.required)
    parsed = others.select("*", _once(F.from_json(F.col(text), "map<string,string>")).alias("__f"))

    def field(c: str) -> Column:
        return F.col("__f")[c]

    def name(c: str) -> Column:
        text = F.trim(field(c))
        return F.when(F.length(text).between(1, MAX_ENTITY_LENGTH), text)

    needed = tuple(dict.fromkeys((spec.time, spec.entity, *spec.required)))
    levels = {c: spec.levels[c] for c in spec.categoricals if c in spec.levels}
    typed = {  # casts ignore blanks around a value by themselves
        spec.time: field(spec.time).try_cast("timestamp_ntz"),
        **{c: name(c) for c in (spec.entity, *spec.categoricals)},
        **{c: normalize_level(field(c), legal) for c, legal in levels.items()},
        **{c: to_number(field(c)) for c in spec.measures},
    }
    cells = F.struct(*[typed[c].alias(c) for c in needed])
    out = parsed.select("*", F.inline(F.array(cells)))
    allowed = F.array(*[F.lit(c) for c in needed])
    unknown = F.array_sort(F.array_except(F.map_keys("__f"), allowed))
    problems = [
        F.when(F.col("__f").isNull(), F.lit("malformed")),
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown:"), F.array_join(unknown, ","))),
    ]
    for c in needed:
        problems.append(F.when(F.col("__f").isNotNull() & F.col(c).isNull(), F.lit(f"bad:{c}")))
    for c in spec.measures:
        if c in spec.limits:
            problems.append(F.when(~F.col(c).between(*spec.limits[c]), F.lit(f"range:{c}")))
    reasons = F.filter(F.array(*problems), lambda x: x.isNotNull())
    return out.select("*", _once(reasons).alias("reasons")).drop("__f")


def _once(c: Column) -> Column:
    return F.explode(F.array(c))


def split_incoming(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without reasons, and quarantined rows with them."""
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    return valid, checked.filter(F.size("reasons") > 0)


def store_incoming(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write both kinds in one pass, valid rows and quarantine in folders of their own."""
    marked = checked.withColumn("valid", F.size("reasons") == 0)
    marked.write.mode("overwrite").partitionBy("valid").parquet(path)
    stored = checked.sparkSession.read.schema(marked.schema).parquet(path)
    valid = stored.filter(F.col("valid")).drop("valid", "reasons")
    return valid, stored.filter(~F.col("valid")).drop("valid")
