"""Cell-level helpers: coercion, sector names, records, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa import spec as S


def to_number(c: Column) -> Column:
    """Double, or null where the text is no number. NaN counts as missing."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def lost_in_cast(c: Column) -> Column:
    """True where a value was present but is no number."""
    return c.isNotNull() & to_number(c).isNull()


def nan_as_null(df: DataFrame, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """NaN means missing: null in the fractional columns (of those named)."""
    kinds = dict(df.dtypes)
    wanted = [c for c in (columns or df.columns) if kinds.get(c) in ("float", "double")]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in wanted}) if wanted else df


def coerce_numeric(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def normalize_sector(c: Column) -> Column:
    """Trimmed upper-case sector, null where it is none of the legal ones."""
    return normalize_level(c, S.SECTORS)


def normalize_level(c: Column, levels: tuple[str, ...]) -> Column:
    """Trimmed upper-case text, null where it is none of the legal levels."""
    name = F.upper(F.trim(c))
    return F.when(name.isin(*levels), name)


def known(c: Column) -> Column:
    """Categorical value with its nulls made a level of their own."""
    return F.coalesce(c, F.lit(S.UNKNOWN))


def feature_record(spec: S.ReadingSpec = S.READINGS) -> Column:
    """The feature columns of a row as one JSON record."""
    return F.to_json(F.struct(*[F.col(c) for c in spec.features]), {"ignoreNullFields": "false"})


def row_hash(columns: list[str] | tuple[str, ...]) -> Column:
    """First 60 bits of the MD5 of a row, as a bigint.

    Every value is written with its length before it, and null as a mark of its own,
    so no two rows are written alike.
    """

    def cell(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))

    return F.conv(F.substring(F.md5(F.concat(*[cell(c) for c in columns])), 1, 15), 16, 10).cast("bigint")


def sample_hash(key: list[Column], seed: int) -> Column:
    """MD5 text that orders rows at random but always the same for a seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key]))
