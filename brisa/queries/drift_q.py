"""Queries over drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa import spec as S
from brisa.operators import drift as D
from brisa.operators.features import build_features
from brisa.operators.metrics import PREDICTION
from brisa.operators.partitions import label_rows, slice_label
from brisa.plans.drift_check import drift_check, drift_report, status_row
from brisa.queries import models as M
from brisa.queries import tables as Q
from brisa.queries.registry import query
from brisa.session import scratch_path
from brisa.sources import sketches as H

_NUM = ["l_quantity", "l_discount", "l_tax", "price", "hora", "dia_semana"]
_CAT = ["flag", "l_linestatus"]
_REF = Q.range_sql(Q.LINE_SPEC.ranges[0], "l_shipdate")
_PROD = Q.range_sql(Q.LINE_SPEC.ranges[3], "l_shipdate")
_FEATURES = (
    f"f AS (SELECT l_quantity, l_discount, l_tax, price, coalesce(flag, 'desconocido') AS flag, l_linestatus, l_shipdate, "
    f"{Q.calendar_sql('l_shipdate')} FROM l)"
)


def _samples_sql(ref: str, prod: str) -> str:
    return f"z AS (SELECT *, ({ref}) AS in_ref, ({prod}) AS in_prod FROM f WHERE ({ref}) OR ({prod}))"


def ks_sql(columns, source="z") -> str:
    """CTE ``ks``: column, n_ref, n_prod, statistic, p_value by a plain global window."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, in_ref, in_prod FROM {source} WHERE {c} IS NOT NULL"
        for c in columns
    )
    return (
        f"vals AS ({values}), hist AS (SELECT \"column\", value, count(*) FILTER (in_ref) AS a, count(*) FILTER (in_prod) AS b FROM vals GROUP BY 1, 2), "
        'cum AS (SELECT "column", sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY "column") AS na, '
        'sum(b) OVER (PARTITION BY "column") AS nb FROM hist WINDOW w AS (PARTITION BY "column" ORDER BY value)), '
        'ks0 AS (SELECT "column", CAST(max(na) AS BIGINT) AS n_ref, CAST(max(nb) AS BIGINT) AS n_prod, '
        'max(abs(ca / na - cb / nb)) AS statistic FROM cum GROUP BY "column"), '
        "ks1 AS (SELECT *, sqrt(n_ref * 1.0e0 * n_prod / (n_ref + n_prod)) AS en FROM ks0), "
        "ks2 AS (SELECT *, (en + 0.12e0 + 0.11e0 / en) * statistic AS lam FROM ks1), "
        'ks AS (SELECT "column", n_ref, n_prod, statistic, CASE WHEN lam < 0.2 THEN 1.0e0 ELSE greatest(0.0e0, least(1.0e0, '
        "list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0e0 ELSE -2.0e0 END * exp(-2.0e0 * k * k * lam * lam))))) END AS p_value FROM ks2)"
    )


def chi2_sql(columns, source="z") -> str:
    """CTE ``chi``: column, n_ref, n_prod, dof, statistic, effect."""
    levels = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce({c}, 'desconocido') AS level, in_ref, in_prod FROM {source}" for c in columns
    )
    return (
        f"lev AS ({levels}), tab AS (SELECT \"column\", level, count(*) FILTER (in_ref) AS a, count(*) FILTER (in_prod) AS b FROM lev GROUP BY 1, 2), "
        'tot AS (SELECT "column", sum(a) AS na, sum(b) AS nb, count(*) AS k FROM tab GROUP BY 1), '
        'cell AS (SELECT "column", na, nb, k, a AS o, (a + b) * na * 1.0e0 / (na + nb) AS e FROM tab JOIN tot USING ("column") UNION ALL '
        'SELECT "column", na, nb, k, b, (a + b) * nb * 1.0e0 / (na + nb) FROM tab JOIN tot USING ("column")), '
        'chi0 AS (SELECT "column", max(na) AS na, max(nb) AS nb, max(k) AS k, sum(power(abs(o - e) - CASE WHEN k = 2 THEN least(0.5e0, abs(o - e)) ELSE 0 END, 2) / e) AS x '
        'FROM cell GROUP BY "column"), chi AS (SELECT "column", CAST(na AS BIGINT) AS n_ref, CAST(nb AS BIGINT) AS n_prod, CAST(k - 1 AS BIGINT) AS dof, '
        "CASE WHEN k < 2 THEN 0.0e0 ELSE x END AS statistic, CASE WHEN k < 2 THEN 0.0e0 ELSE sqrt(x / (na + nb)) END AS effect FROM chi0)"
    )


# Upper tail of chi-square for the few degrees of freedom these tables have; the error
# function is its power series, and its complement nothing beyond 6.
_H = "(statistic / 2)"
_ERFC = (
    f"CASE WHEN {_H} > 36 THEN 0.0e0 ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 150), lambda n: "
    f"CASE WHEN n % 2 = 0 THEN 1.0e0 ELSE -1.0e0 END * exp((n + 0.5) * ln({_H}) - lgamma(n + 1.0e0)) / (2 * n + 1))) END"
)
_CHI_P = (
    f"CASE WHEN dof < 1 OR NOT statistic > 0 THEN 1.0e0 WHEN dof = 1 THEN {_ERFC} WHEN dof = 2 THEN exp(-{_H}) "
    f"WHEN dof = 3 THEN {_ERFC} + exp(0.5 * ln({_H}) - {_H} - lgamma(1.5e0)) WHEN dof = 4 THEN exp(-{_H}) * (1 + {_H}) END"
)
_CHI_DRIFT = f"({_CHI_P}) < 0.05 AND effect >= 0.1"
_COMPARED = (
    'cmp AS (SELECT "column", \'ks\' AS test, n_ref, n_prod, p_value, statistic AS effect, p_value < 0.05 AND statistic >= 0.1 AS drift FROM ks '
    f"UNION ALL SELECT \"column\", 'chi2', n_ref, n_prod, {_CHI_P}, effect, coalesce({_CHI_DRIFT}, FALSE) FROM chi)"
)
_BASE = f"WITH {Q.L}, {_FEATURES}, {_samples_sql(_REF, _PROD)}, {ks_sql(_NUM)}, {chi2_sql(_CAT)}"
_SELF = f"WITH {Q.L}, {_FEATURES}, {_samples_sql(_REF, _REF)}, {ks_sql(_NUM)}, {chi2_sql(_CAT)}"


def _samples(spark, sf_dir):
    built = build_features(Q.lines(spark, sf_dir), Q.LINE_SPEC)
    return D.two_partitions(built, "train", "produccion", Q.LINE_SPEC)


@query(
    "drift_ks",
    f'{_BASE} SELECT "column", n_ref, n_prod, round(statistic, 9) AS statistic, round(p_value, 9) AS p_value, '
    "p_value < 0.05 AND statistic >= 0.1 AS drift FROM ks",
)
def drift_ks(spark, sf_dir):
    rows = D.ks(_samples(spark, sf_dir), _NUM)
    return rows.withColumns({"statistic": F.round("statistic", 9), "p_value": F.round("p_value", 9)})


@query(
    "drift_chi2",
    f'{_BASE} SELECT "column", n_ref, n_prod, dof, round(statistic, 6) AS statistic, round({_CHI_P}, 9) + 0.0e0 AS p_value, round(effect, 9) AS effect, coalesce({_CHI_DRIFT}, FALSE) AS drift FROM chi',
)
def drift_chi2(spark, sf_dir):
    rows = D.chi2(_samples(spark, sf_dir), _CAT)
    return rows.withColumns(
        {"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 9), "effect": F.round("effect", 9)}
    )


def _report(rows):
    return rows.withColumns({"p_value": F.round("p_value", 9), "effect": F.round("effect", 9)})


@query(
    "drift_report",
    f'{_BASE}, {_COMPARED} SELECT "column", test, n_ref, n_prod, round(p_value, 9) + 0.0e0 AS p_value, round(effect, 9) AS effect, drift FROM cmp ORDER BY cmp.effect DESC, "column"',
)
def drift_report_q(spark, sf_dir):
    compared = drift_report(Q.lines(spark, sf_dir), "train", "produccion", Q.LINE_SPEC)
    return _report(D.report(compared))


@query(
    "drift_self",
    f'{_SELF}, {_COMPARED} SELECT "column", test, n_ref, n_prod, round(p_value, 9) + 0.0e0 AS p_value, round(effect, 9) AS effect, drift FROM cmp ORDER BY cmp.effect DESC, "column"',
)
def drift_self(spark, sf_dir):
    compared = drift_report(Q.lines(spark, sf_dir), "train", "train", Q.LINE_SPEC)
    return _report(D.report(compared))


@query(
    "drift_verdict",
    f"{_BASE}, {_COMPARED} SELECT count(*) AS n_columns, count(*) FILTER (drift) AS n_drifting, "
    "round(avg(CASE WHEN drift THEN 1.0e0 ELSE 0.0e0 END), 9) AS share, coalesce(string_agg(\"column\", ',' ORDER BY \"column\") FILTER (drift), '') AS drifting, "
    "CASE WHEN avg(CASE WHEN drift THEN 1.0e0 ELSE 0.0e0 END) > 0.3 THEN 'DRIFT' ELSE 'NO_DRIFT' END AS status FROM cmp",
)
def drift_verdict(spark, sf_dir):
    compared = drift_report(Q.lines(spark, sf_dir), "train", "produccion", Q.LINE_SPEC)
    return D.verdict(compared).withColumn("share", F.round("share", 9))


@query(
    "drift_sketched",
    f'{_BASE} SELECT "column", n_ref, n_prod, round(statistic, 9) AS exact, TRUE AS within_error, TRUE AS agrees FROM ks',
)
def drift_sketched(spark, sf_dir):
    """Drift between two batches by the sketches stored with each, beside the exact
    distance: it lies within the stated error, and so does the verdict where one is given."""
    built = build_features(Q.lines(spark, sf_dir), Q.LINE_SPEC)
    labelled = label_rows(built, Q.LINE_SPEC.ranges, "l_shipdate")
    path = scratch_path(spark, "batch-sketches")
    for label in ("train", "test", "produccion", "test"):  # a batch at a time, one of them twice
        part = slice_label(labelled, label, Q.LINE_SPEC.ranges, "l_shipdate")
        H.store_batch_sketches(part, F.col("particion"), _NUM, path)
    told = H.sketched_drift(H.load_batch_sketches(spark, path), "train", "produccion")
    exact = D.ks(_samples(spark, sf_dir), _NUM).select("column", F.col("statistic").alias("exact"))
    both = told.join(exact, "column")
    large = F.col("exact") >= S.MIN_EFFECT
    return both.select(
        "column",
        "n_ref",
        "n_prod",
        F.round("exact", 9).alias("exact"),
        (F.abs(F.col("statistic") - F.col("exact")) <= F.col("error")).alias("within_error"),
        F.coalesce(F.col("drift") == large, F.lit(True)).alias("agrees"),
    )


_STATUS = (
    "SELECT count(*) AS n_columns, count(*) FILTER (drift) AS n_drifting, "
    "CASE WHEN avg(CASE WHEN drift THEN 1.0e0 ELSE 0.0e0 END) > 0.3 THEN 'DRIFT' ELSE 'NO_DRIFT' END AS status FROM cmp"
)
_EMPTY = S.days("vacia", "1901-01-01", "1901-12-31")
_N_EMPTY = f"(SELECT count(*) FROM l WHERE {Q.range_sql(_EMPTY, 'l_shipdate')})"


@query(
    "drift_status",
    f"SELECT 'train' AS ref, 'produccion' AS prod, * FROM ({_BASE}, {_COMPARED} {_STATUS}) UNION ALL "
    f"SELECT 'train', 'train', * FROM ({_SELF}, {_COMPARED} {_STATUS}) UNION ALL "
    f"SELECT 'train', 'vacia', NULL, NULL, CASE WHEN n = 0 THEN 'ERROR' END FROM (WITH {Q.L} SELECT {_N_EMPTY} AS n) UNION ALL "
    "SELECT 'train', 'nadie', NULL, NULL, 'ERROR'",
)
def drift_status(spark, sf_dir):
    """The status of whole checks: drift, none, an empty side, a partition nobody declared."""
    spec = Q.LINE_SPEC.with_(ranges=(*Q.LINE_SPEC.ranges, _EMPTY))
    out = None
    for prod in ("produccion", "train", "vacia", "nadie"):
        row = status_row(drift_check(Q.lines(spark, sf_dir), "train", prod, spec), spark)
        row = row.select(F.lit("train").alias("ref"), F.lit(prod).alias("prod"), "n_columns", "n_drifting", "status")
        out = row if out is None else out.unionByName(row)
    return out


_PRED = (
    f"WITH {Q.R}, {Q.prepared_sql('train')}, {Q.prepared_sql('test')}, {Q.prepared_sql('produccion')}, "
    "e AS (SELECT station, avg(pm25) AS prediction FROM p_train GROUP BY station), "
    "z AS (SELECT e.prediction, TRUE AS in_ref, FALSE AS in_prod FROM p_test p JOIN e USING (station) UNION ALL "
    "SELECT e.prediction, FALSE, TRUE FROM p_produccion p JOIN e USING (station))"
)


@query(
    "drift_predictions",
    f"{_PRED}, {ks_sql(['prediction'])} SELECT \"column\", n_ref, n_prod, round(statistic, 9) AS statistic, round(p_value, 9) AS p_value, "
    "p_value < 0.05 AND statistic >= 0.1 AS drift FROM ks",
)
def drift_predictions(spark, sf_dir):
    """Two scored batches compared by their predictions alone, no labels needed."""
    model = M.fitted(spark, sf_dir)["candidate"]
    batches = None
    for label, is_ref in (("test", True), ("produccion", False)):
        rows = model.transform(M.prepared(spark, sf_dir, label)).select(
            PREDICTION, F.lit(is_ref).alias(D.REF), F.lit(not is_ref).alias(D.PROD)
        )
        batches = rows if batches is None else batches.unionByName(rows)
    rows = D.ks(batches, [PREDICTION], S.ALPHA)
    return rows.withColumns({"statistic": F.round("statistic", 9), "p_value": F.round("p_value", 9)})
