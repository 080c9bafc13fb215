"""Batch scoring: prepare a partition, resolve a model, score, store, summarize."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from brisa import spec as S
from brisa.operators.forest import Imputed
from brisa.operators.prepare import prepare_partition
from brisa.operators.profile import prediction_summary
from brisa.sources.ledger import Ledger
from brisa.sources.sinks import Trace, audit_rows, read_predictions, write_predictions


def new_batch_id(label: str) -> str:
    return f"{label}-{uuid.uuid4().hex[:8]}"


def batch_score(
    readings: DataFrame,
    label: str,
    ledger: Ledger,
    model: str,
    path: str,
    spec: S.ReadingSpec = S.READINGS,
    *,
    alias: str = "champion",
    batch_id: str | None = None,
    as_of: str | None = None,
    moment: dt.datetime | None = None,
    load: Callable[[str], object] = Imputed.load,
) -> tuple[str, DataFrame]:
    """Score every row of a partition; returns the batch id and its summary.

    The alias is resolved once, so the stored version is the one that scored.
    Running a batch id again replaces its rows. Alias ``candidate`` is a shadow
    run: same table, told apart by its alias column.
    """
    prepared = prepare_partition(readings, label, spec, as_of=as_of)
    version = ledger.version_of(model, alias)
    uri = ledger.uri_of(model, version)
    batch_id = batch_id or new_batch_id(label)
    moment = moment or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    trace = Trace(batch_id, label, model, version, alias, uri, moment)
    write_predictions(audit_rows(load(uri).transform(prepared), trace, spec), path)
    stored = read_predictions(readings.sparkSession, path, batch_id, spec)
    return batch_id, prediction_summary(stored, f"prediccion_{spec.target}")
