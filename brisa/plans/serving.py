"""Serving arriving readings with the champion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from brisa import spec as S
from brisa.operators.forest import Imputed
from brisa.sources.ledger import Ledger, RegistryUnavailable, UnknownAlias
from brisa.streaming.jobs import NoModel, score_stream_with


def serve_champion(
    records: DataFrame,
    text: str,
    ledger: Ledger,
    model: str,
    out: str,
    spec: S.ReadingSpec = S.READINGS,
    *,
    load: Callable[[str], object] = Imputed.load,
    keep: list[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a stream with the champion of the moment; never with a candidate.

    The alias is resolved for every micro-batch, and its version is stored with every row:
    a new champion scores from the next batch on, without a restart. A version is loaded
    once. Without a champion the query does not start; while the registry cannot be read,
    the last champion goes on.
    """
    loaded: dict[str, object] = {}

    def resolve() -> tuple[str, object]:
        try:
            version = ledger.version_of(model, "champion")
            if version not in loaded:
                champion = load(ledger.uri_of(model, version))
                loaded.clear()
                loaded[version] = champion
        except RegistryUnavailable:
            if not loaded:
                raise
        return next(iter(loaded.items()))

    try:
        resolve()
    except UnknownAlias as error:
        raise NoModel(f"{model} has no champion") from error
    return score_stream_with(records, text, resolve, out, spec, keep, trigger)
