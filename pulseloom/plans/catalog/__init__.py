"""One module per operator family; importing them fills the registry."""

from pulseloom.plans.catalog import behavior, capture, ingest, kpi, models, quality, serving, streams, themes  # noqa: F401
