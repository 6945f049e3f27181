"""Registered queries, grouped by area.  Importing this package fills the registry."""

from cohortlake.catalog import core, experiments, io, model, quality  # noqa: F401
