"""Queries over the driver's tables; importing the package registers them all."""

from . import analysis, modelling, pipelines, queries, repertoire, reports, sequences, summaries, tables  # noqa: F401
