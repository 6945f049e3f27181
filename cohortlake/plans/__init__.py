"""Compositions of operators: lazy pipelines, written stages, experiments,
incremental refresh, measurement and the four batch jobs."""
