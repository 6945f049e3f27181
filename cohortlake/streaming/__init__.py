"""Streaming operators: none.

The reference pipeline is bounded as-of batch work only (no watermark,
streaming window or stateful operator).  Incremental refresh of the windowed
features is covered in batch by the per-day partial aggregates
(``cohortlake.operators.asof``, A15/A16) stored and refreshed month by month
in ``cohortlake.plans.refresh``.
"""
