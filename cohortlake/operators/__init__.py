"""DataFrame -> DataFrame operators.

``quality`` (typing, rule-table profile/clean, treatment log), ``asof``
(windows, cohort reduction, mergeable partials), ``features`` (cohort
feature tables and their checks), ``joins`` (aggregate-then-join, fan-out,
validated one-to-one join), ``sampling``, ``reconcile`` and ``model``.
"""
