"""The jobs as queries, with their SQL."""

from __future__ import annotations

from jobs import cohort_table, sequence_cache

QUERIES = {f.__name__: f for f in (cohort_table.job1_cohort_table, sequence_cache.job2_sequence_cache)}
ORACLES = {"job1_cohort_table": cohort_table.ORACLE, "job2_sequence_cache": sequence_cache.ORACLE}
