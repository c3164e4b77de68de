"""All queries over the shared tables, with the SQL that a second engine checks them against."""

from __future__ import annotations

from millrace.plans import dialog_plans, ranking_plans, report_plans, sampling_plans, source_plans, text_plans

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _plans in (source_plans, dialog_plans, text_plans, sampling_plans, report_plans, ranking_plans):
    QUERIES |= _plans.QUERIES
    ORACLES |= _plans.ORACLES
