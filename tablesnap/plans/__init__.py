"""Registered queries: every operator run over whole tables, each beside its plain SQL twin."""

from tablesnap.plans import admin, analysis, coercion, index, names, scans
from tablesnap.plans.common import Check

CHECKS: dict[str, Check] = {
    **scans.CHECKS,
    **coercion.CHECKS,
    **index.CHECKS,
    **admin.CHECKS,
    **names.CHECKS,
    **analysis.CHECKS,
}
