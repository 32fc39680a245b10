"""Whole runs: extraction, models, audit."""

from counterfoil.plans.audit import report_findings
from counterfoil.plans.extraction import extract_feeds
from counterfoil.plans.models import build_models, derive_models

__all__ = ["build_models", "derive_models", "extract_feeds", "report_findings"]
