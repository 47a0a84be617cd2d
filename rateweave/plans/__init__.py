"""Composite analyses, their SQL spellings, source round trips, plan text."""

from rateweave.plans import analyses, roundtrips, sql
from rateweave.plans.inspect import plan_text

__all__ = ["analyses", "plan_text", "roundtrips", "sql"]
