"""Merchant credit-risk monitoring as Spark DataFrame plans."""

from riskwatch.plans.pipelines import PIPELINES, run
from riskwatch.session import build_session
from riskwatch.sources.tables import Sources

__all__ = ["PIPELINES", "Sources", "build_session", "run"]
