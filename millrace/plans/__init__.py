"""All registered queries."""

from millrace.plans import checks, cleaning, corpus, evaluation, features, monitoring, streams, tables
from millrace.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "checks", "cleaning", "corpus", "evaluation", "features", "monitoring", "streams", "tables"]
