"""docsift - Spark-native document field extraction.

Public API::

    from docsift import extract, prepare_jobs, apply_rules, stats, KeyedCache, RuleSet, DEFAULT_RULES

See README.md for the three-level flow and the scale design.
"""

from docsift.operators import stats
from docsift.operators.engine import apply_rules, extractor_values, plan_table
from docsift.operators.extract import Extraction, extract, prepare_jobs, result_json, result_long
from docsift.operators.fallback import batched as batched_fallback
from docsift.operators.rules import DEFAULT as DEFAULT_RULES
from docsift.operators.rules import Alt, Extractor, Rule, RuleBank, RuleSet
from docsift.operators.workers import by_workers as worker_fallback
from docsift.sources.cache import KeyedCache
from docsift.sources.ledger import Ledger

__all__ = ["stats", "apply_rules", "extractor_values", "plan_table", "Extraction", "extract",
           "prepare_jobs", "result_json", "result_long", "batched_fallback", "worker_fallback", "KeyedCache", "Ledger", "DEFAULT_RULES",
           "Alt", "Extractor", "Rule", "RuleBank", "RuleSet"]
