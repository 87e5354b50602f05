"""Data-quality rules: declared families that compile to DataFrame plans, the catalog, and the runner."""

from .families import CHECKS, FAMILIES, RuleSpec
from .fuse import compile_rule, plan_checks
from .runner import RunResult, run_rules

__all__ = ["CHECKS", "FAMILIES", "RuleSpec", "RunResult", "compile_rule", "plan_checks", "run_rules"]
