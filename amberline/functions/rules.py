"""The scoring rules, as named SQL predicates over the feature columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from amberline.functions.columns import text


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str


# The rule thresholds and the two scores.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("high_amount", "amount > 5000"),
    Rule("late_night", "hour IN (0, 1, 2, 3, 4, 5)"),
    Rule("risky_location", "location_risk = 1"),
    Rule("micro_amount", "amount < 1"),
    Rule("weekend_high_amount", "is_weekend = 1 AND amount > 2000"),
)
PROBABILITY_HIT = 0.8
PROBABILITY_CLEAR = 0.1
DECISION_THRESHOLD = 0.5


def any_rule(rules: Sequence[Rule]) -> str:
    """True when at least one rule holds; unknown when none holds but some cannot be decided."""
    return " OR ".join(f"({rule.predicate})" for rule in rules) or "false"


def rule_probability(rules: Sequence[Rule] = DEFAULT_RULES) -> str:
    return f"CASE WHEN {any_rule(rules)} THEN {PROBABILITY_HIT}D ELSE {PROBABILITY_CLEAR}D END"


def fired_names(rules: Sequence[Rule]) -> str:
    """Names of the rules that hold, in rule order."""
    named = ", ".join(f"CASE WHEN {rule.predicate} THEN {text(rule.name)} END" for rule in rules)
    return f"array_compact(array({named}))"
