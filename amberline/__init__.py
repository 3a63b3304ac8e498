"""Card-transaction scoring, alerting and reporting as Spark DataFrame transforms.

Every transform takes and returns a DataFrame, uses built-in expressions only and
works on batch and streaming frames alike unless its docstring says otherwise.
"""

from amberline.operators.decode import parse_transactions, to_messages
from amberline.operators.features import engineer_features
from amberline.operators.scoring import score, score_ensemble, score_model, score_rules
from amberline.session import build_session

__all__ = [
    "build_session",
    "engineer_features",
    "parse_transactions",
    "score",
    "score_ensemble",
    "score_model",
    "score_rules",
    "to_messages",
]
