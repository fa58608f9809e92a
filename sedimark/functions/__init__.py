"""Column-level building blocks; everything here is a built-in expression, no Python runs per row."""

from sedimark.functions.casting import safe_cast
from sedimark.functions.clock import hour_of, weekday_of, weekend_flag
from sedimark.functions.hashing import below_fraction, label_of, portable_hash, weighted_label
from sedimark.functions.labels import condition_category, risk_level
from sedimark.functions.names import tidy_name, tidy_names
from sedimark.functions.text import normalized

__all__ = [
    "below_fraction", "condition_category", "hour_of", "label_of", "normalized", "portable_hash", "risk_level",
    "safe_cast", "tidy_name", "tidy_names", "weekday_of", "weekend_flag", "weighted_label",
]
