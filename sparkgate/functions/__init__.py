"""Column-expression helpers (scalar and vector)."""

from .columns import (bool_text, elapsed_days, first_present, normalize_category,  # noqa: F401
                      normalize_key, percent_text, round_half_even, sentiment_ordinal,
                      stable_round, strip_lower, to_double,
                      to_timestamp_ntz)
from .vectors import argmax, l2_distance, sq_distance, standardize  # noqa: F401
