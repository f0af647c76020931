"""Column functions; all compile to built-in Spark expressions."""

from daygrain.functions.labels import (
    anomaly_category,
    clean_label,
    decode_code,
    dry_spell_label,
    period_label,
    quartile_label,
    row_key,
    sigma_flag,
)
from daygrain.functions.numeric import flag, round_half_up

__all__ = [
    "anomaly_category",
    "clean_label",
    "decode_code",
    "dry_spell_label",
    "flag",
    "period_label",
    "quartile_label",
    "round_half_up",
    "row_key",
    "sigma_flag",
]
