"""Output column names. They are part of the interface, so they live in one place."""

from __future__ import annotations

from collections.abc import Sequence

# The naming conventions users rely on.
TARGET_ENC = "{col}_target_enc"
COUNT_ENC = "{col}_count_enc"
FREQ_ENC = "{col}_freq_enc"
WOE_ENC = "{col}_woe_enc"
GROUP_STAT = "{col}_{stat}_by_{group}"
GROUP_DIFF = "{col}_diff_from_{stat}_by_{group}"
GROUP_RATIO = "{col}_ratio_to_{stat}_by_{group}"
ROLLING = "{col}_rolling{window}_{stat}_by_{group}"
EXPANDING = "{col}_expanding_{stat}_by_{group}"
LAG = "{col}_lag{lag}_by_{group}"
GROUP_TARGET = "{target}_encoded_by_{group}"
# the second, prefix-first convention
PREFIX_STAT = "{group}_{col}_{stat}"
PREFIX_RATIO = "{col}_to_{group}_mean_ratio"
PREFIX_DIFF = "{col}_minus_{group}_mean"
DAYS_ROLLING = "{col}_{window}d_{stat}"
DAYS_SINCE = "days_since_last_{col}"
SERIES_LAG = "{col}_lag_{lag}"
SERIES_ROLLING = "{col}_rolling_{stat}_{window}"
SERIES_EXPANDING = "{col}_expanding_mean"


def group_name(keys: Sequence[str], prefix: str | None = None, suffix: str | None = None) -> str:
    return "_".join([*([prefix] if prefix else []), *keys, *([suffix] if suffix else [])])


def as_list(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def require(df, cols: Sequence[str]) -> None:
    """Raise ``ValueError`` for the first column that does not exist."""
    for col in cols:
        if col not in df.columns:
            raise ValueError(f"no column '{col}'; there are {', '.join(df.columns)}")
