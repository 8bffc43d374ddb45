"""Argument and column checks shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# The accepted resize strategies and the spellings of yes and no.
RESIZE_STRATEGIES = ("stretch", "keep_aspect_pad", "center_crop")
YES = ("1", "true", "yes", "y")
NO = ("0", "false", "no", "n")


def require_cols(df: DataFrame, names: Iterable[str], what: str = "manifest") -> None:
    """Fail with the sorted list of missing columns."""
    absent = sorted(set(names).difference(df.columns))
    if absent:
        raise ValueError(f"{what} lacks required columns: {', '.join(absent)}")


def require_partition_cols(df: DataFrame, names: Iterable[str]) -> None:
    """Fail when a partition column does not exist, naming those that do."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(
            f"unknown partition columns: {', '.join(absent)}; known columns: {', '.join(df.columns)}"
        )


def split_ratios(ratios) -> tuple[float, float, float]:
    """Three shares, each strictly between 0 and 1, that sum to 1."""
    if not isinstance(ratios, (list, tuple)) or len(ratios) != 3:
        raise ValueError("split ratios must be the three values train, val, test")
    shares = tuple(positive_float(value, "split ratio") for value in ratios)
    if any(share >= 1 for share in shares):
        raise ValueError(f"every split ratio must lie in (0, 1), got {shares}")
    if abs(sum(shares) - 1) > 1e-9:
        raise ValueError(f"split ratios must sum to 1, got {sum(shares):.6f}")
    return shares


def positive_int(value, name: str) -> int:
    number = _number(int, value, name)
    if number <= 0:
        raise ValueError(f"{name} must be above 0, got {number}")
    return number


def positive_float(value, name: str) -> float:
    number = _number(float, value, name)
    if not number > 0:
        raise ValueError(f"{name} must be above 0, got {number}")
    return number


def grey_level(value, name: str = "threshold") -> int:
    number = _number(int, value, name)
    if number not in range(256):
        raise ValueError(f"{name} must lie in 0..255, got {number}")
    return number


def resize_strategy(value: str) -> str:
    if value not in RESIZE_STRATEGIES:
        raise ValueError(f"resize strategy must be one of {RESIZE_STRATEGIES}, got {value!r}")
    return value


def column_list(value) -> list[str]:
    """Partition columns from a list or a comma-separated string; None means none."""
    if value is None:
        return []
    if isinstance(value, str):
        value = value.split(",")
    if not isinstance(value, (list, tuple)):
        raise ValueError("columns must be a list or a comma-separated string")
    return [name for name in (str(item).strip() for item in value) if name]


def yes_no(value, name: str, default: bool) -> bool:
    if value is None or isinstance(value, bool):
        return default if value is None else value
    word = str(value).strip().lower()
    if isinstance(value, str) and word in YES + NO:
        return word in YES
    raise ValueError(f"{name} must be yes or no, got {value!r}")


def name_or_none(value) -> str | None:
    """A given identifier without blanks around it; a blank one counts as absent."""
    return (str(value).strip() or None) if value is not None else None


def _number(kind, value, name: str):
    try:
        return kind(value)
    except (TypeError, ValueError) as error:
        raise ValueError(f"{name} is not a number: {value!r}") from error
