"""Text cleaning, label conforming and casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels the cleansing layer conforms to, by their upper-cased spelling.
CHANNEL_LABELS = {"ON-PREMISE": "On-Premise", "OFF-PREMISE": "Off-Premise"}
CATEGORY_LABELS = {"WINE": "Wine", "SPIRITS": "Spirits"}
CATEGORY_PATTERNS = {"%WINE%SPIRIT%": "Wine & Spirits"}
STATUS_LABELS = {"ACHIEVED": "Achieved", "AT RISK": "At Risk", "BEHIND": "Behind"}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def conform(
    value: Column | str,
    labels: Mapping[str, str],
    patterns: Mapping[str, str] | None = None,
) -> Column:
    """Map any spelling of a known label to its canonical form; pass other values through trimmed.

    ``labels`` is matched on the trimmed upper-case text, ``patterns`` are LIKE patterns on the
    same text and are tried after the exact labels.
    """
    trimmed = F.trim(as_column(value))
    folded = F.upper(trimmed)
    result = trimmed
    for pattern, label in reversed((patterns or {}).items()):
        result = F.when(folded.like(pattern), F.lit(label)).otherwise(result)
    for spelling, label in reversed(labels.items()):
        result = F.when(folded == spelling, F.lit(label)).otherwise(result)
    return result


def strict_cast(value: Column | str, data_type: str) -> Column:
    """Cast that fails the job on bad text, whatever the session's ANSI setting is."""
    source = as_column(value)
    text = F.trim(source)
    complaint = F.concat(F.lit(f"cannot cast to {data_type}: "), source)
    return F.coalesce(
        text.try_cast(data_type),
        F.when(source.isNotNull(), F.raise_error(complaint).cast(data_type)),
    )


def safe_cast(value: Column | str, data_type: str) -> Column:
    """Cast that turns bad text into NULL."""
    return F.trim(as_column(value)).try_cast(data_type)


def text_to_flag(value: Column | str, default: bool = False) -> Column:
    """'1'/'0', any other whole number, or 'true'/'false' to boolean; NULL and blank take the default."""
    text = F.lower(F.trim(as_column(value)))
    return (
        F.when(text.isNull() | (text == ""), F.lit(default))
        .when(text.isin("true", "false"), text == "true")
        .otherwise(strict_cast(text, "int") != 0)
    )


def threshold_label(
    value: Column | str, cutpoints: Sequence[tuple[object, str]], otherwise: str
) -> Column:
    """Label of the first cutpoint that ``value`` reaches, in the order given (NULL: otherwise)."""
    measured = as_column(value)
    result = F.lit(otherwise)
    for cutpoint, label in reversed(list(cutpoints)):
        result = F.when(measured >= F.lit(cutpoint), F.lit(label)).otherwise(result)
    return result


def ceiling_label(
    value: Column | str,
    ceilings: Sequence[tuple[object, str]],
    otherwise: str,
    inclusive: bool = True,
) -> Column:
    """Label of the first ceiling ``value`` stays under (or at, when inclusive)."""
    measured = as_column(value)
    result = F.lit(otherwise)
    for ceiling, label in reversed(list(ceilings)):
        under = measured <= F.lit(ceiling) if inclusive else measured < F.lit(ceiling)
        result = F.when(under, F.lit(label)).otherwise(result)
    return result


def rank_of_label(value: Column | str, order: Sequence[str]) -> Column:
    """1-based position of a label in ``order``; labels not listed come last."""
    label = as_column(value)
    result = F.lit(len(order) + 1)
    for position in range(len(order), 0, -1):
        result = F.when(label == order[position - 1], F.lit(position)).otherwise(result)
    return result
