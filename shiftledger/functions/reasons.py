"""Helpers for arrays of validation reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# a sign no reason text has
_BETWEEN = "\x1f"


def no_reasons() -> Column:
    return F.array().cast("array<string>")


def has_reason(reasons: Column, text: str) -> Column:
    """Membership test that treats a NULL array as empty, so it is never NULL."""
    return F.array_contains(F.coalesce(reasons, no_reasons()), text)


def assemble_reasons(conditions: Mapping[str, Column]) -> Column:
    """Sorted distinct array of the texts whose condition holds.

    The texts are known when the plan is built and each occurs once, so ordering them here
    makes every row's array sorted and distinct without a per-row sort. Rows without any
    finding, the great majority, skip the array expression. It is cut out of a joined text, which unlike
    ``array_compact`` stays in generated code.
    """
    if not conditions:
        return no_reasons()
    ordered = [F.when(conditions[text], F.lit(text)) for text in sorted(conditions)]
    if any(_BETWEEN in text for text in conditions):
        found = F.array_compact(F.array(*ordered))
    else:
        found = F.split(F.concat_ws(_BETWEEN, *ordered), _BETWEEN)
    return F.when(any_of(conditions), found).otherwise(no_reasons())


def any_of(conditions: Mapping[str, Column]) -> Column:
    """True where at least one condition holds; a NULL condition counts as false."""
    found = F.lit(False)
    for condition in conditions.values():
        found = found | F.coalesce(condition, F.lit(False))
    return found
