"""Record validation, business key and the split by validity."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions import assemble_reasons
from ..functions.keys import key_name, uuid_digest, uuid_text
from ..functions.reasons import any_of
from ..schemas import PRODUCTION_DATE_INVALID
from .duplicates import flag_duplicates
from .normalize import normalize_records
from .rules import RULES


def validate(flagged: DataFrame, rules: Mapping[str, Callable[[], Column]] = RULES) -> DataFrame:
    """Add ``is_valid`` and ``invalid_reason`` to normalised, duplicate-flagged records."""
    typed_date = isinstance(flagged.schema["production_date"].dataType, DateType)
    conditions = {
        text: rule()
        for text, rule in rules.items()
        if not (typed_date and text == PRODUCTION_DATE_INVALID)
    }
    return flagged.withColumns(
        {
            "is_valid": ~any_of(conditions),
            "invalid_reason": assemble_reasons(conditions),
        }
    )


def validate_records(
    raw: DataFrame,
    namespace: str | uuid.UUID,
    rules: Mapping[str, Callable[[], Column]] = RULES,
    **duplicate_options,
) -> DataFrame:
    """Raw records to validated records with their business key.

    The duplicate flag looks at raw text only, so its shuffle, the only one, comes first and
    carries the raw columns alone; everything after it is a narrow projection.
    """
    flagged = flag_duplicates(raw, **duplicate_options)
    return add_shift_log_id(validate(normalize_records(flagged), rules), namespace)


def add_shift_log_id(df: DataFrame, namespace: str | uuid.UUID) -> DataFrame:
    """Add the business key, which does not depend on validity.

    The digest gets a column of its own: Spark keeps the two projections apart because the
    second one mentions it several times, and both stay inside generated code.
    """
    name = key_name(F.col("production_date"), F.col("shift_normalized"), F.col("line_normalized"))
    return (
        df.withColumn("_digest", uuid_digest(namespace, name))
        .withColumn("shift_log_id", uuid_text(F.col("_digest")))
        .drop("_digest")
    )


def split_by_validity(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid records; a filter each, so both push down to a stored table."""
    valid = F.col("is_valid").eqNullSafe(True)
    return validated.where(valid), validated.where(~valid)
