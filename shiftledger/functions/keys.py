"""Deterministic identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SHIFTS
from .text import is_blank


def uuid_digest(namespace: str | uuid.UUID, name: Column) -> Column:
    """SHA-1 of namespace and name in hex, which the UUID is cut from."""
    prefix = F.unhex(F.lit(uuid.UUID(str(namespace)).hex))
    return F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))


def uuid_text(digest: Column) -> Column:
    """Version 5 UUID of a digest; mentions the digest seven times."""
    # version digit 5; of the variant digit the two top bits are fixed to 10, the lower two stay
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def uuid_v5(namespace: str | uuid.UUID, name: Column) -> Column:
    """Name-based SHA-1 UUID (RFC 9562, version 5) built from JVM expressions only.

    The digest is bound as a lambda variable, so it is computed once.
    """
    return F.get(F.transform(F.array(uuid_digest(namespace, name)), uuid_text), F.lit(0))


def key_name(production_date: Column, shift: Column, line: Column) -> Column:
    """Name the business key is built from, NULL unless date, shift and line are all usable.

    A NULL date makes the concatenation NULL.
    """
    name = F.concat(production_date.cast("string"), F.lit("|"), shift, F.lit("|"), line)
    return F.when(shift.isin(*SHIFTS) & ~is_blank(line), name)


def shift_log_id(
    namespace: str | uuid.UUID,
    production_date: Column,
    shift: Column,
    line: Column,
) -> Column:
    """Business key of a shift log, NULL where the name is."""
    return uuid_v5(namespace, key_name(production_date, shift, line))
