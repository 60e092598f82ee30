"""Guards for input paths and the header contract."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import OPTIONAL_COLUMNS, REQUIRED_COLUMNS, SOURCE_COLUMNS

# fixed values: the texts of the two contract errors
NO_HEADER = "CSV schema error: header row is missing or empty."
MISSING_COLUMNS = "CSV schema error: missing required columns:"


def check_header(columns: Sequence[str] | None) -> set[str]:
    """Check one header and return the optional columns it lacks.

    Names are compared exactly, case and white space included. Missing required columns are
    an error, unknown columns a warning; their values are not read.
    """
    if not columns:
        raise ValueError(NO_HEADER)
    found = set(columns)
    missing = sorted(set(REQUIRED_COLUMNS) - found)
    if missing:
        raise ValueError(f"{MISSING_COLUMNS} {missing}")
    unexpected = sorted(found - set(SOURCE_COLUMNS))
    if unexpected:
        warnings.warn(f"unexpected columns found: {unexpected}", stacklevel=2)
    return set(OPTIONAL_COLUMNS) - found


def literal_path(path: str) -> str:
    """A path whose pattern signs stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _pattern_regex(pattern: str) -> str:
    """What a path pattern matches, whatever scheme and host Spark puts in front."""
    pattern = re.sub(r"\A(\w+):/+", r"\1:/", pattern)
    parts, depth, at = [], 0, 0
    while at < len(pattern):
        sign = pattern[at]
        at += 1
        if sign == "\\" and at < len(pattern):
            parts.append(re.escape(pattern[at]))
            at += 1
        elif sign == "*":
            parts.append("[^/]*")
        elif sign == "?":
            parts.append("[^/]")
        elif sign == "[" and "]" in pattern[at:]:
            end = pattern.index("]", at)
            inner = pattern[at:end].replace("\\", "\\\\")
            parts.append(f"[^{inner[1:]}]" if inner[:1] in ("^", "!") else f"[{inner}]")
            at = end + 1
        elif sign == "{":
            parts.append("(?:")
            depth += 1
        elif sign == "}" and depth:
            parts.append(")")
            depth -= 1
        else:
            parts.append("|" if sign == "," and depth else re.escape(sign))
    body = "".join(parts)
    if re.match(r"\w+:/", pattern):
        return rf"\A{body}\z"
    return rf"\A(?:\w+:(?:/[^/]+)?)?{body}\z" if pattern.startswith("/") else rf"(?:\A|/){body}\z"


@dataclass(frozen=True)
class Inputs:
    """Patterns that name every input file once, one of the files, and all of them as a table."""

    patterns: list[str]
    first: str
    listing: DataFrame

    def files(self) -> list[str]:
        """All files as patterns; only for the few inputs that need their names on the driver."""
        return [literal_path(row.path) for row in self.listing.select("path").distinct().collect()]


def _listed(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """``path`` of all files with content behind patterns, by Spark's own listing; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return reader.load(list(patterns)).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"nothing found at {(error.getMessageParameters() or {}).get('path', list(patterns))}") from None


def _explain(spark: SparkSession, patterns: Sequence[str]) -> None:
    """Raise the error of the first thing behind the patterns that is no file Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for pattern in patterns:
        asked = hadoop.Path(pattern)
        for status in asked.getFileSystem(conf).globStatus(asked) or []:
            name = status.getPath().toString()
            if not status.isFile():
                raise ValueError(f"{name} is a folder, expected a file")
            if status.getPath().getName().startswith(("_", ".")):
                raise ValueError(f"Spark does not read files named like {name}")
            if status.getLen() == 0:
                raise ValueError(f"{NO_HEADER} {name}")


def input_files(spark: SparkSession, paths: Sequence[str]) -> Inputs:
    """Files behind paths or glob patterns, each named once.

    A path that exists is taken as it is, also with brackets in its name. Every file has to be
    a non-empty ``.csv``. Files are listed and tested by a Spark job; the driver asks for a path
    with pattern signs and for the number of matches of each pattern, never for a single file.
    """
    context = spark.sparkContext
    patterns, n_matches = [], 0
    for path in paths:
        if not path.lower().endswith(".csv"):
            raise ValueError(f"{path} does not end in .csv")
        if not re.search(r"[\\*?\[\]{}]", path):
            patterns.append(path)
            n_matches += 1
            continue
        asked = context._jvm.org.apache.hadoop.fs.Path(path)
        system = asked.getFileSystem(context._jsc.hadoopConfiguration())
        if system.exists(asked):
            patterns.append(literal_path(path))
            n_matches += 1
        else:
            patterns.append(path)
            n_matches += len(system.globStatus(asked) or [])
    listing = _listed(spark, patterns)
    named = F.regexp_replace("path", r"\A(\w+):/+", "$1:/")
    matches = named.rlike("|".join(map(_pattern_regex, patterns))) if len(patterns) <= 500 else F.lit(True)
    facts = listing.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("path").alias("n_files"),
        F.count_if(~matches).alias("n_within"),
        F.min("path").alias("first"),
    ).first()
    if facts.n_within or facts.n != n_matches:
        _explain(spark, patterns)
    if facts.first is None:
        raise ValueError(f"nothing found at {list(paths)}")
    found = Inputs(patterns, literal_path(facts.first), listing)
    # patterns that share files: each file is then named by itself
    return found if facts.n == facts.n_files == n_matches else Inputs(found.files(), found.first, listing)
