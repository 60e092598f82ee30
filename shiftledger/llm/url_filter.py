"""URL rules and host reputation by empirical Bayes, in DataFrame functions only.

The reputation of a host is the rate of bad pages among its labelled ones, shrunk towards its
registered domain, that one towards its suffix, and that one towards the whole. On each level the
rates of the groups are taken as beta distributed around the parent's posterior mean, with a
strength estimated by moments from all groups of the level. A host is blocked if the lower bound of
its posterior rate lies above ``max_bad``.

A null url, or one without ``://``, has empty host and path and is judged as the host ``''``. Pages
and labels may hold nulls and repeated rows; repeated labels count as often as they occur. Hosts
without labels inherit from their domain, suffix or the whole. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: (verdict, host and path), as ``host/path``; the longest fitting rule wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")
MAX_BAD = 0.35
Z = 1.2815515655446004
MOST_STRENGTH = 1000.0
LEAST_STRENGTH = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct ``rule, verdict`` of the longest fitting rule, null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = rule.partition("/")
        of_host = (host == domain) | F.endswith(host, F.lit("." + domain))
        fits = of_host & F.startswith(path, F.lit(slash + rest))
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix, without user names, ports and a last dot."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:\d*)?$", "")
    labels = F.split(name, r"\.")
    two = F.substring_index(name, ".", -2)
    long = two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(F.size(labels) < 2, name).when(long, two).otherwise(F.substring_index(name, ".", -1))
    return F.when(long, F.substring_index(name, ".", -3)).otherwise(two), suffix


def _shrunk(groups: DataFrame, key: str, parent: DataFrame | None, up: str, root: float) -> DataFrame:
    """Posterior of the bad rate for each group: ``key, rate, weight``."""
    if parent is None:
        rows = groups.withColumn("prior", F.lit(root))
    else:
        rows = groups.join(parent.select(up, F.col("rate").alias("prior")), up)
    spread = F.col("prior") * (1 - F.col("prior"))
    square = F.pow(F.col("bad") / F.col("n") - F.col("prior"), F.lit(2)) * F.col("n") / spread
    got = rows.agg(F.sum(square).alias("s"), F.count("*").alias("g"), F.sum("n").alias("n")).first()
    excess, room = (got.s or 0.0) - got.g, (got.n or 0) - got.g
    rho = excess / room if room > 0 else 0.0
    strength = 1 / rho - 1 if rho > 0 else MOST_STRENGTH
    strength = min(MOST_STRENGTH, max(LEAST_STRENGTH, strength))
    keep = [c for c in groups.columns if c not in ("n", "bad")]
    return rows.select(
        *keep,
        ((F.col("prior") * strength + F.col("bad")) / (strength + F.col("n"))).alias("rate"),
        (F.col("n") + strength).alias("weight"),
        F.lit(strength).alias("strength"),
    )


def host_reputation(labelled: DataFrame) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """Posteriors by level from rows of ``host, bad`` (boolean, null: no label), and what unseen ones get.

    Three numbers a level reach the driver. The tables are staged; each has one row per name.
    """
    domain, suffix = _levels(F.col("host"))
    hosts = stage(
        labelled.where("bad IS NOT NULL")
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("bigint")).alias("bad"))
        .withColumn("domain", domain)
        .withColumn("suffix", suffix),
        "hosts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    root = ((total.bad or 0) + 1) / ((total.n or 0) + 2)
    add = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    by_suffix = stage(_shrunk(hosts.groupBy("suffix").agg(*add), "suffix", None, "", root), "suffixes")
    by_domain = stage(
        _shrunk(hosts.groupBy("domain", "suffix").agg(*add), "domain", by_suffix, "suffix", root), "domains"
    )
    by_host = stage(_shrunk(hosts.drop("suffix"), "host", by_domain, "domain", root), "hosts")

    def prior(df: DataFrame) -> float:
        row = df.select("strength").first()
        # a level without any label knows next to nothing
        return row.strength if row else LEAST_STRENGTH

    strengths = {"host": prior(by_host), "domain": prior(by_domain), "suffix": prior(by_suffix)}
    return {"host": by_host, "domain": by_domain, "suffix": by_suffix}, {"root": root, **strengths}


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    max_bad: float = MAX_BAD,
    z: float = Z,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate, bound`` for every row of ``pages``.

    ``outcomes`` has ``page_id`` and ``bad`` (boolean). ``rules`` is a short list of settings.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    labelled = parsed.join(outcomes.select("page_id", "bad"), "page_id").select("host", "bad")
    levels, prior = host_reputation(labelled)
    domain, suffix = _levels(F.col("host"))

    def level(name: str) -> DataFrame:
        return levels[name].select(name, F.col("rate").alias(f"{name}_rate"), F.col("weight").alias(f"{name}_weight"))

    hosts = stage(
        parsed.select("host").distinct().withColumn("domain", domain).withColumn("suffix", suffix)
        .join(level("host"), "host", "left")
        .join(level("domain"), "domain", "left")
        .join(level("suffix"), "suffix", "left")
        .select(
            "host",
            F.coalesce("host_rate", "domain_rate", "suffix_rate", F.lit(prior["root"])).alias("bad_rate"),
            F.coalesce("host_weight", F.lit(prior["host"])).alias("weight"),
        ),
        "host-verdicts",
    )
    bound = F.col("bad_rate") - z * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("weight") + 1))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    return (
        parsed.join(hosts, "host")
        .withColumn("bound", bound)
        .withColumn("fits", rule)
        .select(
            "page_id", "host", "path", F.col("fits.rule").alias("rule"),
            F.coalesce(
                F.col("fits.verdict"), F.when(F.col("bound") > max_bad, "block").otherwise("allow")
            ).alias("verdict"),
            "bad_rate", "bound",
        )
    )
