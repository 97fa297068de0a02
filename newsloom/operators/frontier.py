"""Which URLs to fetch: seeds, site selection and robots rules as table jobs."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import decoded, host_of


def seed_urls(sites: DataFrame) -> DataFrame:
    """Entry URLs of each site: base URL followed by each path, in path order."""
    return sites.select("source", "base_url", F.posexplode("paths").alias("pos", "path")).select(
        "source", "pos", "path", F.concat("base_url", "path").alias("url")
    )


def select_sites(sites: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(chosen sites, unknown names)`` for a table of wanted ``source`` names."""
    names = wanted.select("source").distinct()
    chosen = sites.join(names, "source", "left_semi")
    unknown = names.join(sites.select("source"), "source", "left_anti")
    return chosen, unknown


def _target(url) -> Column:
    """Decoded path, query and fragment without a trailing empty ``?`` or ``#``."""
    local = F.regexp_replace(decoded(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.regexp_replace(local, r"\??#?\z", "")


def robots_by_host(rules: DataFrame, agent: str) -> DataFrame:
    """One row per host: the rules that apply to ``agent``, in file order.

    The first group that names the agent (as a substring of its product token)
    counts; ``*`` is the default, first ``*`` group. A host's rules are one
    robots file, so the list per host is small.
    """
    token = agent.split("/")[0].lower()
    group = Window.partitionBy("host", "entry")
    is_default = F.max(F.col("agent") == "*").over(group)
    named = F.max(F.contains(F.lit(token), F.lower("agent"))).over(group)
    ranked = rules.withColumn("_default", is_default).withColumn("_named", named)
    first_named = F.min(F.when(F.col("_named") & ~F.col("_default"), F.col("entry")))
    first_default = F.min(F.when(F.col("_default"), F.col("entry")))
    per_host = ranked.groupBy("host").agg(
        F.coalesce(first_named, first_default).alias("_use"),
        F.collect_list(F.struct("entry", "pos", "allow", "prefix")).alias("_rules"),
    )
    mine = F.filter("_rules", lambda r: r["entry"] == F.col("_use"))
    return per_host.select(
        "host",
        F.transform(
            F.array_sort(mine),
            lambda r: F.struct(
                (r["allow"] | (r["prefix"] == "")).alias("allow"), _target(r["prefix"]).alias("prefix")
            ),
        ).alias("rules"),
    )


def robots_allowed(urls: DataFrame, rules: DataFrame, agent: str) -> DataFrame:
    """Add ``allowed``: the first rule whose prefix starts the URL decides.

    Prefixes are literal; no rule, no robots file or a URL without host means
    allowed. Each URL meets one row per host, so nothing is multiplied; a hot
    host is a skewed partition of the left side, which Spark splits at run time.
    """
    joined = urls.withColumn("host", host_of("url")).join(robots_by_host(rules, agent), "host", "left")
    local = _target("url")
    target = F.when(local == "", "/").otherwise(local)
    hit = F.filter("rules", lambda r: F.startswith(F.col("_target"), r["prefix"]))
    allowed = F.when(F.size(hit) > 0, F.element_at(hit, 1)["allow"]).otherwise(F.lit(True))
    return (
        joined.withColumn("_target", target)
        .withColumn("allowed", F.coalesce(allowed, F.lit(True)))
        .drop("_target", "rules")
    )
