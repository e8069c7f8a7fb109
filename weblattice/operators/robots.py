"""Robots rules: parse robots.txt bodies to the rules that apply to one agent, and filter urls by them.

Follows the matching rules of Python's standard robots parser: the first named group that matches hides
the ``*`` group, and inside a group the first rule whose path is a prefix wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weblattice.functions.urls import host_key, robots_rule_path, robots_url_path, strip, unquote
from weblattice.runtime import materialize, new_folder

DEFAULT_USER_AGENT = "WebLatticeBot/1.0"

# Line ends that Python's splitlines() knows.
_LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"


def product_token(user_agent: str) -> str:
    return user_agent.split("/")[0].lower()


def robots_rules(robots: DataFrame, user_agent: str = DEFAULT_USER_AGENT) -> DataFrame:
    """``(host_key, agent, ord, allow, path)`` of the one agent group that applies to each host.

    Input is ``(host_key, status_code, body)``. Only a 200 with a body counts; every other host allows all.
    All windows share one shuffle on the host key, and a host has the lines of one body.
    """
    token = F.lit(product_token(user_agent))
    one_body = Window.partitionBy("host_key").orderBy("body")
    bodies = (
        robots.filter((F.col("status_code") == 200) & (F.coalesce("body", F.lit("")) != ""))
        .withColumn("_n", F.row_number().over(one_body)).filter("_n = 1")
    )
    raw = bodies.select("host_key", F.posexplode(F.split("body", _LINE_END)).alias("pos", "raw"))
    line = strip(F.regexp_replace("raw", r"(?s)#.*\z", ""))
    name = F.lower(strip(F.regexp_extract(line, r"(?s)\A([^:]*):", 1)))
    lines = raw.select(
        "host_key", "pos",
        F.when(F.col("raw") == "", "blank").when(name == "user-agent", "agent")
        .when(name.isin("allow", "disallow", "crawl-delay", "request-rate"), "rule").alias("kind"),
        name.alias("name"),
        unquote(strip(F.regexp_extract(line, r"(?s)\A[^:]*:(.*)\z", 1))).alias("value"),
    ).filter(F.col("kind").isNotNull())

    in_file = Window.partitionBy("host_key").orderBy("pos")
    so_far = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = (F.col("kind") == "agent") & (F.coalesce(F.lag("kind").over(in_file), F.lit("blank")) != "agent")
    grouped = (
        lines.withColumn("_opens", opens.cast("int"))
        .withColumn("grp", F.sum("_opens").over(so_far))
        # A rule counts only if an agent line came after the last blank line.
        .withColumn("_in_group", F.last(F.when(F.col("kind") != "rule", F.col("kind")), True).over(so_far) == "agent")
        .filter((F.col("kind") == "agent") | ((F.col("kind") == "rule") & F.coalesce("_in_group", F.lit(False))))
    )

    group = Window.partitionBy("host_key", "grp")
    agent = F.when(F.col("kind") == "agent", F.col("value"))
    flagged = grouped.withColumns({
        "_rules": F.max((F.col("kind") == "rule").cast("int")).over(group) == 1,
        "_any": F.coalesce(F.max((agent == "*").cast("int")).over(group), F.lit(0)) == 1,
        "_named": F.min(F.when(F.contains(token, F.lower(agent)), F.lower(agent))).over(group),
    })
    candidate = F.col("_rules") & (F.col("_any") | F.col("_named").isNotNull())
    chosen = F.min(F.when(candidate, F.struct(F.col("_any").alias("is_default"), "grp"))).over(
        Window.partitionBy("host_key")
    )
    rules = (
        flagged.withColumn("_chosen", chosen)
        .filter((F.col("grp") == F.col("_chosen.grp")) & F.col("name").isin("allow", "disallow"))
    )
    empty_disallow = (F.col("name") == "disallow") & (F.col("value") == "")
    return rules.select(
        "host_key",
        F.when(F.col("_any"), "*").otherwise(F.col("_named")).alias("agent"),
        F.row_number().over(in_file).alias("ord"),
        ((F.col("name") == "allow") | empty_disallow).alias("allow"),
        robots_rule_path(F.col("value")).alias("path"),
    )


def rules_by_host(rules: DataFrame) -> DataFrame:
    """The rules of each host as one array, in order. A host has the rules of one robots.txt."""
    return rules.groupBy("host_key").agg(F.sort_array(F.collect_list(F.struct("ord", "allow", "path"))).alias("rules"))


def with_robots(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``allowed``. A host without rules, or a url no rule matches, is allowed.

    The rules of a host travel as one array, so the join gives one row per url instead of one per url
    and rule. That table is written out first, unless ``rules`` comes as one (``rules_by_host``): the
    planner broadcasts it only if it is small, and else both sides of the join are plain shuffles, which
    the adaptive skew join splits at a hot host.
    """
    if "rules" not in rules.columns:
        rules = materialize(rules_by_host(rules), new_folder(urls.sparkSession, "robots"))
    per_host = rules.select(F.col("host_key").alias("_host"), F.col("rules").alias("_rules"))
    joined = urls.withColumn("_key", host_key(F.col(url))).join(per_host, F.col("_key") == F.col("_host"), "left")
    matching = F.filter("_rules", lambda rule: F.startswith(F.col("_path"), rule["path"]))
    return (
        joined.withColumn("_path", robots_url_path(F.col(url)))
        .withColumn("allowed", F.coalesce(F.get(matching, F.lit(0))["allow"], F.lit(True)))
        .drop("_key", "_host", "_rules", "_path")
    )


def robots_allowed(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    return with_robots(urls, rules, url).filter("allowed").drop("allowed")
