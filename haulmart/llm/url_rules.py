"""URL filters by hash prefix lookup, as safe-browsing lists do.

A URL gives the expressions of its host suffixes and path prefixes; a rule gives
the expression of its host and of its path up to the last slash. Both sides are
joined on the first four bytes of the expression's SHA-256, the full digest
confirms a hit, the rest of the rule's path is compared, and the longest rule
that fits has the say. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8
BROADCAST_RULES = 100_000
DEFAULT = "allow"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/ ? #``, the path from there up to ``? #``; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def digests_of_rules(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` with the digest of the host and the path up to its last slash.

    Rules without host or path are dropped; of equal rules a blocking one wins.
    """
    host, path = ascii_lower(rules["host"]), rules["path"]
    own = rules.where(host.isNotNull() & path.isNotNull()).groupBy(host.alias("rule_host"), path.alias("rule_path")).agg(
        F.max("verdict").alias("rule_verdict")
    )
    stem = F.regexp_extract("rule_path", r"^(.*/)?", 0)
    hashed = own.withColumn("stem", stem).withColumn("rule_digest", expression(F.col("rule_host"), F.col("stem")))
    return hashed.select(
        "rule_host",
        "rule_path",
        "rule_verdict",
        "rule_digest",
        F.substring("rule_digest", 1, PREFIX_HEX).alias("rule_prefix"),
        (F.length("rule_host") - F.length(F.replace("rule_host", F.lit("."), F.lit("")))).alias("dots"),
        (F.length("stem") - F.length(F.replace("stem", F.lit("/"), F.lit("")))).alias("slashes"),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A null URL or one without ``://`` has an empty host and path and, like any
    other that no rule fits, a null rule and the default verdict. Each distinct
    host and path is looked up once, so repeated URLs cost one lookup and rows
    with equal ids keep a row each. The number of expressions of a URL is bounded
    by the labels and the path depth that the rules have, whatever its length.
    Extra columns are not read. Rules are broadcast up to ``BROADCAST_RULES`` rows.
    """
    host, path = host_and_path(pages[url_col])
    own = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    listed = digests_of_rules(rules)
    shape = listed.agg(F.max("dots").alias("dots"), F.max("slashes").alias("slashes"), F.count("*").alias("n")).first()
    if not shape.n:
        return own.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    labels = F.split("host", r"\.")
    steps = F.split("path", "/")
    # The host itself has all labels; a suffix of k labels for each k up to the most that a rule has.
    suffixes = F.expr(
        f"transform(sequence(1, least(size(_labels), {shape.dots + 1})),"
        " k -> array_join(slice(_labels, size(_labels) - k + 1, k), '.'))"
    )
    prefixes = F.expr(
        f"transform(sequence(1, least(size(_steps), {shape.slashes + 1})),"
        " k -> if(k = 1, '', concat(array_join(slice(_steps, 1, k - 1), '/'), '/')))"
    )
    expanded = (
        own.select("host", "path")
        .distinct()
        .withColumn("_labels", labels)
        .withColumn("_steps", steps)
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", F.explode("prefixes").alias("stem"), "suffix")
        .select("host", "path", expression(F.col("suffix"), F.col("stem")).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )
    right = F.broadcast(listed) if shape.n <= BROADCAST_RULES else listed
    hits = expanded.join(right, F.col("prefix") == F.col("rule_prefix")).where(
        (F.col("digest") == F.col("rule_digest")) & F.expr("startswith(path, rule_path)")
    )
    rule = F.concat("rule_host", "rule_path")
    won = hits.groupBy("host", "path").agg(
        F.max_by(
            F.struct(rule.alias("rule"), F.col("rule_verdict").alias("verdict")),
            F.struct(F.length(rule), F.length("rule_host")),
        ).alias("won")
    )
    won = won.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "won")
    judged = own.join(won, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return judged.select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict")
    )
