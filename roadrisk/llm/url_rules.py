"""URL filters by host and path rules, matched through short hash prefixes.

A rule fits its host and all hosts below it where the URL's path starts with the rule's.  Every URL is expanded into the
expressions that a rule's folder can have: each host suffix with each path prefix that ends in ``/``, no more labels and
no deeper than the rules go.  Expressions and the folders of rules meet on the first four bytes of their SHA-256; a meeting
counts when the full digest of the URL's part as long as the rule is that of the rule.  The longest rule wins.

The rules join as a table, so their number is not bounded: a small list is broadcast by its size, a long one is shuffled,
and adaptive execution splits the URLs of a common suffix.  Only distinct URLs are expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8  # hex digits of the digest on which URLs and rules meet
ALLOW, BLOCK = "allow", "block"
# The rules of the query: host, path, verdict.
RULES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW),
         ("com", "/de/", BLOCK))
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _times(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _prefix(expression: Column) -> Column:
    return F.substring(F.sha2(expression, 256), 1, PREFIX_DIGITS)


def listed(rules: DataFrame) -> DataFrame:
    """Rules by their text with prefix and digest.  The text of a rule given twice blocks if one of them does."""
    rules = rules.where("host IS NOT NULL AND verdict IS NOT NULL").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    folder = F.concat("host", F.regexp_extract("path", r"(?s)^.*/", 0))
    return rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        _prefix(folder).alias("prefix"), F.sha2(F.concat("host", "path"), 256).alias("digest"),
        F.concat("host", "path").alias("rule"), F.length("path").alias("path_length"),
        F.length("host").alias("host_length"), (_times(F.col("host"), ".") + 1).alias("labels"),
        _times(F.col("path"), "/").alias("depth"), "verdict")


def expressions(urls: DataFrame, labels: int, depth: int) -> DataFrame:
    """Per row with host and path its host suffixes of up to ``labels`` labels, each with its folders up to ``depth``."""
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.lit(labels), _times(F.col("host"), ".") + 1)),
                           lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    folders = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(depth), _times(F.col("path"), "/"))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/"))))
    return (urls.withColumn("suffix", F.explode(suffixes)).withColumn("folder", F.explode(folders))
            .withColumn("prefix", _prefix(F.concat("suffix", "folder"))))


def verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per distinct url of a column ``url`` with a fitting rule: the winning ``rule`` and its ``verdict``."""
    rules = listed(rules)
    most = rules.agg(F.max("labels"), F.max("depth")).first()
    parts = urls.select("url").distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    part = F.concat("suffix", F.substring(F.col("path"), F.lit(1), F.col("path_length")))
    return (expressions(parts, most[0] or 0, most[1] or 0)
            .join(rules.withColumnRenamed("host_length", "longest_host"), "prefix")
            .where(F.sha2(part, 256) == F.col("digest"))
            .groupBy("url").agg(F.max(F.struct(F.length("rule").alias("length"), "longest_host", "verdict", "rule")).alias("best"))
            .select("url", "best.rule", "best.verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """Every row of ``pages`` (page_id, url) with its host, path, winning rule and verdict.

    ``rules`` has host, path and verdict (allow or block).  The longest rule (characters of host and path together) wins,
    among those as long the one with the longer host, so a tie needs the same rule twice, and then block wins.  A page
    without a fitting rule gets no rule and the ``default`` verdict.  A null url and one without ``://`` have empty host
    and path, which only a rule of an empty host can fit.  Rules without host or verdict are ignored, a rule without path
    fits every path.  Repeated rows each give a row; very long URLs are expanded no further than the rules go; other
    columns of ``pages`` are ignored; an empty table gives no rows, and no rules leave every page to the default.
    """
    keyed = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    return keyed.join(verdicts(keyed, rules), "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))
