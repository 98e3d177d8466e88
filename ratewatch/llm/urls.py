"""Operator 2: URL filters by hash prefixes of host-suffix and path-prefix expressions.

A rule is an expression: a host and the start of a path. A URL's expressions are its
host's suffixes, at the label counts that rules have, joined to its path's prefixes,
at the lengths that rules have, so no rule that fits is missed and no URL is expanded
further than the rules reach. Expressions meet rules by the first bytes of their
SHA-256, the whole digests confirm, and the longest rule wins. DataFrame functions
only. Each distinct pair of host and path is judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.llm.common import split_join

#: Rules that may be broadcast; beyond that, they are joined by a shuffle.
BROADCAST_RULES = 100_000
#: Parts that an expression's URLs are dealt to in that shuffle: many URLs share an expression.
SALTS = 16
#: Hex digits of a short hash prefix.
PREFIX = 8


def rules_of(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table of ``host``, ``path`` and ``verdict`` from literals."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL column; both empty without ``://`` or for a null."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)"))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: str, path: str) -> Column:
    # A NUL, which no rule needs, keeps host and path apart.
    return F.sha2(F.concat(F.col(host), F.lit("\0"), F.col(path)).cast("binary"), 256)


def filtered(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    The rule of the most characters wins; equals are settled by the longer host,
    then in text order. ``rule`` is host and path together, null where none fits;
    the verdict is then ``default``. Rules with a null host or path are none. A
    null or odd URL has empty host and path. Rows are kept as they come, repeated
    or with a null id; further columns are not read.
    """
    host, path = host_and_path(url_col)
    rows = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    known = rules.where("host IS NOT NULL AND path IS NOT NULL").select("host", "path", "verdict").distinct()
    shape = known.agg(
        F.count("*").alias("n"),
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()  # at most one entry for each label count and path length that occurs
    judged = _judged(rows.select("host", "path").distinct(), known, shape)
    out = split_join(rows, judged, ["host", "path"], "left")
    verdict = F.coalesce("verdict", F.lit(default)).alias("verdict")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict)


def _judged(urls: DataFrame, known: DataFrame, shape) -> DataFrame:
    if not shape["n"]:
        none = F.lit(None).cast("string")
        return urls.select("host", "path", none.alias("rule"), none.alias("verdict"))
    hosts = [
        F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in sorted(shape["labels"])
    ]
    paths = [F.when(F.length("path") >= n, F.expr(f"left(path, {n})")) for n in sorted(shape["lengths"])]
    parts = urls.select("host", "path", F.explode(F.array_compact(F.array(*hosts))).alias("suffix"))
    parts = parts.select("*", F.explode(F.array_compact(F.array(*paths))).alias("start"))
    parts = parts.withColumn("digest", _digest("suffix", "start")).drop("suffix", "start")
    parts = parts.withColumn("short", F.substring("digest", 1, PREFIX))
    listed = known.select(
        _digest("host", "path").alias("full"), F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_size"), "verdict",
    ).withColumn("short", F.substring("full", 1, PREFIX))
    if shape["n"] <= BROADCAST_RULES:
        met = parts.join(F.broadcast(listed), "short")
    else:
        salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")
        met = parts.withColumn("salt", own).join(salted, ["short", "salt"])
    rank = F.struct(F.length("rule").alias("size"), "host_size", "rule", "verdict")
    best = met.where("digest = full").groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")
