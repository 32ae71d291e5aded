"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import pick

RULE_COLUMNS = "host string, path string, verdict string"
PREFIX = 8  # hex digits of the digest that the join compares


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(rules, RULE_COLUMNS)


def url_parts(url):
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    rest = F.when(
        url.contains("://"), F.regexp_replace(url, r"(?s)\A.*?://", "")
    ).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return lowered(host), path


def lowered(host):
    """A-Z lower-cased; other letters stay."""
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    A rule (``host``, ``path``, ``verdict``) fits its host and all subdomains if the URL's
    path starts with the rule's. The longest rule (host and path together) wins; of equally
    long ones the longer host, then ``block``. Without a rule the verdict is ``default``.

    Each URL is expanded into one expression per host suffix and per path prefix of a
    length that some rule has. Expressions meet rules by the first hex digits of their
    SHA-256, and the full digest decides. A null URL, or one without ``://``, has an empty
    host and path and takes the default. Repeated rows are judged alike and all kept;
    other columns of ``pages`` are ignored.

    The lengths of rule paths are gathered on the driver: no more than the longest path
    has characters. Rules are broadcast only if Spark finds them small; otherwise the join
    shuffles, and the expressions of a frequent host are split over tasks at run time.
    """
    rows = pick(pages, "page_id", "url").select("page_id", F.col("url").cast("string").alias("url"))
    host, path = url_parts(F.coalesce(F.col("url"), F.lit("")))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rules = rules.select(
        lowered(F.col("host")).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        "verdict",
    ).filter("rule_host IS NOT NULL AND verdict IS NOT NULL")
    lengths = sorted(
        r[0] for r in rules.select(F.length("rule_path")).distinct().collect()
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    sizes = F.array(*map(F.lit, lengths)) if lengths else F.expr("CAST(array() AS array<int>)")
    prefixes = F.transform(
        F.filter(sizes, lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    # The host ends at its first slash, so "host" + "\n" + "path" is unambiguous.
    spread = (
        rows.filter("host <> ''")
        .select("page_id", "url", F.explode(suffixes).alias("h"), prefixes.alias("ps"))
        .select("page_id", "url", "h", F.explode("ps").alias("p"))
        .select("page_id", "url", F.sha2(F.concat_ws("\n", "h", "p"), 256).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX))
    )
    keyed = rules.withColumn(
        "rule_digest", F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256)
    ).withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX))
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        "verdict",
    )
    best = (
        spread.join(keyed, F.col("prefix") == F.col("rule_prefix"))
        .filter("digest = rule_digest")
        .groupBy(F.col("page_id").alias("_id"), F.col("url").alias("_url"))
        .agg(F.max(order).alias("best"))
    )
    same = rows["page_id"].eqNullSafe(best["_id"]) & (rows["url"] == best["_url"])
    return rows.join(best, same, "left").select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
