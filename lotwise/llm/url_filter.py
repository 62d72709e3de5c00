"""URL filters: fixed rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: n-gram lengths, hashed width, and the most labelled URLs that the classifier is fitted on.
LENGTHS, WIDTH, LABELLED = (3, 4, 5), 1 << 14, 4096


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, _, path = text.partition("/")
    return Rule(verdict, host, "/" + path)


RULES = (
    rule("allow", "org/"), rule("block", "example.org/es/"), rule("block", "example.org/en/1"),
    rule("allow", "com/fr/"), rule("block", "com/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered, and path; both empty for NULL or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits the host or one of its subdomains and starts the path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> Column:
    """All n-grams of a marked text; ^ and $ stand for its ends."""
    ended = F.concat(F.lit("^"), text, F.lit("$"))

    def of_length(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(ended) - n + 1, F.lit(1)))
        grams = F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(ended, i, F.lit(n))))
        return F.when(F.length(ended) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of_length(n) for n in LENGTHS])


def _features(df: DataFrame) -> DataFrame:
    df = df.withColumn("grams", F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p")))
    return HashingTF(numFeatures=WIDTH, binary=True, inputCol="grams", outputCol="features").transform(df).drop("grams")


def labelled_urls(pages: DataFrame, most: int = LABELLED) -> DataFrame:
    """host, path, verdict of at most ``most`` URLs that a rule decides: the bounded labelled table.

    It takes the distinct (host, path) with the smallest hashes, half per verdict, so that it does not
    depend on the order of the rows.
    """
    known = pages.where("rule_verdict is not null").select("host", "path", F.col("rule_verdict").alias("verdict")).distinct()
    by_hash = [F.xxhash64("host", "path"), "host", "path"]
    halves = [known.where(F.col("verdict") == v).orderBy(*by_hash).limit(most // 2) for v in ("allow", "block")]
    return halves[0].unionByName(halves[1])


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability (NULL where a rule decides), a row per page.

    Reads page_id and url only.  ``labelled`` (host, path, verdict) defaults to ``labelled_urls``.  With
    labels of one kind only that verdict is given to the rest; without labels it is "allow".  NULL or
    unparsable URLs have empty host and path and are judged like any other.  The model is ``WIDTH``
    weights whatever the number of pages; the pages are scored in one pass without a shuffle.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", name).withColumn("rule_verdict", verdict)
    # One partition, at most LABELLED rows: sums run in one order, so the weights repeat exactly.
    table = keep((labelled if labelled is not None else labelled_urls(parsed)).orderBy("host", "path").coalesce(1), "url-labels")
    kinds = [r["verdict"] for r in table.select("verdict").distinct().orderBy("verdict").limit(2).collect()]
    if len(kinds) < 2:
        only = kinds[0] if kinds else "allow"
        scored = parsed.withColumn("block_probability", F.lit(float(only == "block")))
    else:
        train = _features(table).withColumn("label", (F.col("verdict") == "block").cast("double")).select("features", "label")
        model = LogisticRegression(maxIter=60, regParam=1e-3, standardization=False).fit(train)
        scored = model.transform(_features(parsed)).withColumn("block_probability", vector_to_array("probability")[1])
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("block_probability")).alias("block_probability"),
    )
