"""Host-level quality rules: rule failures per host, shrunk by an empirical beta prior, joined back to documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import WORD, keep, text_or_empty, word_array

SYMBOLS = "#*$%&|<>"
#: A document fails with fewer words, or with more than this percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A host is dropped if its shrunk failure rate is above this.
HOST_LIMIT = 0.5


def _repeated_words(windows: Column) -> Column:
    """Words inside a window that occurs twice or more: sort (window, place), mark equal neighbours, and
    add up the distance of each marked place to the next one, three at most."""
    placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def marked(ordered: Column) -> Column:
        equal = F.filter(
            ordered,
            lambda x, i: F.coalesce(F.get(ordered, i - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["w"] == x["w"], F.lit(False)),
        )
        return F.array_sort(F.transform(equal, lambda x: x["i"]))

    # One-element arrays bind a value once inside an expression.
    bound = F.transform(F.array(placed), marked)
    steps = F.transform(
        bound,
        lambda at: F.aggregate(
            F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))),
            F.lit(0),
            lambda total, step: total + step,
        ),
    )
    return F.element_at(steps, 1)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the base measures of each text; NULL text has none of anything."""
    cut = docs.select("doc_id", "source", text_or_empty().alias("text")).withColumn("words", word_array(F.col("text")))
    n_words = F.size("words").cast("long")
    windows = F.when(
        F.size("words") >= 3,
        F.transform(
            F.slice("words", 1, F.size("words") - 2),
            lambda w, i: F.concat(w, F.lit(" "), F.get("words", i + 1), F.lit(" "), F.get("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    cut = cut.withColumn("windows", windows).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return cut.select(
        "doc_id",
        "source",
        n_words.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _repeated_words(F.col("windows"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )


@dataclass(frozen=True)
class BetaPrior:
    alpha: float
    beta: float


def beta_prior(hosts: DataFrame) -> BetaPrior:
    """Method of moments over the hosts' failure rates; one row reaches the driver.

    Without hosts, or where the rates do not vary, the strength is bounded to [1, 1000].
    """
    row = hosts.select((F.col("failed") / F.col("n")).alias("rate")).agg(F.avg("rate").alias("m"), F.var_pop("rate").alias("v")).first()
    mean = min(max(row["m"] if row["m"] is not None else 0.5, 1e-6), 1 - 1e-6)
    strength = min(max(mean * (1 - mean) / max(row["v"] or 0.0, 1e-9) - 1, 1.0), 1000.0)
    return BetaPrior(mean * strength, (1 - mean) * strength)


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n, failed, shrunk rate and whether the host stays; NULL is a host of its own."""
    hosts = keep(
        measured.groupBy(F.col("source").alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")),
        "rules-hosts",
    )
    prior = beta_prior(hosts)
    shrunk = (F.col("failed") + F.lit(prior.alpha)) / (F.col("n") + F.lit(prior.alpha + prior.beta))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("host_kept", F.col("shrunk_rate") <= limit)


def quality_rules(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, the base measures, base_failed, shrunk_rate and kept, one row per row of ``docs``.

    A document stays if it passes its own rules and its host (``source``) stays.  Reads doc_id, source
    and text only.  Failures are summed per host with partial aggregation, so a hot host is combined
    before the shuffle; verdicts are joined back null-safely to the narrow measures, not to the texts.
    """
    measured = keep(measures(docs), "rules-measures")
    verdicts = keep(host_verdicts(measured, limit), "rules-verdicts").select("host", "shrunk_rate", "host_kept")
    return (
        measured.join(verdicts, F.col("source").eqNullSafe(F.col("host")))
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
        .drop("source", "host", "host_kept")
    )
