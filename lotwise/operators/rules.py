"""Ordered rule tables: the first rule that matches a row names its result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """All given conditions must hold.  ``has``/``lacks`` list text fragments per column,
    ``is_any`` lists whole values; everything is compared in upper case."""

    result: str | None
    has: dict[str, tuple[str, ...]] = field(default_factory=dict)
    lacks: dict[str, tuple[str, ...]] = field(default_factory=dict)
    is_any: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def condition(self, columns: dict[str, Column]) -> Column:
        test = F.lit(True)
        for name, values in self.is_any.items():
            test = test & columns[name].isin(*values)
        for name, fragments in self.has.items():
            for fragment in fragments:
                test = test & columns[name].contains(fragment)
        for name, fragments in self.lacks.items():
            for fragment in fragments:
                test = test & ~columns[name].contains(fragment)
        return F.coalesce(test, F.lit(False))


def first_match(rules: Sequence[Rule], columns: dict[str, Column], default: Column | None = None) -> Column:
    """Result of the first matching rule as one CASE expression: a rule list is small and
    fixed, so it needs no join and stays in codegen next to the scan."""
    upper = {name: F.upper(F.trim(col)) for name, col in columns.items()}
    chain = F
    for rule in rules:
        chain = chain.when(rule.condition(upper), F.lit(rule.result).cast("string"))
    return chain.otherwise(F.lit(None).cast("string") if default is None else default)


def rule_table(spark: SparkSession, rules: Sequence[Rule], on: str) -> DataFrame:
    """The rules as rows: key (a value of the column ``on`` that the rule asks for, NULL if it asks for none), priority
    (0 first), result, and tests (column, kind, values)."""
    rows = []
    for priority, rule in enumerate(rules):
        tests = [(c, "any", list(v)) for c, v in rule.is_any.items() if c != on]
        tests += [(c, "has", [v]) for c, vs in rule.has.items() for v in vs] + [(c, "lacks", [v]) for c, vs in rule.lacks.items() for v in vs]
        rows += [(key, priority, rule.result, tests) for key in rule.is_any.get(on, (None,))]
    return spark.createDataFrame(rows, "key string, priority int, result string, tests array<struct<column: string, kind: string, values: array<string>>>")


def matching_rules(df: DataFrame, rules: Sequence[Rule], columns: Sequence[str], on: str = "make") -> DataFrame:
    """The distinct ``columns`` of ``df`` with each rule that matches them: priority and result.

    Rules are found by equality of the column ``on`` (those that ask for none by a key of their own), and the rest of a rule is
    tested on the pairs: for long rule lists that change, where :func:`first_match` writes all of them into one expression.
    """
    table = rule_table(df.sparkSession, rules, on)
    upper = {c: F.upper(F.trim(F.col(c))) for c in columns}
    values = F.create_map(*[x for c, v in upper.items() for x in (F.lit(c), v)])
    rows = df.select(*columns).distinct().withColumn("_values", values).withColumn("_key", F.explode(F.array_distinct(F.array(upper[on], F.lit(None).cast("string")))))

    def holds(test: Column) -> Column:
        value = F.element_at("_values", test["column"])
        found = value.contains(test["values"][0])
        return F.when(test["kind"] == "any", F.array_contains(test["values"], value)).when(test["kind"] == "has", found).otherwise(~found)

    return rows.join(table, F.col("_key").eqNullSafe(F.col("key"))).where(F.forall("tests", holds)).select(*columns, "priority", "result")


def match_by_table(df: DataFrame, rules: Sequence[Rule], columns: Sequence[str], out: str, on: str = "make") -> DataFrame:
    """``df`` with the result of the first rule that matches, NULL without one: :func:`first_match` by a join."""
    best = matching_rules(df, rules, columns, on).groupBy(*[F.col(c).alias(f"_{c}") for c in columns]).agg(F.min_by("result", "priority").alias(out))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return df.join(best, same, "left").drop(*[f"_{c}" for c in columns])


def rule_report(df: DataFrame, rules: Sequence[Rule], columns: Sequence[str], on: str = "make") -> DataFrame:
    """priority, result, matched and won of every rule: the rows of ``df`` that it matches and those whose first it is.
    A rule that matches and never wins is shadowed by those before it."""
    counts = df.groupBy(*[F.col(c).alias(f"_{c}") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    matching = matching_rules(df, rules, columns, on).join(counts, same)
    won = matching.groupBy(*columns).agg(F.min("priority").alias("priority"), F.max("_n").alias("_n")).groupBy("priority").agg(F.sum("_n").alias("won"))
    matched = matching.groupBy("priority").agg(F.sum("_n").alias("matched"))
    every = rule_table(df.sparkSession, rules, on).select("priority", "result").distinct()
    counted = every.join(matched, "priority", "left").join(won, "priority", "left")
    return counted.select("priority", "result", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("matched", "won")])


def apply_if_found(found: Column, current: Column) -> Column:
    """A rule may only replace a value when it has an answer."""
    return F.coalesce(found, current)


def apply_if_missing(found: Column, current: Column, missing: str) -> Column:
    """A rule may only fill rows that are still unmatched."""
    still = current.isNull() | (F.lower(current) == missing)
    return F.when(still, F.coalesce(found, F.lit(missing))).otherwise(current)
