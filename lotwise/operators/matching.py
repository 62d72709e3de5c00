"""Record matching, credit splitting and exclusion of rows already reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digits_only, drop_quotes
from ..session import written
from .measures import row_nonnull

# A shared value whose referrals and customers make more than this many pairs per row takes a second key.
PAIRS_PER_ROW = 32
MATCH_LABELS = {"email_match": "Email_match", "phone_match": "Phone_match", "name_match": "name_match"}


def _text(col: str) -> Column:
    return F.nullif(F.upper(F.trim(F.col(col))), F.lit(""))


def match_people(
    form: DataFrame, customers: DataFrame, form_id: str = "form_id", pairs_per_row: int = PAIRS_PER_ROW
) -> DataFrame:
    """Customers of the form's market that agree with a referral in two of e-mail, phone, name.

    E-mail and phone agree when equal, the name when first and last name both occur in the
    customer's.  Two agreements always include an equal e-mail or phone, so both sides are
    turned into (market, kind, value) rows and meet in one equality join; no pair is tried on
    names alone.  An empty probe agrees with nothing.

    The referrals and customers of each value are counted.  Where their product exceeds ``pairs_per_row``
    for each of the rows (a switchboard number, a placeholder address, on either side or both), the value
    alone would emit a product of rows, so it takes part in two narrower joins instead: on e-mail and phone
    together, and on the value with names that agree (:func:`_agreeing_names`).  Every pair of those is an answer,
    emitted once per value and join, and all other values emit at most ``pairs_per_row`` pairs a row.  The
    result does not depend on ``pairs_per_row``.

    ``form``: form_id, market_id, first_name, last_name, email, phone.
    ``customers``: cust_no, market_id, first_name, last_name, email, phone.
    """
    return label_matches(flag_matches(form, customers, form_id, pairs_per_row))


def flag_matches(
    form: DataFrame, customers: DataFrame, form_id: str = "form_id", pairs_per_row: int = PAIRS_PER_ROW
) -> DataFrame:
    """The rows of :func:`match_people` with flags for labels, which are smaller to shuffle."""
    agree = lambda test: F.coalesce(test, F.lit(False))
    flags = candidate_pairs(form, customers, form_id, pairs_per_row).select(
        "form_id", "cust_no", "market",
        agree(F.col("f_email") == F.col("c_email")).alias("email_match"),
        agree(F.col("f_phone") == F.col("c_phone")).alias("phone_match"),
        agree(F.col("c_first").contains(F.col("f_first")) & F.col("c_last").contains(F.col("f_last"))).alias("name_match"),
    )
    # Rows of either side may repeat; distinct runs on answers alone, as flags.
    return flags.filter(sum(F.col(flag).cast("int") for flag in MATCH_LABELS) >= 2).distinct()


def label_matches(flagged: DataFrame) -> DataFrame:
    """Flags of :func:`flag_matches` as the labels of a report, NULL where a respect does not agree."""
    return flagged.withColumns({flag: F.when(F.col(flag), label) for flag, label in MATCH_LABELS.items()})


def candidate_pairs(form: DataFrame, customers: DataFrame, form_id: str, pairs_per_row: int) -> DataFrame:
    """Pairs of a referral and a customer with an equal e-mail or phone: all of them, but of hot values the answers only.

    A pair that is equal in both values is met under its e-mail alone.  Both sides are stored as one row per person, which
    becomes two values when it is read.  These files are compressed and their rows multiply, so their size tells the
    planner little: their joins are sorted, never broadcast through the driver.  The hot values are stored as hashes, whose file
    has their true size; a hash that two values share makes both hot, which changes no result.
    """
    probe = form.select(
        F.col(form_id).alias("form_id"),
        F.left(F.col("market_id"), F.lit(4)).alias("market"),
        F.nullif(drop_quotes(_text("first_name")), F.lit("")).alias("f_first"),
        F.nullif(drop_quotes(_text("last_name")), F.lit("")).alias("f_last"),
        _text("email").alias("f_email"),
        F.nullif(digits_only(F.col("phone")), F.lit("")).alias("f_phone"),
    )
    known = customers.select(
        "cust_no",
        F.col("market_id").alias("market"),
        _text("first_name").alias("c_first"),
        _text("last_name").alias("c_last"),
        _text("email").alias("c_email"),
        F.nullif(F.trim(F.col("phone")), F.lit("")).alias("c_phone"),
    )
    # Both are read for the counts and for each join.
    probes = _by_value(written(probe, "referrals"), "f_email", "f_phone", "f_other")
    values = _by_value(written(known, "customers"), "c_email", "c_phone", "c_other")
    hot = written(hot_values(probes, values, ["_hash"], pairs_per_row), "hot-values")
    part = lambda df, how: df.join(hot, "_hash", how).drop("_hash")
    same_other = F.coalesce(F.col("f_other") == F.col("c_other"), F.lit(False))
    plain = part(probes, "left_anti").join(_sorted(part(values, "left_anti")), VALUE_KEY)
    plain = plain.filter(~(same_other & (F.col("kind") == "phone")))
    hot_probes, hot_known = part(probes, "left_semi"), part(values, "left_semi")
    by_email = F.col("kind") == "email"
    by_both = hot_probes.filter(by_email).withColumn("_other", F.col("f_other")).join(
        _sorted(hot_known.filter(by_email).withColumn("_other", F.col("c_other"))), [*VALUE_KEY, "_other"]
    )
    names = _agreeing_names(hot_probes, hot_known)
    by_name = hot_probes.join(_sorted(names), [*VALUE_KEY, "f_first", "f_last"]).join(
        _sorted(hot_known), [*VALUE_KEY, "c_first", "c_last"]
    )
    pairs = plain.unionByName(by_both.drop("_other")).unionByName(by_name.filter(~same_other))
    of = lambda kind, other: F.when(F.col("kind") == kind, F.col("value")).otherwise(F.col(other))
    return pairs.select(
        "form_id", "cust_no", "market", "f_first", "f_last", "c_first", "c_last",
        of("email", "f_other").alias("f_email"), of("phone", "f_other").alias("f_phone"),
        of("email", "c_other").alias("c_email"), of("phone", "c_other").alias("c_phone"),
    )


def _sorted(df: DataFrame) -> DataFrame:
    """A side of a join whose size the planner cannot tell: both sides are shuffled and sorted."""
    return df.hint("merge")


VALUE_KEY = ["market", "kind", "value"]


def hot_values(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs_per_row: int) -> DataFrame:
    """Keys that both sides have and whose product of rows exceeds ``pairs_per_row`` times their sum.

    A key that is frequent on one side only is not among them as long as the other side has at most ``pairs_per_row``
    rows of it: its pairs are in proportion to its rows.  ``right``, best the smaller side, is counted alone first, and
    only keys that it has more often go on, so that ``left`` is not shuffled for keys that cannot be hot.  They are stored, which tells
    the planner how many they are.  What is left of both sides is counted in one aggregate, combined before its shuffle.
    """
    if pairs_per_row:
        often = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > pairs_per_row).select(*keys)
        often = written(often, "frequent-values")
        left, right = (side.select(*keys).join(often, list(keys), "left_semi") for side in (left, right))
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counted = sides.groupBy(*keys).agg(F.sum("l").cast("double").alias("l"), F.sum("r").cast("double").alias("r"))
    return counted.filter(F.col("l") * F.col("r") > pairs_per_row * (F.col("l") + F.col("r"))).select(*keys)


def _agreeing_names(probes: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of names under one value, referral's and customer's, that agree.

    Each name counts once per value, whatever its rows.  A referral's last name is met among the substrings of
    the customers'; the first names are compared in place, between names that share this piece.
    """
    wanted = probes.select(*VALUE_KEY, "f_first", "f_last").dropna().distinct()
    held = known.select(*VALUE_KEY, "c_first", "c_last").dropna().distinct()
    sizes = probes.agg(F.collect_set(F.length("f_last"))).scalar()  # at most the length of the longest name
    pieces = held.withColumn("_size", F.explode(sizes)).withColumn("f_last", F.explode(_substrings("c_last", "_size"))).drop("_size")
    return wanted.join(_sorted(pieces), [*VALUE_KEY, "f_last"]).filter(F.col("c_first").contains(F.col("f_first")))


def _by_value(df: DataFrame, email: str, phone: str, rest: str) -> DataFrame:
    """A row per value of a person, the other value beside it as ``rest``."""
    entry = lambda kind, value, other: F.struct(
        F.lit(kind).alias("kind"), F.col(value).alias("value"), F.col(other).alias(rest)
    )
    return (
        df.filter(F.col("market").isNotNull())
        .withColumn("_entry", F.explode(F.array(entry("email", email, phone), entry("phone", phone, email))))
        .select("*", "_entry.*")
        .drop("_entry", email, phone)
        .filter(F.col("value").isNotNull())
        .withColumn("_hash", F.xxhash64(*VALUE_KEY))
    )


def _substrings(col: str, size: str) -> Column:
    """Distinct substrings of one length; NULL where the text is shorter."""
    text, length = F.col(col), F.col(size)
    starts = F.when(length.between(1, F.length(text)), F.sequence(F.lit(1), F.length(text) - length + 1))
    return F.array_distinct(F.transform(starts, lambda start: F.substring(text, start, length)))


def exclude_seen(df: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key was in the previous output; rows without a key stay."""
    return df.join(previous.select(key), key, "left_anti")


def split_credit(df: DataFrame, first: str, second: str, measure: str, out: str) -> DataFrame:
    """One row per associate: full credit alone, half each for a pair.  A row without the name it credits is
    left out, so totals are preserved where the first name is known."""
    pair = F.array(
        F.struct(F.col(first).alias("who"), F.lit(0.5).alias("part")),
        F.struct(F.col(second).alias("who"), F.lit(0.5).alias("part")),
    )
    alone = F.array(F.struct(F.col(first).alias("who"), F.lit(1.0).alias("part")))
    return (
        df.withColumn("_credit", F.explode(F.when(F.col(second).isNotNull(), pair).otherwise(alone)))
        .withColumn(out, F.col("_credit.who"))
        .where(F.col(out).isNotNull())
        .withColumn(measure, F.col(measure) * F.col("_credit.part"))
        .drop("_credit", first, second)
    )


def org_hierarchy(entities: DataFrame, manufacturers: DataFrame) -> DataFrame:
    """Open stores with their market and region: two self-joins of the entity table."""
    store = entities.filter((F.lower("entity_type") == "h") & (F.lower("status") == "open"))
    market = entities.select(
        F.col("entity_id").alias("_market_id"), F.col("parent_id").alias("_region_id"),
        F.col("entity_name").alias("market_name"), F.col("store_id").alias("market_code"),
    )
    region = entities.select(
        F.col("entity_id").alias("_entity_id"), F.col("entity_name").alias("region_name"),
        F.col("store_id").alias("region_code"),
    )
    return (
        store.join(manufacturers, F.col("manufacturer_code") == F.col("man_id"))
        .join(market, F.col("parent_id") == F.col("_market_id"))
        .join(region, F.col("_region_id") == F.col("_entity_id"))
        .filter(F.lower("region_name") != "corporate")
        .drop("_market_id", "_region_id", "_entity_id")
    )
