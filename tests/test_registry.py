from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import language_id
from lotwise.operators import matching as MT
from lotwise.plans import upkeep as K
from lotwise.session import written
from registry import people, trade


def test_every_model_of_the_inventory_is_on_the_electric_report(spark):
    models = ["ab", "abc", "nomap", "LARGE-1", None, "abc"]
    inventory = spark.createDataFrame([(m,) for m in models], "allocation_group string")
    listed = trade._fuel_list(lambda role, columns: inventory)
    assert {(r["model"], r["ev_flag"]) for r in listed.collect()} == {(m, "EV") for m in models}


def test_matching_never_sends_its_sides_through_the_driver(spark):
    """Both files are tiny when compressed, their rows are not: neither side of a join is broadcast by the file's size."""
    known = spark.range(2000).selectExpr(
        "concat('c', id) AS cust_no", "'0001' AS market_id", "'Ann' AS first_name", "concat('Lee', id % 7) AS last_name",
        "concat('c', id, '@x.example') AS email", "concat('555', id) AS phone",
    )
    form = known.selectExpr("cust_no AS form_id", "'0001 East' AS market_id", "first_name", "last_name", "email", "phone")
    pairs = MT.candidate_pairs(form, known, "form_id", 0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "HashJoin" in line]
    assert joins and all("_hash" in line for line in joins)
    assert pairs.count() == 2000  # a pair equal in both values is met once


def _people(spark, n):
    known = spark.range(n).selectExpr(
        "concat('c', id) AS cust_no", "'0001' AS market_id", "concat('Ann', id % 97) AS first_name", "concat('Lee', id % 1013) AS last_name",
        "concat('c', id, '@x.example') AS email", "concat('555', id) AS phone",
    )
    form = known.selectExpr(
        "cust_no AS form_id", "'0001 East' AS market_id", "first_name", "last_name", "email", "phone", "concat('s', cust_no) AS submitter_email"
    )
    deals = known.withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(2)))).selectExpr(
        "cust_no", "concat(cust_no, '-', nth) AS deal_no", "add_months(DATE '1999-08-01', -nth) AS accounting_month",
        "IF(cust_no LIKE '%7', 'Return', 'VehicleSale') AS sale_type", "1.0D AS front_gross",
    )
    return form, known, deals


@pytest.mark.parametrize("with_sales", [False, True])
def test_matching_shuffles_each_side_once(spark, with_sales):
    """Beyond the size of a broadcast every side is shuffled once, the answers once; no side again for hot values that do not exist."""
    form, known, deals = _people(spark, 20_000)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
    try:
        found = MT.match_people(form, known)
        if with_sales:
            found = K.referral_matches(form, known, written(deals, "deals"), date(1999, 7, 1))
        assert len(found.collect()) == (36_000 if with_sales else 20_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Referrals, customers, answers; with sales the answers by customer and the deals.
    assert final.count("Exchange hashpartitioning") == (5 if with_sales else 3)


def test_sales_multiply_the_new_referrals_last(spark, monkeypatch):
    form, known, deals = _people(spark, 40)
    nobody = known.selectExpr("'x' || cust_no AS cust_no", "market_id", "first_name", "last_name", "CAST(NULL AS STRING) AS email", "CAST(NULL AS STRING) AS phone")
    known = known.union(known.where("cust_no = 'c5'")).union(nobody)  # a customer that comes twice, some without a number

    class Own:
        referral_form, customers = form, known.withColumn("cust_no", F.regexp_replace("cust_no", "^c", ""))

        def __call__(self, role, columns):
            return deals.withColumn("cust_no", F.regexp_replace("cust_no", "^c", "")).select(*columns.split())

    seen, step = [], K.new_referrals
    monkeypatch.setattr(K, "new_referrals", lambda matches, *rest: seen.append(matches.columns) or step(matches, *rest))
    got = people._new_referrals(Own()).select("employee_email", "form_id", "cust_no", "deal_no", "email", "telephone").collect()
    assert seen and "deal_no" not in seen[0]
    asked = [i for i in range(40) if not str(i) < "3" and i % 10 != 7]
    assert sorted(map(tuple, got)) == sorted(
        (f"sc{i}", f"c{i}", f"{i}", f"c{i}-{nth}", f"C{i}@X.EXAMPLE", f"555{i}")
        for i in asked for nth in (0, 1) for _ in range(2 if i == 5 else 1)
    )


def test_referrals_are_not_shuffled_for_values_that_no_side_repeats(spark):
    """A value is hot only if both sides have it often; where no customer repeats one, the referrals need no count."""
    form, known, _ = _people(spark, 5_000)
    many = form.select("email").unionAll(form.filter("form_id < 'c2'").select("email"))
    hot = MT.hot_values(many, known.select("email"), ["email"], 32)
    assert hot.isEmpty() and hot.collect() == []
    assert "Exchange" not in hot._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    often = form.filter("form_id IN ('c1', 'c2')").crossJoin(spark.range(80)).select("email")
    once = known.filter("cust_no <> 'c2'").select("email")
    assert [r[0] for r in MT.hot_values(many.unionAll(often), often.filter("email LIKE 'c1@%'").unionAll(once), ["email"], 32).collect()] == ["c1@x.example"]


def test_sales_meet_flags_not_labels(spark):
    """The matches are shuffled to their sales as flags; the labels are written where both have met."""
    form, known, deals = _people(spark, 200)
    found = K.referral_matches(form, known, deals, date(1999, 7, 1))
    assert found.columns[:6] == ["cust_no", "form_id", "market", "email_match", "phone_match", "name_match"]
    assert {tuple(r)[3:6] for r in found.collect()} == {("Email_match", "Phone_match", "name_match")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Email_match") < plan.index("Join Inner")


def test_every_labelled_text_is_counted(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('word ', IF(id = 17, 'rare', 'plain')) AS text", "'x' AS lang")
    counts = {(r["word"], r["n"]) for r in language_id._word_counts(language_id._known(docs)).groupBy("word").agg(F.sum("n").alias("n")).collect()}
    assert counts == {("word", 4000), ("rare", 1), ("plain", 3999)}


def test_models_of_all_folds_are_learned_in_the_same_passes(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('abab ba b', id % 9, ' ab aab') AS text", "IF(id % 3 = 0, 'x', 'y') AS lang")
    known, names, langs = language_id._known(docs), ["▁", "▁a", "a", "b", "ab", "▁ab", "ba"], ["x", "y"]
    counts = language_id._word_counts(known, language_id.FOLDS)
    assert counts.count() == counts.select("lang", "word").distinct().count()  # a word is cut once for all folds
    passes, step = [], language_id._em_step
    monkeypatch.setattr(language_id, "_em_step", lambda *a: passes.append(a) or step(*a))
    table = language_id._fit(counts, langs, names, [F.col("n") - F.col("n0"), F.col("n") - F.col("n1"), F.col("n")])
    assert len(passes) == language_id.STEPS
    for k, rest in enumerate([known.where("fold <> 0"), known.where("fold <> 1"), known]):
        alone = language_id._fit(language_id._word_counts(rest), langs, names, [F.col("n")])
        assert np.allclose(table[:, :, k], alone[:, :, 0], rtol=1e-12)
    judged = language_id.predict(known, langs, names, table[:, :, [0, 1, 2, 2, 2]], carry=("doc_id", "fold"), fit=True, model="fold").where("fold < 2")
    for k in (0, 1):
        alone = language_id.predict(known.where(f"fold = {k}"), langs, names, np.ascontiguousarray(table[:, :, k]), carry=("doc_id", "fold"), fit=True)
        assert sorted(map(tuple, judged.where(f"fold = {k}").collect())) == sorted(map(tuple, alone.collect()))
