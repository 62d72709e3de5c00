import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators import extract as X
from lotwise.operators import questions as Q
from lotwise.plans import upkeep as K

HTML = """<div><h3 class="n">A &amp; Co</h3><p class="a">1 St<br>Town</p></div>
<div><h3 class="n">No Address</h3></div><div><h3 class="n">C</h3><b>x</b><p class="a">2 St<br/>City</p></div>"""


def test_cards(spark, rows):
    pages = spark.createDataFrame([(1, HTML), (2, "nothing"), (3, None)], "page_id int, html string")
    assert rows(K.card_locations(pages, "n", "a"), "page_id", "name", "value") == [
        (1, "A & Co", "1 St\nTown"), (1, "C", "2 St\nCity"), (1, "No Address", ""),
    ]


def test_json_records(spark, rows):
    text = '[{"id":"1","name":"X\nY","lat":1,"city":"C1","state":"S1"},{"id":"z","name":"no"},{"id":"2","name":"B","city":"C2","state":"S2"}]'
    pages = spark.createDataFrame([(1, text)], "page_id int, html string")
    assert rows(K.json_locations(pages), "store_name", "city", "state") == [("B", "C2", "S2"), ("X\nY", "C1", "S1")]


def test_documents(spark, rows):
    text = "Dealer Code: A1\n  Training done  \ntraining\nDealer Code: B2 x\nEV Readiness"
    docs = spark.createDataFrame([(1, text), (2, "Dealer Code:")], "doc_id int, text string")
    assert rows(X.keyword_lines(docs, ["doc_id"], "text", ["Training", "EV Readiness"])) == [(1, 1, "Training done"), (1, 4, "EV Readiness")]
    assert rows(X.key_value(docs, ["doc_id"], "text", "Dealer Code:")) == [(1, "B2")]
    cells = X.lines_to_columns(spark.createDataFrame([(" a , b,,c ",)], "line string"), "line").first().cells
    assert cells == ["a", "b", "", "c"]


PHRASES = {
    "new retail units": "New Retail Units", "new base retail pvr": "New Base Retail PVR", "used variable gross": "Used Variable Gross",
    "used core pvr": "Used Core PVR",
}
QUESTIONS = [
    "What is the total New Retail Units for October 2025?", "What store has the maximum New Base Retail PVR in September?",
    "What is the average Used Variable Gross?", "Which brand has the lowest Used Core PVR in 2025", "How many retail at Store 12?",
    "Tell me a joke",
]
SCORE = [
    (9, 2025, "Store 1", "Ford", 5.0, 100.0, 10.0, 7.0), (10, 2025, "Store 1", "Ford", 6.0, 50.0, None, 3.0),
    (9, 2024, "Store 12", "Audi", 8.0, 400.0, 40.0, 9.0), (10, 2025, "Store 12", "Audi", 9.0, 400.0, 50.0, 5.0),
]


def test_questions(spark):
    asked = spark.createDataFrame(list(enumerate(QUESTIONS)), "question_id int, question string")
    names = ["New Retail Units", "New Base Retail PVR", "Used Variable Gross", "Used Core PVR"]
    card = spark.createDataFrame(SCORE, "month int, year int, store string, brand string, " + ", ".join(f"`{n}` double" for n in names))
    stores = spark.createDataFrame([("Store 12", 1), ("Store 1", 0)], "name string, position int")
    brands = spark.createDataFrame([("Ford", 0), ("Audi", 1)], "name string, position int")
    resolved = Q.resolve_questions(asked, PHRASES, stores, brands)
    by_id = {r.question_id: r for r in resolved.collect()}
    assert by_id[4].store == "Store 1"  # first in catalogue order, though "Store 12" is the longer hit
    assert by_id[4].metric == "New Retail Units" and by_id[4].operation == "count"
    got = {r.question_id: (r.metric, r.operation, r.value, r.entity) for r in Q.answer_questions(resolved, card, names).collect()}
    assert got == {
        0: ("New Retail Units", "sum", 15.0, None), 1: ("New Base Retail PVR", "max", 400.0, "Store 12"),
        2: ("Used Variable Gross", "mean", 100.0 / 3, None), 3: ("Used Core PVR", "min", 3.0, "Ford"),
        4: ("New Retail Units", "count", 2.0, None), 5: (None, "sum", None, None),
    }


@pytest.mark.parametrize("many", [10, 100_000])
def test_names_in_text(spark, many):
    rng = random.Random(many)
    word = lambda: "".join(rng.choices("abcd ", k=rng.randint(1, 9)))
    names = [(n, rng.randint(0, 50)) for n in {word() for _ in range(10)}] + [(f"Store {k:06}", k) for k in range(many)]
    names += [("é ü", 3), ("", 0), (None, 0), ("STORE 000003", -1)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 8))) for _ in range(60)] + ["at store 000007 or store 000003.", "", None, "x é üy"]
    frame = spark.createDataFrame(names, "name string, position int")
    asked = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r["k"]: r["store"] for r in Q.names_in_text(asked, "k", "t", {"store": frame}).collect()}
    small = [(p, n) for n, p in names if n and (p <= 50)]
    for k, text in enumerate(texts):
        found = [(p, n) for p, n in small if n.lower() in (text or "")]
        assert got.get(k) == (min(found)[1] if found else None)


def test_only_asked_sets_are_summed(spark):
    """Five questions, five sets: the cells go into those sets and no others."""
    card = spark.createDataFrame([(m, 2025, f"S{s}", f"B{b}", 1.0 * m * s + b) for m in range(1, 5) for s in range(6) for b in range(3)], "month int, year int, store string, brand string, units double")
    asked = [(0, None, None, None, None, "sum"), (1, 2, None, None, None, "max"), (2, None, 2025, "S1", None, "min"), (3, 3, None, None, "B1", "mean"), (4, 1, 2025, "S2", "B2", "count"), (5, 4, None, None, None, "sum")]
    resolved = spark.createDataFrame([(*a, "units", True, False) for a in asked], "question_id int, month int, year int, store string, brand string, operation string, metric string, asks_store boolean, asks_brand boolean")
    answers = Q.answer_questions(resolved, card, ["units"])
    answers = {r["question_id"]: (r["value"], r["entity"]) for r in answers.collect()}
    rows = [r.asDict() for r in card.collect()]
    for k, *dims, operation in asked:
        kept = [r for r in rows if all(v is None or r[d] == v for d, v in zip(("month", "year", "store", "brand"), dims))]
        values = [r["units"] for r in kept]
        want = {"sum": sum(values), "max": max(values), "min": min(values), "mean": sum(values) / len(values), "count": len(values)}[operation]
        entity = min(r["store"] for r in kept if r["units"] == want) if operation in ("max", "min") else None
        assert answers[k][0] == pytest.approx(want) and answers[k][1] == entity


def test_first_contained(spark):
    from lotwise.operators.lookup import first_contained

    df = spark.createDataFrame([("x_AF_b",), ("AirForceAF",), ("zz",)], "t string")
    got = df.select(first_contained(F.col("t"), {"AirForce": "one", "AF": "two"})).collect()
    assert [r[0] for r in got] == ["two", "one", None]


def test_a_piece_of_many_names_pairs_no_text_with_all_of_them(spark):
    """3000 names that share their pieces: a text meets the one that it holds."""
    frame = spark.range(3000).selectExpr("concat('q1997', lpad(conv(id, 10, 3), 8, '0')) AS name", "id AS position")
    asked = spark.range(200).selectExpr("id AS k", "concat('in 1997 or q1997', lpad(conv(id, 10, 3), 8, '0'), '?') AS t")
    found = Q.names_in_text(asked, "k", "t", {"store": frame})
    assert {r["k"]: r["store"] for r in found.collect()} == {r["k"]: r["t"][11:-1] for r in asked.collect()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert any("_lower" in line for line in joins)
