import random
import time

import pytest
from pyspark.sql import functions as F

from lotwise.operators.tags import element_texts, first_text, nested_blocks


def texts(spark, html, tag="div", attributes=None):
    return spark.createDataFrame([(html,)], "t string").select(element_texts(F.col("t"), tag, attributes)).first()[0]


@pytest.mark.parametrize("html, attributes, want", [
    ("<div>a<div>b</div>c</div>", None, ["a<div>b</div>c", "b"]),
    ("<div class='x'>a<div class=y>b</div></div><DIV CLASS=\"z x\">c</Div >", {"class": "x"}, ["a<div class=y>b</div>", "c"]),
    ("<div>open<div>b</div>", None, ["open<div>b</div>", "b"]),  # never closed: to the end
    ("</div></div><div>a</div></div><div>b</div>", None, ["a", "b"]),  # closing tags too many
    ("<div>a<!-- <div> -->b</div>", None, ["ab"]),
    ("<div><script>x='</div>'</script>b</div>", None, ["<script>x='</div>'</script>b"]),
    ("<div title='<div>' data-x=\"</div>\">a</div>", None, ["a"]),
    ("<div id=a class='k'>1</div><div class='k' id=\"b\">2</div>", {"id": "b", "class": "k"}, ["2"]),
    ("<div title='x class=\"k\"'>no</div>", {"class": "k"}, []),
    ("<div class='kk'>no</div><div data-class='k'>no</div><div class>no</div>", {"class": "k"}, []),
    ("<divide>no</divide><div/>a < b</div>", None, ["a < b"]),
    ("<div>é😀<div>ü</div></div>", None, ["é😀<div>ü</div>", "ü"]),
    ("", None, []), ("no tags", None, []), (None, None, None), ("<div", None, []), ("<div>a<", None, ["a<"]),
])
def test_elements(spark, html, attributes, want):
    assert texts(spark, html, attributes=attributes) == want


def walk(tokens):
    """Inner texts by a stack, in the order of the opening tags."""
    found, stack = [], []
    for i, token in enumerate(tokens):
        if token == "<div>":
            stack.append(len(found))
            found.append((i + 1, len(tokens)))
        elif token == "</div>" and stack:
            k = stack.pop()
            found[k] = (found[k][0], i)
    return ["".join(tokens[a:b]) for a, b in found]


def test_random_pages_like_a_stack(spark):
    rng = random.Random(3)
    pages = [[rng.choice(["<div>", "</div>", "<div>", "x", "<b>", "ß", "</p>"]) for _ in range(rng.randint(0, 900))] for _ in range(60)]
    frame = spark.createDataFrame([(i, "".join(p)) for i, p in enumerate(pages)], "id int, t string").repartition(4)
    got = {}
    for r in nested_blocks(frame, ["id"], "t", "div").collect():
        got.setdefault(r["id"], []).append((r["position"], r["block"]))
    for i, page in enumerate(pages):
        assert [b for _, b in sorted(got.get(i, []))] == walk(page)


def test_a_very_long_page(spark):
    """A hundred thousand tags around one that is asked for."""
    html = "<div>" * 20_000 + "<p class='a'>deep</p>" + "</div>" * 20_000 + "<div>t</div>" * 30_000
    start = time.time()
    assert texts(spark, html, "p", {"class": "a"}) == ["deep"]
    assert texts(spark, html + "<div id=last>end<div></div></div>", "div", {"id": "last"}) == ["end<div></div>"]
    assert time.time() - start < 60


def test_missing_sibling_and_repeated_rows(spark, rows):
    page = "<div class=card><h3>A &amp; B</h3><p x=1 class='addr'>1 Main<br>Town</p></div><div class=card><h3>C</h3></div><div class=card></div>"
    blocks = nested_blocks(spark.createDataFrame([(1, page), (1, page), (2, None)], "id int, t string"), ["id"], "t", "div", {"class": "card"})
    named = blocks.select("id", "position", first_text(F.col("block"), "h3").alias("n"), first_text(F.col("block"), "p", {"class": "addr"}, ", ").alias("a"))
    want = [(1, 0, "A & B", "1 Main, Town"), (1, 1, "C", ""), (1, 2, "", "")]
    assert rows(named) == sorted(want * 2)


def test_names_of_tags_are_checked(spark):
    with pytest.raises(ValueError, match="tag"):
        element_texts(F.lit(""), "div[")
