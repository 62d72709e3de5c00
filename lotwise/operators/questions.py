"""Questions in plain words answered from a metric table, as one batch job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTH_NAMES
from ..functions.mappings import QUESTION_OPERATIONS
from ..session import written

DIMENSIONS = ("month", "year", "store", "brand")


def _any_in(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


#: Length of the pieces that names are looked up by.
GRAM = 4
#: Places of the table that tells whether a piece may be one that names are filed under.
MARKS = 1 << 16
#: More names than these are joined sorted: their compressed file looks small to the planner, whatever their number.
FEW_NAMES = 20_000


def _starts(text: Column, size: Column) -> Column:
    """Places of the text where a piece of this size begins."""
    return F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))


def _filed(catalogues: Mapping[str, DataFrame]) -> DataFrame:
    """Every name of the catalogues under its rarest piece (``gram``) and the piece's place in it (``_at``)."""
    names = reduce(
        lambda a, b: a.unionByName(b),
        [
            frame.select(
                F.lit(kind).alias("_kind"), F.lower("name").alias("_lower"), F.col("name").alias("_name"),
                F.col("position").cast("long").alias("_position"),
            )
            for kind, frame in catalogues.items()
        ],
    ).where("_name is not null and _name != ''")
    # A place takes sixteen bits below: of longer names the pieces behind do not count.
    at = F.explode(F.slice(_starts(F.col("_lower"), F.least(F.length("_lower"), F.lit(GRAM))), 1, 1 << 16))
    gram = lambda place: F.substring("_lower", place, GRAM)
    common = names.withColumn("_at", at).groupBy(gram(F.col("_at")).alias("gram")).agg(F.count(F.lit(1)).alias("_names"))
    keys = ["_kind", "_lower", "_name", "_position"]
    # Number of names and place in one long: the smallest is kept by a hash aggregate, where the names' rows already lie.
    pieces = names.repartition(*keys).withColumn("_at", at).withColumn("gram", gram(F.col("_at")))
    rank = F.min(F.col("_names") * (1 << 17) + F.col("_at")).alias("_rank")
    rarest = pieces.join(written(common, "pieces"), "gram").groupBy(*keys).agg(rank)
    place = (F.col("_rank") % (1 << 17)).cast("int")
    return written(rarest.select(*keys, gram(place).alias("gram"), place.alias("_at")), "names")


def names_in_text(texts: DataFrame, key: str, text: str, catalogues: Mapping[str, DataFrame]) -> DataFrame:
    """Per text the first name of each catalogue (``{column: (name, position) frame}``) in it.

    Every name is filed under one piece of GRAM characters (a shorter name under itself): the one that the fewest
    names hold.  A text keeps the places alone whose piece is marked as filed, a test by hash within the row.  A piece tells
    at which places of names, and of which lengths, it is filed; the substrings of the text that would be such names
    meet the names by equality.  So what a text costs depends on the places and lengths of names, not on how many there
    are, and a piece that many names are filed under pairs no text with all of them.
    """
    filed = _filed(catalogues)
    size = F.length("gram")
    sizes = filed.agg(F.collect_set(size)).scalar()  # at most GRAM different ones
    bucket = lambda gram: F.pmod(F.xxhash64(gram), F.lit(MARKS)).cast("int")
    marks = bytearray(MARKS)
    for row in filed.select(bucket(F.col("gram")).alias("b")).distinct().toArrow().column("b").to_pylist():
        marks[row] = 1
    marked = lambda gram: F.substring(F.lit(marks), bucket(gram) + 1, 1) == F.lit(bytearray(b"\x01"))
    whole = F.col("_text")
    cut = (
        texts.select(key, F.col(text).alias("_text"))
        .withColumn("_size", F.explode(sizes))
        .withColumn("_start", F.explode(F.filter(_starts(whole, F.col("_size")), lambda at: marked(whole.substr(at, F.col("_size"))))))
        .withColumn("gram", whole.substr(F.col("_start"), F.col("_size")))
    )
    spots = filed.groupBy("gram").agg(F.collect_set(F.struct(F.col("_at"), F.length("_lower").alias("length"))).alias("_spots"))
    spot, begin = F.col("_spot"), F.col("_start") - F.col("_spot._at") + 1
    candidates = (
        cut.join(spots, "gram").withColumn("_spot", F.explode("_spots"))
        .where((begin >= 1) & (begin + spot["length"] - 1 <= F.length(whole)))
        .select(key, "gram", spot["_at"].alias("_at"), whole.substr(begin, spot["length"]).alias("_lower"))
    )
    few = filed.count() <= FEW_NAMES
    hits = candidates.join(filed if few else filed.hint("merge"), ["gram", "_at", "_lower"])
    order = F.struct("_position", "_name")
    return hits.groupBy(key).agg(
        *[F.min(F.when(F.col("_kind") == kind, order))["_name"].alias(kind) for kind in catalogues]
    )


def resolve_questions(
    questions: DataFrame,
    phrases: Mapping[str, str],
    stores: DataFrame,
    brands: DataFrame,
    key: str = "question_id",
    text: str = "question",
) -> DataFrame:
    """Month, year, store, brand, operation and metric of each question.

    ``phrases`` maps a phrase to a metric; the longest one found wins.  Without a phrase the
    first metric sharing a word of more than four letters is taken.  ``stores``/``brands``
    hold (name, position) in catalogue order and are searched by :func:`names_in_text`, however many they are.
    """
    asked = questions.select(key, F.lower(text).alias("_q"))
    q = F.col("_q")
    month = F
    for number, name in enumerate(MONTH_NAMES, 1):
        month = month.when(q.contains(name), number)
    operation = F
    for op, words in QUESTION_OPERATIONS:
        operation = operation.when(_any_in(q, words), op)
    metric = F
    for phrase in sorted(phrases, key=len, reverse=True):
        metric = metric.when(q.contains(phrase), phrases[phrase])
    words = F.split(q, r"\s+")
    for name in dict.fromkeys(phrases.values()):
        long_words = [w for w in name.lower().split() if len(w) > 4]
        if long_words:
            metric = metric.when(F.arrays_overlap(words, F.array(*[F.lit(w) for w in long_words])), name)
    year = F.regexp_extract(q, r"\b(20\d{2})\b", 1)
    base = asked.select(
        key,
        "_q",
        month.otherwise(F.lit(None)).cast("int").alias("month"),
        F.when(year != "", year).cast("int").alias("year"),
        _any_in(q, ["what store", "which store", "what location"]).alias("asks_store"),
        _any_in(q, ["what brand", "which brand"]).alias("asks_brand"),
        operation.otherwise("sum").alias("operation"),
        metric.otherwise(F.lit(None).cast("string")).alias("metric"),
    )
    named_store = ~_any_in(q, ["what store", "which store"])
    found = names_in_text(base, key, "_q", {"store": stores, "brand": brands})
    return base.join(found, key, "left").select(
        *[c for c in base.columns if c != "_q"],
        F.when(named_store, F.col("store")).alias("store"),
        F.when(~F.col("asks_brand"), F.col("brand")).alias("brand"),
    )


def answer_questions(resolved: DataFrame, scorecard: DataFrame, metrics: Sequence[str], key: str = "question_id") -> DataFrame:
    """Answers of the resolved questions; a question without a metric keeps a NULL answer.

    Every filter is optional, so a question asks one of the sixteen grouping sets of the four dimensions.  The scorecard
    is summed to its cells once; the cells then go into those sets alone that some question asks, each summed
    from the cells, and a question looks its combination up by equality: the work grows with questions plus
    scorecard rows, not their product.
    """
    gid = reduce(
        lambda a, b: a + b,
        [F.when(F.col(d).isNull(), 1 << (len(DIMENSIONS) - 1 - i)).otherwise(0) for i, d in enumerate(DIMENSIONS)],
    ).cast("long")
    long = scorecard.unpivot(list(DIMENSIONS), list(metrics), "metric", "value").filter(F.col("value").isNotNull())
    cells = long.groupBy("metric", *DIMENSIONS).agg(
        F.sum("value").alias("sum"), F.count("value").cast("double").alias("count"), F.max("value").alias("max"), F.min("value").alias("min"),
    )
    asked = resolved.where("metric is not null").agg(F.collect_set(gid)).scalar()  # at most sixteen numbers
    masked = cells.withColumn("gid", F.explode(asked)).select(
        "metric", "gid", "sum", "count", "max", "min", "store", "brand",
        *[F.when(F.col("gid").bitwiseAND(1 << (len(DIMENSIONS) - 1 - i)) == 0, F.col(d).cast("string")).alias(f"g_{d}") for i, d in enumerate(DIMENSIONS)],
    )
    first = lambda value, name: F.min(F.struct(value.alias("v"), F.col(name).alias("e")))
    cube = masked.groupBy("metric", "gid", *[f"g_{d}" for d in DIMENSIONS]).agg(
        F.sum("sum").alias("sum"), (F.sum("sum") / F.sum("count")).alias("mean"), F.sum("count").alias("count"),
        F.max("max").alias("max"), F.min("min").alias("min"),
        first(-F.col("max"), "store").alias("high"), first(F.col("min"), "store").alias("low"),
        first(-F.col("max"), "brand").alias("high_b"), first(F.col("min"), "brand").alias("low_b"),
    )
    probe = resolved.select(
        key, F.col("metric").alias("_metric"), "operation", "asks_store", "asks_brand", gid.alias("_gid"),
        *[F.col(d).cast("string").alias(f"q_{d}") for d in DIMENSIONS],
    )
    same = (F.col("_metric") == F.col("metric")) & (F.col("_gid") == F.col("gid"))
    for d in DIMENSIONS:
        same = same & F.col(f"q_{d}").eqNullSafe(F.col(f"g_{d}"))
    joined = probe.join(cube, same, "left")
    op = F.col("operation")
    value = (
        F.when(op == "sum", F.coalesce(F.col("sum"), F.lit(0.0)))
        .when(op == "mean", F.col("mean"))
        .when(op == "max", F.col("max"))
        .when(op == "min", F.col("min"))
        .otherwise(F.coalesce(F.col("count"), F.lit(0.0)))
    )
    entity = (
        F.when(F.col("asks_store") & (op == "max"), F.col("high.e"))
        .when(F.col("asks_store") & (op == "min"), F.col("low.e"))
        .when(F.col("asks_brand") & (op == "max"), F.col("high_b.e"))
        .when(F.col("asks_brand") & (op == "min"), F.col("low_b.e"))
    )
    known = F.col("_metric").isNotNull()
    return joined.select(
        key, F.col("_metric").alias("metric"), op, F.when(known, value).alias("value"), F.when(known, entity).alias("entity")
    )
