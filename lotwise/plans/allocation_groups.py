"""Allocation group of inventory and pipeline models, by ordered rules and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import backfill_from_history, dedupe_last, map_from_table
from ..operators.predicates import exclude_values
from ..operators.rules import Rule, apply_if_found, first_match
from ..functions.text import first_words

MISSING = "nomap"


def _model(make: str, fragment: str, result: str, **more) -> Rule:
    return Rule(result, has={"model": (fragment,)}, is_any={"make": (make,)}, **more)


# Model names as the allocation file abbreviates them.  First match wins.
MODEL_ABBREVIATIONS = [
    _model("CADILLAC", "ESCALADE", "ESC"),
    _model("AUDI", "SQ5", "Q5"),
    _model("AUDI", "RS Q8", "RS"),
    _model("AUDI", "SQ7", "Q7"),
    _model("AUDI", "SQ8", "Q8"),
    _model("HYUNDAI", "PALISADE", "PALISADE"),
    _model("FORD", "TRANSIT", "TRANSIT"),
    _model("FORD", "EXPLORER", "EXPLORER"),
    _model("TOYOTA", "PRIUS", "PRIUS"),
    _model("JEEP", "GRAND WAGONEER", "GRAND WAGONEER"),
    Rule("GRAND WAGONEER", is_any={"make": ("JEEP",), "model": ("GRAND",)}),
    Rule("WAGONEER S", has={"model": ("WAGONEER", "SPORT")}, is_any={"make": ("JEEP",)}),
    _model("JEEP", "WAGONEER", "WAGONEER"),
    Rule("YKNXL", has={"model": ("YUKON", "XL")}, is_any={"make": ("GMC",)}),
    _model("GMC", "YUKON", "YKN"),
    _model("MAZDA", "HATCHBACK", "MAZDA3 HB"),
    _model("MAZDA", "SEDAN", "MAZDA3 SDN"),
    _model("CADILLAC", "CT4", "CT4"),
    _model("CADILLAC", "CT5", "CT5"),
    _model("CADILLAC", "CT6", "CT6"),
    Rule("ESCESV", has={"model": ("ESCALADE ESV",)}),
    Rule("ESCIQ", has={"model": ("ESCALADE IQ",)}),
    _model("CADILLAC", "LYRIQ", "LYRIQ"),
    _model("CADILLAC", "OPTIQ", "OPTIQ"),
    _model("LAND ROVER", "DEFENDER", "NEW DEFENDER"),
    _model("LAND ROVER", "DISCOVERY", "NEW DISCOVERY"),
    _model("VOLVO", "XC60", "XC60"),
    _model("VOLVO", "XC40", "XC40"),
    _model("VOLVO", "EX30", "EX30"),
    _model("VOLVO", "EX40", "EX40"),
    _model("VOLVO", "EX90", "EX90"),
    Rule("XC90 HYBRID", has={"model": ("XC90", "HYBRID")}, is_any={"make": ("VOLVO",)}),
    _model("VOLVO", "XC90", "XC90"),
    _model("SUBARU", "CROSSTREK", "XV CROSSTREK"),
]

# Trucks and other models whose group depends on the cab or drive line.
_SILVERADO = ("SILVERADO 1500", "SILVERADO 2500", "SILVERADO 2500HD", "SILVERADO 3500", "SILVERADO 3500HD",
              "SILVERADO 3500HD CC", "SILVERADO EV")
_SIERRA = ("SIERRA 1500", "SIERRA 2500", "SIERRA 2500HD", "SIERRA 3500", "SIERRA 3500HD", "SIERRA 4500HD")
_SUPER_DUTY = (
    "SUPER DUTY F-250 SRW", "SUPER DUTY F-250 DRW", "SUPER DUTY F-350 SRW", "SUPER DUTY F-350 DRW", "SUPER DUTY F-450 SRW",
    "SUPER DUTY F-450 DRW", "SUPER DUTY F-550 SRW", "SUPER DUTY F-550 DRW", "SUPER DUTY F-600 SRW", "SUPER DUTY F-600 DRW",
)


def _cab(make: str, models: tuple[str, ...], cab: str, result: str, kind: str | None = None) -> Rule:
    return Rule(
        result, has={"style": (cab,), **({"model": (kind,)} if kind else {})}, is_any={"make": (make,), "model": models}
    )


def _exact(make: str, models: tuple[str, ...], result: str, style: str | None = None) -> Rule:
    return Rule(result, has={"style": (style,)} if style else {}, is_any={"make": (make,), "model": models})


SPECIAL_GROUPS = [
    _cab("CHEVROLET", _SILVERADO, "CREW CAB", "1466 {Chevrolet_CHDCRW}", "HD"),
    _cab("CHEVROLET", _SILVERADO, "CREW CAB", "2801 {Chevrolet_CLDEVC}", "EV"),
    _cab("CHEVROLET", _SILVERADO, "CREW CAB", "1475 {Chevrolet_CLDCRW}"),
    _cab("CHEVROLET", _SILVERADO, "DOUBLE CAB", "2558 {Chevrolet_CHDDBL}", "HD"),
    _cab("CHEVROLET", _SILVERADO, "DOUBLE CAB", "2558 {Chevrolet_CLDDBL}"),
    _cab("CHEVROLET", _SILVERADO, "REG", "1467 {Chevrolet_CHDREG}", "HD"),
    _cab("CHEVROLET", _SILVERADO, "REG", "2801 {Chevrolet_CLDEVC}", "EV"),
    _cab("CHEVROLET", _SILVERADO, "REG", "1477 {Chevrolet_CLDREG}"),
    _cab("GMC", _SIERRA, "CREW CAB", "1761 {GMC_GHDCRW}", "HD"),
    _cab("GMC", _SIERRA, "CREW CAB", "1763 {GMC_GLDCRW}"),
    _cab("GMC", _SIERRA, "DOUBLE CAB", "2566 {GMC_GHDDBL}", "HD"),
    _cab("GMC", _SIERRA, "DOUBLE CAB", "1764 {GMC_GLDDBL}"),
    _cab("GMC", _SIERRA, "REG", "2602 {GMC_GHDREG}", "HD"),
    _cab("GMC", _SIERRA, "REG", "1765 {GMC_GLDREG}"),
    _exact("FORD", _SUPER_DUTY, "1706 {Ford_F-SERIES SD}"),
    _exact("GMC", ("HUMMER EV PICKUP", "HUMMER EV SUV"), "2741 {GMC_HEVTRK}"),
    _exact("CHEVROLET", ("SUBURBAN",), "1517 {Chevrolet_SUBURB}"),
    _exact("CHEVROLET", ("TAHOE",), "1288 {Chevrolet_TAHOE}"),
    _exact("CHEVROLET", ("TRAX",), "1288 {Chevrolet_TRAX}"),
    _exact("CHEVROLET", ("BLAZER EV",), "2776 {Chevrolet_BLAZEV}"),
    _exact("TOYOTA", ("BZ",), "2736 {Toyota_BZ4X}"),
    _exact("TOYOTA", ("TUNDRA",), "2487 {Toyota_TUNDRA 4WD}", "4WD"),
    _exact("TOYOTA", ("TUNDRA",), "2488 {Toyota_TUNDRA 2WD}"),
    _exact("TOYOTA", ("COROLLA",), "2453 {Toyota_COROLLA HYBRID}", "HYBRID"),
    _exact("TOYOTA", ("COROLLA",), "2451 {Toyota_COROLLA}"),
    _exact("TOYOTA", ("4RUNNER I-FORCE MAX",), "2842 {Toyota_4RUNNER Hybrid}"),
    _model("RAM", "1500", "2361 {Ram_CREWPRM}"),
    _model("RAM", "2500", "2364 {RAM_HD 2500}"),
    _model("RAM", "3500", "2364 {RAM_HD 3500}"),
    _model("RAM", "4500 CHASSIS CAB", "2349 {RAM_4500/5500}"),
    Rule("2817 {Ram_PROMASTER EV}", has={"model": ("PROMASTER", "EV")}, is_any={"make": ("RAM",)}),
    Rule("2371 {Ram_PROMASTER CITY}", has={"model": ("PROMASTER", "CITY")}, is_any={"make": ("RAM",)}),
    _model("RAM", "PROMASTER", "2370 {RAM_PROMASTER}"),
]

# Off-road make, by trim, then by doors, then by model code.
OFF_ROAD_TRIMS = [("SAHARA", "2DR SHR"), ("SPORT", "WRNGLR SPR"), ("RUBICON", "WRNGL RBCN")]
OFF_ROAD_DOORS = [
    ("2DR WRANGL", [("model_id", "2DR"), ("style", "2DR"), ("style", "2 DOOR"), ("style", "2-DOOR")]),
    ("4DR WRANGL", [("model_id", "4DR"), ("style", "4DR"), ("style", "4 DOOR"), ("style", "4-DOOR")]),
]
OFF_ROAD_CODES = {
    "JLJL74": "SPORT", "JLJP74": "SAHARA", "JLJS84": "RUBICON", "JLJX74": "RUBICON 392", "JLXL74": "SPORT",
    "JLXP74": "SAHARA", "JLXS74": "RUBICON", "JLJL72": "2DR", "JLJS72": "2DR",
}
OFF_ROAD_MODELS = {"WRANGLER": "WRNGL", "CHEROKEE": "CHRK", "GRAND CHEROKEE": "GRCHRK"}

# Makes and models the mapping leaves out.
EXCLUDED = {
    "make": ("Rolls-Royce", "Maserati", "McLaren", "Mitsubishi", "INEOS"),
    "model": ("Police Interceptor Utility", "MEDIUM TRK"),
}


def group_table(groups: DataFrame, text: str, position: str) -> DataFrame:
    """Lookup ``group_key`` -> ``group`` from entries like ``1282 {Make_Model}``; the last
    entry of a key wins."""
    entries = groups.select(
        F.upper(F.regexp_extract(text, r"\{(.+?)\}", 1)).alias("group_key"), F.col(text).alias("group"), F.col(position)
    )
    return dedupe_last(entries.filter(F.col("group_key") != ""), ["group_key"], [position]).select("group_key", "group")


def _upper(name: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(name), F.lit(""))))


def _key(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)


def general_key() -> Column:
    model = first_match(MODEL_ABBREVIATIONS, {"make": F.col("make"), "model": F.col("model")}, _upper("model"))
    return _key(_upper("make"), model)


def premium_key() -> Column:
    """Key of the premium make, read off the engine number in the style."""
    style, model = _upper("style_name"), _upper("model")
    tail = (
        F.when(style.contains("450"), F.concat(model, F.lit(" 450H")))
        .when(style.contains("350"), F.concat(model, F.lit(" 350H")))
        .when(style.contains("500") & style.contains("IS"), F.concat(model, F.lit(" 500")))
        .when(style.contains("500"), F.concat(model, F.lit("500")))
        .when(style.contains("550"), F.concat(model, F.lit(" 550H")))
        .when(style.contains("RX"), model)
        .otherwise(first_words(style, 2))
    )
    return _key(_upper("make"), tail)


def off_road_key() -> Column:
    make, model, model_id = _upper("make"), _upper("model"), _upper("model_id")
    trim, style = _upper("trim"), _upper("style_name")
    wrangler = model.contains("WRANGLER")
    columns = {"model_id": model_id, "style": style}
    tail = F
    for fragment, result in OFF_ROAD_TRIMS:
        tail = tail.when(wrangler & trim.contains(fragment), result)
    for result, tests in OFF_ROAD_DOORS:
        hit = F.lit(False)
        for name, fragment in tests:
            hit = hit | columns[name].contains(fragment)
        tail = tail.when(wrangler & hit, result)
    short = F.coalesce(_literal(OFF_ROAD_MODELS, model), model)
    code = _literal(OFF_ROAD_CODES, model_id)
    tail = (
        tail.when(wrangler, "WRANGL")
        .when(code.isNotNull(), F.concat_ws(" ", short, code))
        .otherwise(model)
    )
    return _key(make, tail)


def _literal(mapping: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def assign_allocation_group(df: DataFrame, groups: DataFrame, vans: DataFrame, special: bool = True) -> DataFrame:
    """Allocation group of each model row, ``nomap`` where nothing matches.

    ``groups`` is the output of :func:`group_table`; ``vans`` maps model_id to group_code with
    unique keys.  A row needs one group lookup: which key it looks up depends on its make, so
    the make-specific steps are one CASE and one join.  The off-road make first tries the
    general key and then its own.  With ``special`` (inventory) truck rules override the lookup
    and the premium make uses its own key; the pipeline has neither.
    """
    make, model = _upper("make"), _upper("model")
    van = (make == "MERCEDES-BENZ") & model.contains("SPRINTER")
    key = F.when(make == "MERCEDES-BENZ", _key(make, _upper("model_id")))
    if special:
        key = key.when(make == "LEXUS", premium_key())
    found = map_from_table(df, key.otherwise(general_key()), groups, "group_key", "group", "_group")
    if special:
        relevant = make.isin("CHEVROLET", "GMC", "FORD", "RAM", "TOYOTA")
        rules = first_match(
            SPECIAL_GROUPS, {"make": F.col("make"), "model": F.col("model"), "style": F.col("style_name")}
        )
        found = found.withColumn("_group", apply_if_found(F.when(relevant, rules), F.col("_group")))
    off_road = F.when((make == "JEEP") & F.col("_group").isNull(), off_road_key())
    found = map_from_table(found, off_road, groups, "group_key", "group", "_off_road")
    found = map_from_table(found, F.when(van, _upper("model_id")), vans, "model_id", "group_code", "_van")
    group = F.when(van, F.col("_van")).otherwise(F.coalesce("_group", "_off_road"))
    assigned = found.withColumn("allocation_group", F.coalesce(group, F.lit(MISSING)))
    return exclude_values(assigned.drop("_group", "_off_road", "_van"), EXCLUDED)


def map_inventory(inventory: DataFrame, groups: DataFrame, vans: DataFrame, since, min_year: int = 2022) -> DataFrame:
    """Models of unmapped new inventory with their group."""
    unmapped = inventory.filter(
        (F.col("allocation_group") == MISSING) & (F.col("department") == "300")
        & (F.col("accounting_month") > F.lit(since)) & (F.col("year") > min_year)
        & ~F.upper("make").isin("KIA", "RIVIAN", "TESLA", "") & F.col("model_id").isNotNull()
        & ~F.col("model").isin("F-150 Police Responder", "F-59 Commercial Stripped Chassis")
    )
    models = unmapped.select("style_id", "year", "make", "model", "model_id", "style_name", "trim").distinct()
    return assign_allocation_group(models, groups, vans)


def map_pipeline(
    orders_daily: DataFrame, inventory: DataFrame, groups: DataFrame, vans: DataFrame, since, min_year: int = 2022,
    parenthesised: bool = False,
) -> DataFrame:
    """Models on order with their group; what is still unmapped takes the newest group that the
    model had in inventory and is looked up once more under that name.

    The source filter reads ``a and b and c or d or e`` without parentheses, so blank groups
    pass whatever their make; ``parenthesised`` applies the make test to all of them.
    """
    group = F.col("alloc_group")
    unmapped, blank = group == MISSING, (group == "") | group.isNull()
    named = (F.col("model_year") >= 2019) & (F.col("make") != "nomake")
    wanted = named & (unmapped | blank) if parenthesised else (named & unmapped) | blank
    models = (
        orders_daily.filter(
            (F.col("update_date") > F.lit(since)) & (F.col("model_year") > min_year) & (F.col("model") != "Motor Home")
            & wanted
        )
        .select(
            "model_year", "make", "model", F.coalesce("model_number", F.lit("0")).alias("model_id"), "trim",
            F.lit("").alias("style_name"),
        )
        .distinct()
    )
    assigned = assign_allocation_group(models, groups, vans, special=False)
    history = inventory.select("model_id", "allocation_group", "year", "accounting_month")
    filled = backfill_from_history(
        assigned, history, "model_id", "allocation_group", ["year", "accounting_month"], MISSING
    )
    again = map_from_table(
        filled, F.when(F.col("was_missing"), _key(_upper("make"), _upper("allocation_group"))), groups, "group_key",
        "group", "_again",
    )
    retried = F.when(F.col("was_missing"), F.coalesce("_again", F.lit(MISSING))).otherwise(F.col("allocation_group"))
    return again.withColumn("allocation_group", retried).drop("_again", "style_name")
