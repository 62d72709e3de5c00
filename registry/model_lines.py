"""Model lines that reach every rule of the allocation mapping, with the keys and groups expected of them.

Each line: make, model, style, trim, model id; the key that its group is listed under; the group of a rule that needs
no list (None: no such rule); the key without the inventory's rules, where it differs; and for the off-road make the key that is
tried if the first is not listed, in inventory and without its style.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELDS = ("make", "model", "style_name", "trim", "model_id", "key", "special", "plain_key", "second_key", "plain_second_key")


def _line(make, model, key=None, style="Base", trim="LE", model_id=None, special=None, plain=None, second=None, plain_second=None):
    key = f"{make.upper()}_{model.upper() if key is None else key}"
    plain = key if plain is None else f"{make.upper()}_{plain}"
    second, plain_second = (None if s is None else f"{make.upper()}_{s}" for s in (second, second if plain_second is None else plain_second))
    model_id = model_id or f"M{20 + len(make + model) % 20}"
    return (make, model, style, trim, model_id, key, special, plain, second, plain_second)


# One line per abbreviation, in their order.
_ABBREVIATED = [
    _line("Cadillac", "Escalade", "ESC"), _line("Audi", "SQ5 Sportback", "Q5"), _line("Audi", "RS Q8 Performance", "RS"), _line("Audi", "SQ7 Prestige", "Q7"),
    _line("Audi", "SQ8 e-tron", "Q8"), _line("Hyundai", "Palisade Hybrid", "PALISADE"), _line("Ford", "Transit Cargo", "TRANSIT"),
    _line("Ford", "Explorer ST", "EXPLORER"), _line("Toyota", "Prius Prime", "PRIUS"), _line("Jeep", "Grand Wagoneer L", "GRAND WAGONEER", second="GRAND WAGONEER L"),
    _line("Jeep", "Grand", "GRAND WAGONEER", second="GRAND"), _line("Jeep", "Wagoneer Sport", "WAGONEER S", second="WAGONEER SPORT"),
    _line("Jeep", "Wagoneer L", "WAGONEER", second="WAGONEER L"), _line("GMC", "Yukon XL", "YKNXL"), _line("GMC", "Yukon Denali", "YKN"),
    _line("Mazda", "Mazda3 Hatchback", "MAZDA3 HB"), _line("Mazda", "Mazda3 Sedan", "MAZDA3 SDN"), _line("Cadillac", "CT4-V", "CT4"), _line("Cadillac", "CT5-V", "CT5"),
    _line("Cadillac", "CT6 Sport", "CT6"), _line("Buick", "Escalade ESV", "ESCESV"), _line("Buick", "Escalade IQ", "ESCIQ"), _line("Cadillac", "Lyriq-V", "LYRIQ"),
    _line("Cadillac", "Optiq Sport", "OPTIQ"), _line("Land Rover", "Defender 110", "NEW DEFENDER"), _line("Land Rover", "Discovery Sport", "NEW DISCOVERY"),
    _line("Volvo", "XC60 Recharge", "XC60"), _line("Volvo", "XC40 Core", "XC40"), _line("Volvo", "EX30 Plus", "EX30"), _line("Volvo", "EX40 Ultra", "EX40"),
    _line("Volvo", "EX90 Twin", "EX90"), _line("Volvo", "XC90 T8 Hybrid", "XC90 HYBRID"), _line("Volvo", "XC90 Plus", "XC90"), _line("Subaru", "Crosstrek Wilderness", "XV CROSSTREK"),
]
# One line per rule that names a group, in their order.
_SPECIAL = [
    _line("Chevrolet", "Silverado 2500HD", style="Crew Cab LT", special="1466 {Chevrolet_CHDCRW}"), _line("Chevrolet", "Silverado EV", style="Crew Cab RST", special="2801 {Chevrolet_CLDEVC}"),
    _line("Chevrolet", "Silverado 1500", style="Crew Cab", special="1475 {Chevrolet_CLDCRW}"), _line("Chevrolet", "Silverado 3500HD", style="Double Cab", special="2558 {Chevrolet_CHDDBL}"),
    _line("Chevrolet", "Silverado 1500", style="4x4 Double Cab", special="2558 {Chevrolet_CLDDBL}"), _line("Chevrolet", "Silverado 3500HD CC", style="Reg Cab", special="1467 {Chevrolet_CHDREG}"),
    _line("Chevrolet", "Silverado EV", style="Regular Cab", special="2801 {Chevrolet_CLDEVC}"), _line("Chevrolet", "Silverado 2500", style="Reg Cab WT", special="1477 {Chevrolet_CLDREG}"),
    _line("GMC", "Sierra 2500HD", style="Crew Cab", special="1761 {GMC_GHDCRW}"), _line("GMC", "Sierra 1500", style="Crew Cab", special="1763 {GMC_GLDCRW}"),
    _line("GMC", "Sierra 3500HD", style="Double Cab", special="2566 {GMC_GHDDBL}"), _line("GMC", "Sierra 2500", style="Double Cab", special="1764 {GMC_GLDDBL}"),
    _line("GMC", "Sierra 4500HD", style="Reg Cab", special="2602 {GMC_GHDREG}"), _line("GMC", "Sierra 3500", style="Reg Cab", special="1765 {GMC_GLDREG}"),
    _line("Ford", "Super Duty F-350 DRW", special="1706 {Ford_F-SERIES SD}"), _line("GMC", "Hummer EV SUV", special="2741 {GMC_HEVTRK}"),
    _line("Chevrolet", "Suburban", special="1517 {Chevrolet_SUBURB}"), _line("Chevrolet", "Tahoe", special="1288 {Chevrolet_TAHOE}"), _line("Chevrolet", "Trax", special="1288 {Chevrolet_TRAX}"),
    _line("Chevrolet", "Blazer EV", special="2776 {Chevrolet_BLAZEV}"), _line("Toyota", "bZ", special="2736 {Toyota_BZ4X}"),
    _line("Toyota", "Tundra", style="SR5 4WD", special="2487 {Toyota_TUNDRA 4WD}"), _line("Toyota", "Tundra", style="SR5", special="2488 {Toyota_TUNDRA 2WD}"),
    _line("Toyota", "Corolla", style="Hybrid LE", special="2453 {Toyota_COROLLA HYBRID}"), _line("Toyota", "Corolla", special="2451 {Toyota_COROLLA}"),
    _line("Toyota", "4Runner i-FORCE MAX", special="2842 {Toyota_4RUNNER Hybrid}"), _line("RAM", "1500 Classic", special="2361 {Ram_CREWPRM}"), _line("RAM", "2500 Mega", special="2364 {RAM_HD 2500}"),
    _line("RAM", "3500 Laramie", special="2364 {RAM_HD 3500}"), _line("RAM", "4500 Chassis Cab", special="2349 {RAM_4500/5500}"), _line("RAM", "ProMaster EV", special="2817 {Ram_PROMASTER EV}"),
    _line("RAM", "ProMaster City", special="2371 {Ram_PROMASTER CITY}"), _line("RAM", "ProMaster Cutaway", special="2370 {RAM_PROMASTER}"),
]
# Makes with keys of their own, vans, models that no rule knows, and those that are left out.
_OTHERS = [
    _line("Lexus", "GX", "GX 450H", style="GX 450h Premium", plain="GX"), _line("Lexus", "RX", "RX 350H", style="RX 350 F Sport", plain="RX"), _line("Lexus", "IS", "IS 500", style="IS 500 F Sport", plain="IS"),
    _line("Lexus", "LC", "LC500", style="LC 500 Coupe", plain="LC"), _line("Lexus", "TX", "TX 550H", style="TX 550h+", plain="TX"), _line("Lexus", "RX", "RX", style="RX Luxury"),
    _line("Lexus", "ES", "ES HYBRID", style="ES Hybrid Luxury", plain="ES"), _line("Mercedes-Benz", "GLE", "M7", model_id="M7"), _line("Mercedes-Benz", "Sprinter 2500", "M5", model_id="M5"),
    _line("Mercedes-Benz", "Sprinter Crew", "M35", model_id="M35"), _line("Jeep", "Wrangler", trim="Sahara 4xe", second="2DR SHR"), _line("Jeep", "Wrangler", trim="Sport S", second="WRNGLR SPR"),
    _line("Jeep", "Wrangler", trim="Rubicon X", second="WRNGL RBCN"), _line("Jeep", "Wrangler", style="2 Door Soft Top", second="2DR WRANGL", plain_second="WRANGL"),
    _line("Jeep", "Wrangler", style="Hard Top 4-Door", second="4DR WRANGL", plain_second="WRANGL"), _line("Jeep", "Wrangler 392", second="WRANGL"),
    _line("Jeep", "Cherokee", model_id="JLJL74", second="CHRK SPORT"), _line("Jeep", "Grand Cherokee", model_id="JLJS72", second="GRCHRK 2DR"), _line("Jeep", "Compass", model_id="JLXS74", second="COMPASS RUBICON"),
    _line("Honda", "Civic"), _line("Honda", "Pilot", model_id="M9"), _line("Acura", "MDX", model_id="M12"), _line("BMW", "X5", model_id="M33"), _line("Kia", "Soul"), _line("Maserati", "Ghibli"),
    _line("Ford", "Police Interceptor Utility"), _line("Nissan", "Rogue", model_id="M21"),
]
LINES = [*_ABBREVIATED, *_SPECIAL, *_OTHERS]
ABBREVIATED, SPECIAL = len(_ABBREVIATED), len(_SPECIAL)


def line_of(number: Column) -> Column:
    """The line that a number stands for, as a struct."""
    quoted = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(_FIELDS, line, strict=True)]) for line in LINES]
    return F.element_at(F.array(*quoted), (number % len(LINES) + 1).cast("int"))


def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def listed(line: Column, number: Column) -> Column:
    """The keys that the group list has of a line: with and without the inventory's rules; none of every third line."""
    first = number % len(LINES) < len(_ABBREVIATED)
    keys = [F.when(first, line[k]).otherwise(F.coalesce(line[s], line[k])) for k, s in (("key", "second_key"), ("plain_key", "plain_second_key"))]
    return F.when(number % len(LINES) % 3 != 0, F.array_distinct(F.array(*keys)))


#: The same in an oracle table ``listed`` (line, listed_key).
LISTED_SQL = f"""listed AS (SELECT line, unnest([CASE WHEN line < {len(_ABBREVIATED)} THEN key ELSE coalesce(second_key, key) END,
    CASE WHEN line < {len(_ABBREVIATED)} THEN plain_key ELSE coalesce(plain_second_key, plain_key) END]) AS listed_key FROM lines WHERE line % 3 <> 0)"""

#: The lines as an oracle table ``lines`` (line, fields).
LINES_SQL = "lines(line, " + ", ".join(_FIELDS) + ") AS (VALUES " + ", ".join(f"({i}, {', '.join(map(_sql, line))})" for i, line in enumerate(LINES)) + ")"
