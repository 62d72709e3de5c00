"""Classification rules in oracle SQL."""

_CDJR = "'CHRYSLER','DODGE','JEEP','RAM'"
_GM = "'BUICK','CADILLAC','CHEVROLET','GMC'"
_DOM = f"{_CDJR},'FORD','LINCOLN',{_GM}"
_IMP = "'ACURA','HONDA','GENESIS','HYUNDAI','INFINITI','MAZDA','NISSAN','SUBARU','TOYOTA','VOLKSWAGEN','VOLVO'"
_LUX = "'AUDI','BMW','JAGUAR','LAND ROVER','LEXUS','MERCEDES-BENZ','MINI'"


def brand_rollup(make="make"):
    return f"""CASE WHEN upper({make}) IN ({_CDJR}) THEN 'CDJR' WHEN upper({make}) IN ('FORD','LINCOLN') THEN 'Ford'
      WHEN upper({make}) IN ({_GM}) THEN 'GM' WHEN upper({make}) IN ('HYUNDAI','GENESIS') THEN 'Hyundai'
      WHEN upper({make}) IN ('JAGUAR','LAND ROVER') THEN 'JLR' ELSE {make} END"""


def brand_plan(make="make", fiat=True):
    more = ",'FIAT'" if fiat else ""
    return f"""CASE WHEN upper({make}) IN ({_CDJR}{more}) THEN 'CDJR' WHEN upper({make}) IN ('FORD','LINCOLN') THEN 'FORD'
      WHEN upper({make}) IN ({_GM}) THEN 'GM' WHEN upper({make}) IN ('HYUNDAI','GENESIS') THEN 'HYUNDAI'
      WHEN upper({make}) IN ('JAGUAR','LAND ROVER') THEN 'JLR' ELSE {make} END"""


def segment_plan(make="make", fiat=True):
    more = ",'FIAT'" if fiat else ""
    return f"""CASE WHEN upper({make}) IN ({_DOM}{more}) THEN 'Domestic' WHEN upper({make}) IN ({_IMP}) THEN 'Import'
      WHEN upper({make}) IN ({_LUX}) THEN 'Luxury' END"""


def brand_spine(make="make"):
    return f"""CASE WHEN {make} IN ({_CDJR}) THEN 'CDJR' WHEN {make} IN ('FORD','LINCOLN') THEN 'Ford'
      WHEN {make} IN ({_GM}) THEN 'GM' WHEN {make} IN ('HYUNDAI','GENESIS') THEN 'Hyundai'
      WHEN {make} IN ('JAGUAR','LAND ROVER') THEN 'JLR' WHEN {make} = 'ACURA' THEN 'Acura' WHEN {make} = 'HONDA' THEN 'Honda'
      WHEN {make} = 'TOYOTA' THEN 'Toyota' WHEN {make} = 'AUDI' THEN 'Audi' WHEN {make} = 'LEXUS' THEN 'Lexus'
      WHEN {make} = 'MERCEDES-BENZ' THEN 'Mercedes-Benz' WHEN {make} IN ('BMW','MINI') THEN {make} ELSE 'Others' END"""


def segment_spine(make="make"):
    return f"""CASE WHEN {make} IN ({_DOM}) THEN 'Domestic' WHEN {make} IN ({_IMP}) THEN 'Import'
      WHEN {make} IN ({_LUX},'PORSCHE','ASTON MARTIN','BENTLEY') THEN 'Premium Luxury' ELSE 'Others' END"""


def brand_tracker(make="make"):
    return f"""CASE WHEN {make} IN ({_GM}) THEN 'GM' WHEN {make} IN ({_CDJR},'FIAT') THEN 'Chrysler'
      WHEN {make} = 'GENESIS' THEN 'Hyundai' WHEN {make} = 'LINCOLN' THEN 'Ford'
      WHEN {make} IN ('JAGUAR','LAND ROVER') THEN 'JLR' ELSE {make} END"""


def brand_availability(make="make"):
    return f"""CASE WHEN upper({make}) IN ({_CDJR},'FIAT') THEN 'CDJR' WHEN upper({make}) IN ({_GM}) THEN 'GM'
      WHEN upper({make}) IN ('FORD','LINCOLN') THEN 'Ford LM' WHEN upper({make}) IN ('JAGUAR','LAND ROVER') THEN 'Jaguar Land Rover'
      WHEN upper({make}) IN ('HYUNDAI','GENESIS') THEN 'Hyundai' ELSE {make} END"""


def segment_availability(make="make"):
    return f"""CASE WHEN upper({make}) IN ({_DOM},'FIAT') THEN 'Domestic' WHEN upper({make}) IN ({_IMP}) THEN 'Import'
      WHEN upper({make}) IN ({_LUX},'PORSCHE','ASTON MARTIN','BENTLEY') THEN 'Premium Luxury' ELSE 'Other' END"""


def code_group(code):
    return f"""CASE WHEN lower({code}) IN ('rental-co','auction') THEN 'AUCTION/RENTAL'
      WHEN lower({code}) IN ('leasestrpurch','leasebuyout') THEN 'LEASE RETURN'
      WHEN lower({code}) IN ('trade-in','trade-in-used') THEN 'TRADE-IN'
      WHEN lower({code}) IN ('activeloaner','retiredloaner') THEN 'SERVICE LOANER'
      WHEN lower({code}) = 'webuyyourcar' THEN 'WBYC' END"""


def source_group(original, current, history=None):
    parts = [code_group(original), code_group(current)] + ([history] if history else [])
    return f"coalesce({', '.join(parts)}, 'Other')"


def age_bucket(days):
    return f"""CASE WHEN {days} IS NULL THEN 'N/A' WHEN {days} < 16 THEN '01: 0-15' WHEN {days} < 31 THEN '02: 16-30'
      WHEN {days} < 46 THEN '03: 31-45' WHEN {days} < 61 THEN '04: 46-60' WHEN {days} < 91 THEN '05: 61-90'
      WHEN {days} < 121 THEN '06: 91-120' ELSE '07: Over 120' END"""


def price_inclusive(p, c):
    return f"""CASE WHEN {p} BETWEEN 0.01 AND 20000 THEN '1:0-20,000' WHEN {p} BETWEEN 20000 AND 40000 THEN '2:20,001 - 40,000'
      WHEN {p} BETWEEN 40000 AND 1000000 THEN '3:Over 40,001' WHEN {c} BETWEEN 0.01 AND 20000 THEN '1:0-20,000'
      WHEN {c} BETWEEN 20000 AND 40000 THEN '2:20,001 - 40,000' WHEN {c} BETWEEN 40000 AND 1000000 THEN '3:Over 40,001'
      ELSE 'N/A' END"""


def price_open(p):
    return f"""CASE WHEN {p} IS NULL THEN 'N/A' WHEN {p} < 20001 THEN '1:0-20,000' WHEN {p} < 40001 THEN '2:20,001 - 40,000'
      ELSE '3:Over 40,001' END"""


def valid(*prices):
    bad = " OR ".join(f"{p} IS NULL OR {p} < 1" for p in prices)
    return f"CASE WHEN {bad} THEN 'N/A' ELSE 'Valid' END"


def band(*measures):
    whens = " ".join(
        f"WHEN {m} BETWEEN 1 AND 20000 THEN '$0-$20k' WHEN {m} BETWEEN 20000 AND 40000 THEN '$20-$40k' "
        f"WHEN {m} BETWEEN 40000 AND 1000000 THEN '$40k+'"
        for m in measures
    )
    return f"CASE {whens} ELSE 'Adjustments' END"


def age_band(d):
    return f"""CASE WHEN {d} BETWEEN 0 AND 45 THEN '0-45' WHEN {d} BETWEEN 45 AND 120 THEN '46-120'
      WHEN {d} BETWEEN 120 AND 1200 THEN '120+' ELSE 'Adjustments' END"""


def gate(measure, units, price, target, *more):
    extra = " ".join(f"WHEN {m} IS NULL THEN 0 WHEN {m} = 0 THEN 0" for m in more)
    return f"""CASE WHEN {units} = 0 THEN 0 WHEN {price} IS NULL THEN 0 WHEN {price} = 0 THEN 0 {extra}
      WHEN {target} IS NULL THEN 0 WHEN {target} = 0 THEN 0 WHEN {price} > {target} + 10000 THEN 0 WHEN {target} < 1000 THEN 0
      WHEN {price} < 1000 THEN 0 WHEN {price} + 10000 < {target} THEN 0 ELSE {measure} END"""


def plan_code(c="column_code"):
    return f"""CASE WHEN {c} IN ('TCCM1','TCC2_M1','TCC3_M1') THEN 'Commit' WHEN {c} IN ('EAM1','EA2_M1','EA3_M1') THEN 'Earned'
      WHEN {c} IN ('NAM1','NAM2','NAM3','NAM4','NAM5','NAM6') THEN 'Net' WHEN {c} = 'SARFM1' THEN 'F1'
      WHEN {c} = 'SARFM2' THEN 'F2' WHEN {c} = 'SARFM3' THEN 'F3' ELSE 'ERROR' END"""


def first_cap(c):
    return f"concat(upper(left({c}, 1)), lower(substring({c}, 2)))"


def brand_segment(b):
    return f"""CASE WHEN {b} IN ('Ford','Chrysler','GM') THEN 'Domestic'
      WHEN {b} IN ('Acura','Honda','Hyundai','Infiniti','Mazda','Nissan','Subaru','Toyota','Volkswagen','Volvo') THEN 'Import'
      WHEN {b} IN ('Aston Martin','Audi','BMW','Bentley','Jaguar Land Rover','Lexus','Mercedes','Mini','Other Lux','Porsche')
      THEN 'Luxury' ELSE 'Other' END"""
