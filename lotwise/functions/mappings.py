"""Fixed values that define the meaning of the reports."""

# Make -> brand group.  One table per report family; labels and
# membership differ between the families on purpose.
_CDJR = ("CHRYSLER", "DODGE", "JEEP", "RAM")
_FORD = ("FORD", "LINCOLN")
_GM = ("BUICK", "CADILLAC", "CHEVROLET", "GMC")
_HYUNDAI = ("HYUNDAI", "GENESIS")
_JLR = ("JAGUAR", "LAND ROVER")

BRAND_GROUPS = {
    "rollup": {"CDJR": _CDJR, "Ford": _FORD, "GM": _GM, "Hyundai": _HYUNDAI, "JLR": _JLR},
    "plan": {"CDJR": _CDJR + ("FIAT",), "FORD": _FORD, "GM": _GM, "HYUNDAI": _HYUNDAI, "JLR": _JLR},
    "plan_weekly": {"CDJR": _CDJR, "FORD": _FORD, "GM": _GM, "HYUNDAI": _HYUNDAI, "JLR": _JLR},
    "spine": {
        "CDJR": _CDJR, "Ford": _FORD, "GM": _GM, "Hyundai": _HYUNDAI, "JLR": _JLR,
        "Acura": ("ACURA",), "Honda": ("HONDA",), "INFINITI": ("INFINITI",), "Mazda": ("MAZDA",),
        "Nissan": ("NISSAN",), "Subaru": ("SUBARU",), "Toyota": ("TOYOTA",), "Volkswagen": ("VOLKSWAGEN",),
        "Volvo": ("VOLVO",), "Aston Martin": ("ASTON MARTIN",), "Audi": ("AUDI",), "BMW": ("BMW",),
        "Bentley": ("BENTLEY",), "Lexus": ("LEXUS",), "Mercedes-Benz": ("MERCEDES-BENZ",), "MINI": ("MINI",),
        "Porsche": ("PORSCHE",),
    },
    "tracker": {
        "GM": _GM, "Chrysler": _CDJR + ("FIAT",), "Hyundai": ("GENESIS",), "Ford": ("LINCOLN",), "JLR": _JLR,
    },
    "tracker_store": {
        "GM": ("CHEVROLET", "GMC", "CADILLAC"), "Chrysler": ("DODGE",), "Ford": ("LINCOLN-MERCURY",),
        "Mercedes-Benz": ("MERCEDES",), "JLR": _JLR,
    },
    "availability": {
        "CDJR": _CDJR + ("FIAT",), "GM": _GM, "Ford LM": _FORD, "Jaguar Land Rover": _JLR, "Hyundai": _HYUNDAI,
    },
}
# Label of an unlisted make; None keeps the make itself.
BRAND_GROUP_DEFAULT = {"spine": "Others"}

# Make -> segment.
_DOMESTIC = _CDJR + _FORD + _GM
_IMPORT = (
    "ACURA", "HONDA", "GENESIS", "HYUNDAI", "INFINITI", "MAZDA", "NISSAN", "SUBARU", "TOYOTA", "VOLKSWAGEN", "VOLVO",
)
_LUXURY = ("AUDI", "BMW", "JAGUAR", "LAND ROVER", "LEXUS", "MERCEDES-BENZ", "MINI")
_PREMIUM = _LUXURY + ("PORSCHE", "ASTON MARTIN", "BENTLEY")

SEGMENTS = {
    "plan": {"Domestic": _DOMESTIC + ("FIAT",), "Import": _IMPORT, "Luxury": _LUXURY},
    "plan_weekly": {"Domestic": _DOMESTIC, "Import": _IMPORT, "Luxury": _LUXURY},
    "spine": {"Domestic": _DOMESTIC, "Import": _IMPORT, "Premium Luxury": _PREMIUM},
    "availability": {"Domestic": _DOMESTIC + ("FIAT",), "Import": _IMPORT, "Premium Luxury": _PREMIUM},
}
SEGMENT_DEFAULT = {"spine": "Others", "availability": "Other"}

# Brands of the dense reporting spine, "Others" last.
SPINE_BRANDS = [
    "CDJR", "Ford", "GM", "Acura", "Honda", "Hyundai", "INFINITI", "Mazda", "Nissan", "Subaru", "Toyota",
    "Volkswagen", "Volvo", "Aston Martin", "Audi", "BMW", "Bentley", "JLR", "Lexus", "Mercedes-Benz", "MINI",
    "Porsche", "Others",
]

# Brand -> segment of the market-share reports.  Spelling matters:
# the industry file says "MINI" and so lands in "Other".
BRAND_SEGMENTS = {
    "Domestic": ("Ford", "Chrysler", "GM"),
    "Import": (
        "Acura", "Honda", "Hyundai", "Infiniti", "Mazda", "Nissan", "Subaru", "Toyota", "Volkswagen", "Volvo",
    ),
    "Luxury": (
        "Aston Martin", "Audi", "BMW", "Bentley", "Jaguar Land Rover", "Lexus", "Mercedes", "Mini", "Other Lux",
        "Porsche",
    ),
}

# Industry make code -> brand, unknown codes become "Unknown".
INDUSTRY_BRANDS = {
    "HOND": "Honda", "FORD": "Ford", "MMNA": "Mitsubishi", "CADI": "GM", "CHEV": "GM", "GMCT": "GM",
    "DODG": "Chrysler", "JEEP": "Chrysler", "RAM": "Chrysler", "TOY": "Toyota", "NISS": "Nissan", "KIA": "Kia",
    "BUIC": "GM", "MAZD": "Mazda", "HYUN": "Hyundai", "VOLK": "Volkswagen", "MB": "Mercedes", "BMW": "BMW",
    "LINC": "Ford", "CHRY": "Chrysler", "ALFA": "Other Lux", "AUDI": "Audi", "VOLV": "Volvo", "SUBA": "Subaru",
    "GEN": "Hyundai", "ROV": "Jaguar Land Rover", "INF": "Infiniti", "SPRT": "Mercedes", "MINI": "MINI",
    "LEX": "Lexus", "ACUR": "Acura", "PORS": "Porsche", "TESL": "Tesla", "FIAT": "Fiat", "AML": "Aston Martin",
    "BEN": "Bentley", "FERR": "Other Lux", "JAG": "Jaguar Land Rover", "MASR": "Other Lux", "LAMB": "Other Lux",
    "LOT": "Other Lux", "MCLA": "Other Lux", "POLE": "Polestar", "INEO": "Other Lux", "RR": "Other Lux",
    "LCID": "Other Lux", "RIVN": "Rivian",
}

# Acquisition source codes -> source group (compared in upper case).
SOURCE_GROUPS = {
    "AUCTION/RENTAL": ("RENTAL-CO", "AUCTION"),
    "LEASE RETURN": ("LEASESTRPURCH", "LEASEBUYOUT"),
    "TRADE-IN": ("TRADE-IN", "TRADE-IN-USED"),
    "SERVICE LOANER": ("ACTIVELOANER", "RETIREDLOANER"),
    "WBYC": ("WEBUYYOURCAR",),
}
INTERNAL_SOURCES = ("TRADE-IN", "WBYC", "LEASE RETURN", "SERVICE LOANER")
SOURCE_LABELS = {
    "Others": ("LEASE RETURN", "Other", "SERVICE LOANER"), "Trade": ("TRADE-IN",), "Auction": ("AUCTION/RENTAL",),
}

# Source of a sold unit.  A source name starting with the direct-channel
# prefix counts as the direct channel whatever its type says.
DIRECT_PREFIX, DIRECT_SOURCE = "From desk", "CAAD"
SALE_SOURCES = {
    "ExLoaner": ("ACTIVE LOANER", "ACTIVELOANER", "RETIREDLOANER", "MANUFACTURER"),
    "Auction": ("AUCTION", "CAAD", "RENTAL-CO"),
    "Trade": ("DEALER-TRADE", "TRADE-IN", "TRADE-IN-USED"),
    "Interco": ("INTER-CO",),
    "Lease Return": ("LEASEBUYOUT", "LEASESTRPURCH"),
    "WBYC": ("WEBUYYOURCAR",),
}

# Grouping of the acquisitions fact.
ACQUISITION_GROUPS = {
    "Auction/Rental": ("RENTAL COMPANY", "AUCTION", "OTHER CAAD", "STREET BUY"),
    "Lease Return": ("LEASESTRPURCH", "LEASEBUYOUT"),
    "Trade-In": ("TRADE-IN-NEW", "TRADE-IN-USED"),
    "Service Loaner": ("LOANER",),
    "WBYC": ("WBYC",),
    "Other": ("OTHER", "INTERCOMPANY TRADE"),
}

# Plan column codes -> measure.
PLAN_CODES = {
    "Commit_M1": ("TCCM1", "TCC2_M1", "TCC3_M1"),
    "Earned_M1": ("EAM1", "EA2_M1", "EA3_M1"),
    "Net_Add": ("NAM1", "NAM2", "NAM3", "NAM4", "NAM5", "NAM6"),
    "Fcast_M1": ("SARFM1",),
    "Fcast_M2": ("SARFM2",),
    "Fcast_M3": ("SARFM3",),
}

# Lead reporting groups.
VOI_GROUPS = ("TRADE OFFER (VOI)", "RANGE TRADE (VOI)")
SELL_GROUPS = ("SELL ONLY", "RANGE - SELL ONLY")
SHOWROOM_PROVIDER = "WBYC-SHOWROOM"
SELL_ONLY_LEAD, NON_PROGRAM_LEAD, OTHER_LEAD = "OWN SITE SELL ONLY LEAD", "NON-WBYC LEAD", "WBYC-OTHER"
CASH_OFFER = "KBB INSTANT CASH OFFER"
PARTNER_PROVIDER, PARTNER_SUBPROVIDER, PARTNER_LEAD = "Cargurus", "Sell my car", "CARGURUS-Sell My Car"
SUBPROVIDER_LABELS = {"WBYC Sell Only": "WBYC-Own site", "Dealer Website – WBYC": "WBYC-OEM Sites"}

# Fuel types.
ELECTRIC_FUEL = "Electric Fuel System"
ELECTRIFIED_FUELS = (
    "Electric Fuel System", "Gas/Electric Hybrid", "Gasoline/Mild Electric Hy", "Plug-In Electric/Gas",
)

# On-order status -> display name and measure column.
ORDER_STATUSES = {
    "NOT PRODUCED": ("Not_Produced", "not_produced_count"),
    "TO BE BUILT": ("To_Be_Built", "to_be_built_count"),
    "BUILT": ("Built", "built_count"),
    "IN TRANSIT": ("In Transit", "in_transit_count"),
}

# Makes whose average discount counts the e-commerce channel only.
ECOM_ONLY_MAKES = (
    "Audi", "BMW", "Cadillac", "Jaguar", "Land Rover", "Acura", "MINI", "Porsche", "Mercedes-Benz",
    "MERCEDES-BENZ TRUCKS", "Mercedes Light Truck",
)

# Shortening of store names, applied in this order.
STORE_NAME_SHORTS = [
    ("Mercedes-Benz", "MB"), ("Chrysler ", "C"), ("Dodge ", "D"), ("Jeep ", "J"), ("Ram ", "R"),
    ("Chevrolet", "Chevy"), ("Volkswagen", "VW"), ("Toyota Scion", "Toyota"), ("North", "N"),
]

# Operation words of a question, first hit wins, "sum" otherwise.
QUESTION_OPERATIONS = [
    ("mean", ("average", "avg", "mean")),
    ("max", ("maximum", "max", "highest")),
    ("min", ("minimum", "min", "lowest")),
    ("count", ("count", "how many")),
]
