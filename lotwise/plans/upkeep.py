"""Files and history: tenants, referrals, weekly roll, period upserts, locations, scorecard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import extract_addresses, extract_blocks, extract_records
from ..operators.history import replace_named_period, roll_history
from ..operators.lookup import lookup
from ..operators.matching import exclude_seen, flag_matches, label_matches
from ..operators.questions import answer_questions, resolve_questions
from ..operators.stacking import drop_empty_columns
from ..session import written
from ..sources.files import combine_tenant_files, standardize

# Headers of the payments report and the columns that hold amounts.
PAYMENT_COLUMNS = [
    "Payment ID", "Payment Business Unit", "Payment Type", "Payment Method", "Payment Amount", "Amount Allocated",
    "Credit Remaining", "Payment Status", "Transaction Status", "Financing Payment", "Refund Method", "Refund Reason",
    "Payment Date", "Customer ID", "Customer Name", "Created By", "Customer Street", "Customer City", "Customer State",
    "Customer Zip", "Customer Phone", "Customer Email", "Batch Number",
]
PAYMENT_AMOUNTS = ("payment_amount", "amount_allocated", "credit_remaining")
PAYMENT_NAMES = {c: c.lower().replace(" ", "_") for c in PAYMENT_COLUMNS} | {"Payment Business Unit": "business_unit"}
PAYMENT_TYPES = {new: "double" if new in PAYMENT_AMOUNTS else "string" for new in PAYMENT_NAMES.values()}


def tenant_report(
    spark: SparkSession, paths: str | list[str], columns: Sequence[str] | None, tenant_map: Mapping[str, str],
    rename: Mapping[str, str], types: Mapping[str, str], **options,
) -> DataFrame:
    """One report kind of all tenants: combined, without empty columns, renamed and typed.

    Kinds differ in ``columns``, ``rename`` and ``types`` only; the payments report's are above.
    ``columns=None`` keeps every header of the files.
    """
    combined = combine_tenant_files(spark, paths, columns, tenant_map, **options)
    return standardize(drop_empty_columns(combined), rename, types)


def referral_matches(form: DataFrame, customers: DataFrame, deals: DataFrame, since: date, **options) -> DataFrame:
    """Sales since ``since`` to customers that agree with a referral in two of three respects, labelled once they have met."""
    return label_matches(sold_since(flag_matches(form, customers, **options), deals, since))


def sold_since(people: DataFrame, deals: DataFrame, since: date) -> DataFrame:
    """Sales since ``since`` to the customers of ``people``, one row per person's row and sale."""
    sold = deals.filter((F.col("accounting_month") >= F.lit(since)) & (F.col("sale_type") == "VehicleSale"))
    return people.join(sold, "cust_no")


def new_referrals(matches: DataFrame, previous: DataFrame, form: DataFrame) -> DataFrame:
    """Matches not reported last time, with the submitter of the referral in front.

    Both hang on the person alone: where the sales multiply the matches, :func:`sold_since` comes after.
    """
    fresh = exclude_seen(matches, previous, "telephone")
    named = lookup(fresh, form, ["email"], {"submitter_email": "employee_email"})
    return named.select("employee_email", *[c for c in named.columns if c != "employee_email"])


def roll_weekly(tables: Mapping[str, tuple[DataFrame, DataFrame]], date_col: str, as_of: date) -> dict[str, DataFrame]:
    """Next version of each history table from its (history, new snapshot) pair."""
    return {name: roll_history(old, new, date_col, as_of) for name, (old, new) in tables.items()}


def upsert_plan_history(history: DataFrame, rollup: DataFrame, closed_month: date) -> DataFrame:
    """Replace the closed month of the plan history; other months of ``rollup`` are ignored."""
    return replace_named_period(history, rollup, {"year_month": closed_month.strftime("%Y%m")})


def upsert_month(history: DataFrame, new: DataFrame, month: date) -> DataFrame:
    """Replace one month of a history keyed by month and year numbers."""
    return replace_named_period(history, new, {"mth": month.month, "year": month.year})


# Page layouts of three location pages.
JSON_LOCATION = r'(?s)\{"id":"\d+","name":"(.*?)".*?"city":"(.*?)","state":"(.*?)"\}'
POPUP_BLOCK = r"(?s)locations\.push\(\[\s*'(<div class=\"map-popup\">.*?</div>)'"


def json_locations(pages: DataFrame) -> DataFrame:
    return extract_records(pages, ["page_id"], "html", JSON_LOCATION, ["store_name", "city", "state"])


def card_locations(pages: DataFrame, name_class: str, address_class: str) -> DataFrame:
    return extract_blocks(
        pages, ["page_id"], "html", f'<h3[^>]*class="{name_class}"[^>]*>', f'<p[^>]*class="{address_class}"[^>]*>'
    )


def popup_locations(pages: DataFrame) -> DataFrame:
    return extract_addresses(
        pages, ["page_id"], "html", POPUP_BLOCK, r"(?s)<h3[^>]*>(.*?)</h3>", r'(?s)<p class="address">(.*?)</p>'
    )


def scorecard_answers(
    questions: DataFrame, scorecard: DataFrame, stores: DataFrame, brands: DataFrame, phrases: Mapping[str, str]
) -> DataFrame:
    # Stored, as the asked grouping sets are taken from it before the answers are.
    resolved = written(resolve_questions(questions, phrases, stores, brands), "resolved-questions")
    return answer_questions(resolved, scorecard, list(dict.fromkeys(phrases.values())))
