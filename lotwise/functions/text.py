"""Text helpers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_cap(col: Column) -> Column:
    """Upper-case the first letter of the whole text and lower-case the rest."""
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substring(col, 2, 2147483647)))


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, r"\D", "")


def drop_quotes(col: Column) -> Column:
    return F.replace(col, F.lit("'"), F.lit(""))


def id_cleanup(col: Column) -> Column:
    """``2071.0`` becomes ``2071``; text that is no number stays as it is.  Plain digits are cut by
    pattern, so long ids keep every digit; only other notations go through a number."""
    trimmed = F.trim(col)
    number = col.try_cast("double")
    whole = F.when(number.isNotNull() & (F.abs(number) < 1e15), number.cast("long").cast("string"))
    plain = F.when(trimmed.rlike(r"^-?[1-9][0-9]*(\.0*)?$"), F.regexp_extract(trimmed, r"^(-?[0-9]+)", 1))
    return F.coalesce(plain, whole, col)


def replace_all(col: Column, replacements: Sequence[tuple[str, str]]) -> Column:
    for old, new in replacements:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def composite_key(*cols: Column) -> Column:
    return F.concat(*[F.trim(F.coalesce(c.cast("string"), F.lit(""))) for c in cols])


def first_words(col: Column, count: int) -> Column:
    return F.array_join(F.slice(F.split(F.trim(col), r"\s+"), 1, count), " ")


def normalize_headers(df: DataFrame, upper: bool = True) -> DataFrame:
    """Trim names, turn non-breaking spaces into blanks, and upper-case them if asked."""
    clean = [name.replace(" ", " ").strip() for name in df.columns]
    return df.toDF(*[name.upper() if upper else name for name in clean])


def unescape_html(col: Column) -> Column:
    """Character references become characters, once: decimal and hexadecimal ones by rule, named ones by
    the standard table; a non-breaking space becomes a blank; an unknown reference stays."""
    named = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))], F.lit("apos"), F.lit("'"))

    def resolve(part: Column) -> Column:
        body = F.substring(part, 2, F.length(part) - 2)
        digits = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, F.length(body)), 16, 10)).otherwise(F.substring(body, 2, F.length(body)))
        number = F.when(body.startswith("#"), digits.try_cast("int"))
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        return F.when(part.rlike("^&.+;$"), F.coalesce(numeric, F.try_element_at(named, body), part)).otherwise(part)

    parts = F.regexp_extract_all(col, F.lit(r"(?s)(&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);|[^&]+|&)"), 1)
    decoded = F.replace(F.array_join(F.transform(parts, resolve), ""), F.lit("\u00a0"), F.lit(" "))
    return F.when(col.contains("&"), decoded).otherwise(col)


def strip_tags(col: Column) -> Column:
    return F.regexp_replace(col, r"(?s)<[^>]*>", "")


def clean_html(col: Column, line_break: str) -> Column:
    """Plain text of a fragment: references resolve, ``<br>`` becomes ``line_break``, other tags go, also
    those that were written as references."""
    broken = F.regexp_replace(unescape_html(col), r"(?i)<br\s*/?>", line_break)
    return F.trim(strip_tags(broken))


def split_address(text: Column) -> Column:
    """Comma-separated address as STRUCT<street, city, state_zip, full_address>."""
    parts = F.filter(F.transform(F.split(text, ","), lambda part: F.trim(part)), lambda part: part != "")
    size = F.size(parts)
    whole = F.array_join(parts, ", ")
    split = size >= 3
    return F.struct(
        F.when(split, F.array_join(F.slice(parts, F.lit(1), F.greatest(size - 2, F.lit(0))), ", ")).alias("street"),
        F.when(split, F.try_element_at(parts, F.lit(-2))).alias("city"),
        F.when(split, F.try_element_at(parts, F.lit(-1))).alias("state_zip"),
        whole.alias("full_address"),
    )
