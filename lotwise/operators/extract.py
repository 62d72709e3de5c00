"""Records out of pages and documents, over whole texts, with JVM-side regular expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_html, split_address


def extract_records(pages: DataFrame, keys: Sequence[str], text: str, pattern: str, columns: Sequence[str]) -> DataFrame:
    """One row per match of ``pattern``; its groups become ``columns``, ``position`` counts from 0.

    The page is searched once for whole matches; the groups are read off the short matches.
    """
    found = pages.select(*keys, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))))
    groups = [F.regexp_extract("col", pattern, i + 1).alias(c) for i, c in enumerate(columns)]
    return found.select(*keys, F.col("pos").alias("position"), *groups)


def extract_blocks(
    pages: DataFrame, keys: Sequence[str], text: str, name_tag: str, value_tag: str, line_break: str = "\n"
) -> DataFrame:
    """(name, value) per name tag: the value is the first value tag before the next name tag,
    empty when there is none.  Tags are given as patterns of the opening tag, ``<h3[^>]*>``."""
    close = lambda tag: "</" + tag.lstrip("<").split("[")[0].split(" ")[0].rstrip(">") + ">"
    chunks = F.split(F.col(text), f"(?s)(?={name_tag})")
    rows = pages.select(*keys, F.posexplode(chunks).alias("position", "chunk")).filter(F.col("chunk").rlike(f"^{name_tag}"))
    inner = lambda tag: F.regexp_extract("chunk", f"(?s){tag}(.*?){close(tag)}", 1)
    return rows.select(
        *keys,
        "position",
        clean_html(inner(name_tag), " ").alias("name"),
        clean_html(inner(value_tag), line_break).alias("value"),
    )


def extract_addresses(
    pages: DataFrame, keys: Sequence[str], text: str, block: str, name: str, address: str
) -> DataFrame:
    """Name and split address of every popup block that has both."""
    blocks = extract_records(pages, keys, text, block, ["block"])
    plain = blocks.select(
        *keys, "position",
        clean_html(F.regexp_extract("block", name, 1), " ").alias("name"),
        split_address(clean_html(F.regexp_extract("block", address, 1), ", ")).alias("parts"),
    )
    return plain.filter((F.col("name") != "") & (F.col("parts.full_address") != "")).select(
        *keys, "position", "name", "parts.*"
    )


def lines_of(docs: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    return docs.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def keyword_lines(docs: DataFrame, keys: Sequence[str], text: str, keywords: Sequence[str]) -> DataFrame:
    """Trimmed lines that contain one of the keywords (case-sensitive)."""
    hit = reduce(lambda a, b: a | b, [F.col("line").contains(k) for k in keywords])
    return lines_of(docs, keys, text).filter(hit).withColumn("line", F.trim("line"))


def key_value(docs: DataFrame, keys: Sequence[str], text: str, label: str, value: str = r"(\S+)") -> DataFrame:
    """Value after the last line holding ``label`` and a value: a later line overwrites."""
    pattern = f"{label}\\s*{value}"
    last = F.element_at(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)), -1)
    has = F.regexp_like(F.col(text), F.lit(pattern))
    return docs.filter(has).select(*keys, last.alias("value"))


def lines_to_columns(df: DataFrame, line: str, separator: str = ",") -> DataFrame:
    """Text lines to trimmed cells."""
    cells: Column = F.transform(F.split(F.col(line), f"\\Q{separator}\\E"), lambda c: F.trim(c))
    return df.withColumn("cells", cells)
