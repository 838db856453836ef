"""Alias and price dimensions.

The built-in tables have under 200 rows and become local relations, so Catalyst knows
their size and broadcasts them. A caller's own table is read from files, whose size
Catalyst knows as well: it is broadcast below ``spark.sql.autoBroadcastJoinThreshold``
and joined by sort-merge beyond it. No join here carries a broadcast hint.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions.text import is_blank, py_strip
from ..schemas import PRICES


@dataclass(frozen=True)
class Dimensions:
    """The alias tables of one run: (alias, canonical) frames."""

    tech: DataFrame
    city: DataFrame
    city_country: DataFrame
    country: DataFrame
    currency: DataFrame


def alias_frame(spark: SparkSession, aliases: Mapping[str, str], lower_keys: bool = True) -> DataFrame:
    keys = {(k.lower() if lower_keys else k): v for k, v in aliases.items()}
    table = pa.table(
        {
            "alias": pa.array(keys.keys(), pa.string()),
            "canonical": pa.array(keys.values(), pa.string()),
        }
    )
    return spark.createDataFrame(table)


def built_in_dimensions(spark: SparkSession) -> Dimensions:
    return Dimensions(
        tech=alias_frame(spark, V.TECH_ALIASES),
        city=alias_frame(spark, V.CITY_ALIASES),
        city_country=alias_frame(spark, V.CITY_COUNTRIES, lower_keys=False),
        country=alias_frame(spark, V.COUNTRY_ALIASES),
        currency=alias_frame(spark, V.CURRENCY_ALIASES),
    )


def read_aliases(
    spark: SparkSession, path: str, section: str | None = None, lower_keys: bool = True
) -> DataFrame:
    """Alias table from a file of ``key: value`` lines, optionally of one indented section.

    Quotes around keys and values are taken off, comments skipped; of a repeated key
    the last line counts. A file holds one table of a few hundred lines.
    """
    text = F.concat(F.col("value"), F.lit("\n"))
    if section:
        text = F.regexp_extract(text, rf"(?m)^{section}:[ \t]*\n((?:[ \t]+[^\n]*\n|[ \t]*\n)*)", 1)
    pattern = r"""^\s*(?:"([^"]*)"|([^\s#"][^\n]*?))\s*:\s+(?:"([^"]*)"|([^\n"#]*?))\s*(?:\s#.*)?$"""
    lines = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )
    entries = lines.filter(F.col("line").rlike(pattern)).select(
        "line_no",
        F.concat(F.regexp_extract("line", pattern, 1), F.regexp_extract("line", pattern, 2)).alias("alias"),
        F.concat(F.regexp_extract("line", pattern, 3), F.regexp_extract("line", pattern, 4)).alias(
            "canonical"
        ),
    )
    key = F.lower("alias") if lower_keys else F.col("alias")
    return entries.groupBy(key.alias("alias")).agg(F.max_by("canonical", "line_no").alias("canonical"))


def read_dimensions(spark: SparkSession, folder: str) -> Dimensions:
    """The alias tables from files: tech, city (with section ``city_country``), country and currency."""
    folder = folder.rstrip("/")
    return Dimensions(
        tech=read_aliases(spark, f"{folder}/tech"),
        city=read_aliases(spark, f"{folder}/city", "aliases"),
        city_country=read_aliases(spark, f"{folder}/city", "city_country", lower_keys=False),
        country=read_aliases(spark, f"{folder}/country"),
        currency=read_aliases(spark, f"{folder}/currency"),
    )


def look_up(
    df: DataFrame, raw: str, dim: DataFrame, out: str, *, lower: bool = True, strip: bool = True
) -> DataFrame:
    """Add ``out``: the canonical value of column ``raw``, NULL when the table has none."""
    key = F.col(raw)
    if strip:
        key = py_strip(key)
    if lower:
        key = F.lower(key)
    table = dim.select(F.col("alias").alias("_alias"), F.col("canonical").alias(out))
    return df.join(table, key == F.col("_alias"), "left").drop("_alias")


def with_tech(df: DataFrame, dim: DataFrame, raw: str = "tech_raw") -> DataFrame:
    """Add ``tech`` (an unknown name passes through, cleaned) and the 0/1 flag ``aliased``."""
    known = look_up(df, raw, dim, "_tech")
    return (
        known.withColumn("tech", F.coalesce("_tech", F.lower(py_strip(F.col(raw)))))
        .withColumn("aliased", F.col("_tech").isNotNull().cast("int"))
        .drop("_tech")
    )


def with_place(df: DataFrame, dims: Dimensions, city_raw: str, country_raw: str) -> DataFrame:
    """Add ``city`` and ``country``; a missing country is inferred from the canonical city."""

    def known_or_stripped(raw: str, known: str) -> Column:
        return F.when(~is_blank(F.col(raw)), F.coalesce(known, py_strip(F.col(raw))))

    df = look_up(df, city_raw, dims.city, "_city")
    df = df.withColumn("city", known_or_stripped(city_raw, "_city"))
    df = look_up(df, country_raw, dims.country, "_country")
    df = df.withColumn("country", known_or_stripped(country_raw, "_country"))
    df = look_up(df, "city", dims.city_country, "_inferred", lower=False, strip=False)
    infer = is_blank(F.col("country")) & ~is_blank(F.col("city"))
    return df.withColumn("country", F.when(infer, F.col("_inferred")).otherwise(F.col("country"))).drop(
        "_city", "_country", "_inferred"
    )


def with_currency(df: DataFrame, dim: DataFrame, raw: str, out: str) -> DataFrame:
    """Add the currency code; an unknown one passes through in upper case."""
    df = look_up(df, raw, dim, "_currency")
    code = F.coalesce("_currency", F.upper(py_strip(F.col(raw))))
    return df.withColumn(out, F.when(~is_blank(F.col(raw)), code)).drop("_currency")


# --- prices ------------------------------------------------------------------------


def built_in_prices(spark: SparkSession) -> DataFrame:
    names, inputs, outputs = zip(*V.MODEL_PRICES)
    return spark.createDataFrame(
        pa.table({"model": names, "input_per_1m": inputs, "output_per_1m": outputs})
    )


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price table from JSON, ``{model: {input_per_1m, output_per_1m}, ...}`` in one document.

    A missing file gives an empty table, so that every cost is 0; other errors are raised.
    """
    rates = "MAP<STRING, STRUCT<input_per_1m: DOUBLE, output_per_1m: DOUBLE>>"
    try:
        documents = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PRICES)
    return documents.select(F.explode(F.from_json("value", rates)).alias("model", "rate")).select(
        "model",
        F.coalesce("rate.input_per_1m", F.lit(0.0)).alias("input_per_1m"),
        F.coalesce("rate.output_per_1m", F.lit(0.0)).alias("output_per_1m"),
    )
