"""Data quality: orphans, domains, required fields, warnings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.rules import salary_bounds
from ..schemas import DOCUMENT, POST_DOMAINS, ROLE_DOMAINS


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Number of child rows whose parent does not exist; children are counted per key first."""
    parents = parent.select(F.col(parent_key).alias(key))
    children = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    missing = children.join(parents, key, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")).select(F.lit(name).alias("relation"), "orphans")


def _long_form(counts: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """One row of counters -> one row per counter."""
    rows = F.array(*(F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names))
    return counts.select(F.inline(rows))


def domain_violations(decoded: DataFrame) -> DataFrame:
    """(field, violations): non-NULL values outside the closed domain, in a single pass.

    Role fields are counted inside their array, without exploding the roles.
    """

    def outside(value: Column, domain) -> Column:
        return value.isNotNull() & ~value.isin(*domain)

    def role_violations(field: str, domain) -> Column:
        path = field.split(".")
        hits = F.filter(
            F.col("doc.roles"),
            lambda role: outside(reduce(lambda c, f: c[f], path, role), domain),
        )
        return F.coalesce(F.sum(F.when(F.col("doc.roles").isNotNull(), F.size(hits))), F.lit(0))

    counters = {f: F.count_if(outside(F.col(f"doc.{f}"), d)) for f, d in POST_DOMAINS.items()}
    counters |= {f"roles.{f}": role_violations(f, d) for f, d in ROLE_DOMAINS.items()}
    counts = decoded.agg(*(c.alias(n) for n, c in counters.items()))
    return _long_form(counts, list(counters), "field", "violations")


def undecodable(decoded_rows: DataFrame) -> DataFrame:
    """Counts over the result of ``documents.decode``: no object at all, wrong types inside."""
    return decoded_rows.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("doc").isNull()).alias("undecodable"),
        F.count_if(F.col("has_mismatch")).alias("type_mismatches"),
    )


def field_mismatches(df: DataFrame, raw: str = "raw_json", schema: T.StructType = DOCUMENT) -> DataFrame:
    """(field, mismatches): JSON values of another kind than the schema has at their place, by field.

    Every text is parsed once, as a VARIANT, from which the kinds of all places are read; that includes numbers where
    the schema has texts, which a typed parser would take as texts. Nulls and missing fields are
    no mismatch, fields the schema does not know are ignored, and of a value of the wrong kind the
    inner fields are not looked at. Texts that do not begin with a JSON object are left out; what stands behind
    it is not looked at, see ``undecodable`` for that. List elements count each.
    """
    found = F.array(*(F.struct(F.lit(n).alias("field"), c.cast("long").alias("n")) for n, c in _mismatches(F.col("_v"), schema, "")))
    parsed = df.select(F.try_parse_json(F.col(raw)).alias("_v"))
    objects = parsed.select(F.explode(F.when(_kind(F.col("_v")) == "OBJECT", F.array("_v"))).alias("_v"))
    return objects.select(F.inline(found)).groupBy("field").agg(F.sum("n").alias("mismatches"))


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID, or a number's type; NULL for what is not there."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _mismatches(value: Column, kind: T.DataType, path: str) -> list[tuple[str, Column]]:
    """Counts of mismatches at and below one place of the schema; 0 where the value is not there."""
    is_a = {T.StructType: "OBJECT", T.ArrayType: "ARRAY", T.StringType: "STRING"}
    own = _kind(value)
    right = own.isin("BIGINT", "DOUBLE", "DECIMAL", "FLOAT") if isinstance(kind, T.DoubleType) else own == is_a[type(kind)]
    counts = [(path, F.coalesce((~right & (own != "VOID")).cast("int"), F.lit(0)))] if path else []
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            inner = F.try_variant_get(value, f"$.{field.name}", "variant")
            counts += _mismatches(inner, field.dataType, f"{path}.{field.name}" if path else field.name)
    elif isinstance(kind, T.ArrayType):
        elements = F.try_variant_get(value, "$", "array<variant>")
        # An element's own counts come under the name of the list, its fields' below that.
        for at, (name, _) in enumerate(_mismatches(value, kind.elementType, path)):
            inside = F.transform(elements, _element_count(kind.elementType, path, at))
            total = F.coalesce(F.aggregate(inside, F.lit(0), lambda a, x: a + x), F.lit(0))
            if name == path:
                counts[0] = (path, counts[0][1] + total)
            else:
                counts.append((name, total))
    return counts


def _element_count(kind: T.DataType, path: str, at: int):
    return lambda x: _mismatches(x, kind, path)[at][1]


def missing_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing): NULLs in columns that must not have any."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return _long_form(counts, columns, "column", "missing")


def missing_role_titles(decoded: DataFrame) -> DataFrame:
    """Roles without their one required field."""
    untitled = F.filter("doc.roles", lambda role: role["title_raw"].isNull())
    return decoded.agg(
        F.coalesce(F.sum(F.when(F.col("doc.roles").isNotNull(), F.size(untitled))), F.lit(0)).alias("missing")
    ).select(F.lit("roles.title_raw").alias("column"), "missing")


def capped_salaries(decoded: DataFrame) -> DataFrame:
    """Roles with a yearly bound over the ceiling."""

    def capped(role: Column) -> Column:
        salary = role["salary"]
        return salary_bounds(salary["min"], salary["max"], salary["period"])[2]

    hits = F.size(F.filter("doc.roles", capped))
    return decoded.agg(
        F.coalesce(F.sum(F.when(F.col("doc.roles").isNotNull(), hits)), F.lit(0)).alias("capped_salaries")
    )


def truncated_posts(prepared: DataFrame) -> DataFrame:
    """Posts over the length limit among those that are sent to the model."""
    return prepared.agg(F.count_if(F.col("truncated") & ~F.col("skipped")).alias("truncated_posts"))
