"""Typed columns for JSON documents whose fields are not known before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import json_values

#: A field is a column if one document in so many has it.
ONE_IN = 100
_TYPED = r"^(BIGINT|DOUBLE|FLOAT|BOOLEAN|STRING|DATE|TIMESTAMP|TIMESTAMP_NTZ|DECIMAL\(\d+,\s*\d+\))$"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    num_documents: int


def _fields(text: Column) -> Column:
    """The top fields of a document by name; NULL if the text is not one JSON object."""
    return F.get(json_values(text), 0).try_cast("map<string,variant>")


def discover_fields(docs: DataFrame, text: str = "value", one_in: int = ONE_IN) -> list[Field]:
    """The top fields that at least one in ``one_in`` documents has, by name, with their types.

    The type is the narrowest that holds all values: whole numbers of up to 18 digits are
    BIGINT and longer ones DECIMAL, so none loses digits up to 38. Fields of several kinds, and
    objects and arrays, are VARIANT; fields that are always null are too. Fields are counted
    where the rows are; the driver gets at most ``one_in`` times the mean number of
    fields of a document.
    """
    parsed = docs.select(_fields(F.col(f"`{text}`")).alias("fields")).filter(F.col("fields").isNotNull())
    total = parsed.count()
    kind = F.schema_of_variant("value")
    nested = kind.rlike("^(OBJECT|ARRAY)")
    found = (
        parsed.select(F.explode("fields").alias("name", "value"))
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("num"),
            F.max(nested).alias("nested"),
            # What is inside of objects is not gathered; there may be any number of names.
            F.schema_of_variant_agg(F.when(~nested, F.col("value"))).alias("kind"),
        )
        .filter(F.col("num") * one_in >= total)
    )
    typed = F.when(~F.col("nested") & F.col("kind").rlike(_TYPED), F.col("kind")).otherwise("VARIANT")
    rows = found.select("name", typed.alias("type"), "num").collect()
    return sorted((Field(row.name, row.type, row.num) for row in rows), key=lambda field: field.name)


def _fits(found: Column, type_: str) -> Column:
    """Whether a variant is a value of ``type_`` as it is, without a digit lost."""
    kind = F.schema_of_variant(found)
    digits, scale = (F.regexp_extract(kind, r"(\d+),\s*(\d+)", place).try_cast("int") for place in (1, 2))
    if type_.startswith("DECIMAL"):
        most = int(type_.rstrip(")").split(",")[1])
        return (kind == "BIGINT") | (scale <= most)
    if type_ in ("DOUBLE", "FLOAT"):
        whole = F.abs(found.try_cast("decimal(38,0)")) <= 2**53
        return (kind == type_) | ((kind == "BIGINT") & whole) | (digits <= 15)
    return kind == type_


def typed_documents(
    docs: DataFrame, fields: list[Field], text: str = "value", rest: str = "rest"
) -> DataFrame:
    """``docs`` with a column per field in place of ``text``, and a column with the others.

    ``rest`` is a map of the fields without a column and of the values that do not fit
    theirs, as JSON; it is empty, never NULL, for a document all of whose values have a place.
    For a text that is no JSON object everything is NULL, ``rest`` included. A JSON null is a
    NULL in a typed column.
    """
    kept = [name for name in docs.columns if name != text]
    clash = {name.lower() for name in [*kept, rest]} & {field.name.lower() for field in fields}
    folded = [field.name.lower() for field in fields]
    clash |= {name for name in folded if folded.count(name) > 1}
    if clash or rest in kept:
        raise ValueError(f"document fields {sorted(clash)} are names of other columns")
    others = [F.col(f"`{name}`") for name in kept]
    parsed = docs.select(*others, _fields(F.col(f"`{text}`")).alias("_fields"))

    def value(field: Field) -> Column:
        found = F.try_element_at("_fields", F.lit(field.name))
        if field.type == "VARIANT":
            return found
        return F.when(_fits(found, field.type), found.try_cast(field.type))

    parsed = parsed.withColumns({f"_at_{place}": value(field) for place, field in enumerate(fields)})
    holders = [
        F.when(
            F.col(f"_at_{place}").isNotNull()
            | F.is_variant_null(F.try_element_at("_fields", F.lit(field.name))),
            F.lit(field.name),
        )
        for place, field in enumerate(fields)
    ]
    taken = F.array_compact(F.array(*holders)) if holders else F.array().cast("array<string>")
    left = F.map_filter("_fields", lambda name, _: ~F.array_contains(F.col("_taken"), name))
    shown = F.transform_values(left, lambda _, found: F.to_json(found))
    columns = [F.col(f"_at_{place}").alias(field.name) for place, field in enumerate(fields)]
    return parsed.withColumn("_taken", taken).select(*others, *columns, shown.alias(rest))
