"""Reading typed values, and their JSON types, out of a VARIANT ``properties`` column."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.schemas import FLAG, INTEGER, NUMBER, PROPERTIES, SPARK_TYPE

# Where the value of ``with_json`` lies in its result.
JSON_ROOT = "$[0]"

# JSON integers reach from the least signed to the greatest unsigned 64-bit one.
INTEGER_RANGE = (Decimal(-9223372036854775808), Decimal(18446744073709551615))
WIDE_INTEGER_TYPES = ("DECIMAL(19,0)", "DECIMAL(20,0)")


def with_json(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add column ``text`` parsed to VARIANT; null unless all of it is exactly one JSON value.

    ``try_parse_json`` stops after the first value and ignores what follows, so the text
    is parsed as the first element of an array whose second element is the text's own
    hash. Anything after the value shifts, drops or breaks that second element. The result
    is that array, its value found under ``JSON_ROOT``; to cut the value out would copy it.
    The array is a column of its own first, so that every line is parsed once.
    """
    mark = F.xxhash64(text).cast("string")
    pair = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(","), mark, F.lit("]")))
    intact = (F.try_variant_get("_pair", "$[1]", "string") == mark) & F.try_variant_get(
        "_pair", "$[2]", "variant"
    ).isNull()
    return (
        df.withColumn("_pair", pair).withColumn(name, F.when(intact, F.col("_pair"))).drop("_pair")
    )


def property_value(properties: Column, key: str, kind: str) -> Column:
    """One property in its contract type; null when absent or not convertible."""
    return F.try_variant_get(properties, f"$.{key}", SPARK_TYPE[kind])


def property_columns(properties: Column) -> list[Column]:
    """Every property of the contract as a typed column."""
    return [property_value(properties, key, kind).alias(name) for key, name, kind in PROPERTIES]


def json_type(properties: Column, key: str) -> Column:
    """The type a property has in the JSON text; null when the key is absent."""
    return F.schema_of_variant(F.try_variant_get(properties, f"$.{key}", "variant"))


# The JSON types each kind of property may have.
CONTRACT_TYPES = {
    INTEGER: ("BIGINT", "VOID", *WIDE_INTEGER_TYPES),
    FLAG: ("BOOLEAN", "VOID"),
}


def outside_contract(found: Column, kind: str) -> Column:
    """Whether a property of JSON type ``found`` breaks its contract; null when absent."""
    if kind == NUMBER:
        return ~(found.isin("BIGINT", "DOUBLE", "VOID") | found.startswith("DECIMAL("))
    return ~found.isin(*CONTRACT_TYPES[kind])


def with_contract_check(df: DataFrame, properties: str, name: str) -> DataFrame:
    """Add whether at least one typed property has a JSON type outside its contract.

    The JSON types are columns of their own, so that each is looked up once. A wide integer
    type passes here; ``has_wide_misfit`` has told the misfits among them from the text.
    """
    checked = [(key, kind) for key, _, kind in PROPERTIES if kind in (INTEGER, NUMBER, FLAG)]
    types = {f"_type_{key}": json_type(F.col(properties), key) for key, _ in checked}
    broken = reduce(or_, (outside_contract(F.col(f"_type_{key}"), kind) for key, kind in checked))
    return df.withColumns(types).withColumn(name, F.coalesce(broken, F.lit(False))).drop(*types)


def has_wide_misfit(line: Column) -> Column:
    """Whether an integer property of a line with very long numbers is no 64-bit integer.

    VARIANT holds an integer beyond the signed range as a decimal and drops trailing zeros,
    which makes ``9223372036854775808.0`` look like the integer: only the text of the line
    can tell. It is searched for that many digits first, which hardly any line has. Of
    repeated keys the last counts, as it does in the VARIANT.
    """
    integers = [key for key, _, kind in PROPERTIES if kind == INTEGER]
    members = ", ".join(f"{key}: string" for key in integers)
    texts = F.from_json(line, f"properties struct<{members}>")
    misfit = F.lit(False)
    for key in integers:
        literal = texts["properties"][key]
        in_range = literal.try_cast("decimal(38,0)").between(*map(F.lit, INTEGER_RANGE))
        misfit = misfit | literal.contains(".") | ~in_range
    return F.when(line.rlike(r"\d{19}"), F.coalesce(misfit, F.lit(False))).otherwise(False)
