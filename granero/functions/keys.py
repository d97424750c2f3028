"""Business keys, codes and text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit codes and their normal form, units sold by weight and by piece.
UNIT_ALIASES = {"ST": "UN", "CS": "CJ", "CJA": "CJ"}
WEIGHT_UNITS = ("KG", "KGV")
PIECE_UNITS = ("UN", "DIS", "PAQ", "CJ")


def zero_pad(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer input is kept whole (``lpad`` would cut it)."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def material_code(value: Column) -> Column:
    return zero_pad(value, 18)


def store_code(value: Column) -> Column:
    return zero_pad(value, 4)


def ref_id(material: Column, unit: Column) -> Column:
    return F.concat(material, F.lit("-"), unit)


def ref_material(ref: Column) -> Column:
    return F.split_part(ref, F.lit("-"), F.lit(1))


def ref_unit(ref: Column) -> Column:
    return F.split_part(ref, F.lit("-"), F.lit(2))


def strip_zeros(value: Column) -> Column:
    return F.ltrim(value, F.lit("0"))


def normal_unit(unit: Column) -> Column:
    clean = F.upper(F.trim(unit))
    result = clean
    for raw, normal in UNIT_ALIASES.items():
        result = F.when(clean == raw, normal).otherwise(result)
    return result


def first_number(text: Column) -> Column:
    """First run of digits, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit(""))


def yes_flag(text: Column) -> Column:
    """X, Y, SI, TRUE and 1 are true, other text false, NULL stays NULL."""
    return F.upper(F.trim(text)).isin("X", "Y", "SI", "TRUE", "1")


def decimal_comma(text: Column, precision: int = 14, scale: int = 3) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")
