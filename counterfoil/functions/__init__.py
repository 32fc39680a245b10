"""Column expressions shared by the operators."""

from counterfoil.functions.keys import spread
from counterfoil.functions.money import in_money, rounded_total, total
from counterfoil.functions.times import day_of, micros, seconds_between
from counterfoil.functions.values import as_variant, is_json, json_name, json_schema, number, shown, text, truthy

__all__ = [
    "as_variant",
    "day_of",
    "in_money",
    "is_json",
    "json_name",
    "json_schema",
    "micros",
    "number",
    "rounded_total",
    "seconds_between",
    "shown",
    "spread",
    "text",
    "total",
    "truthy",
]
