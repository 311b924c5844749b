"""JSON payloads held against a schema of rules by field; JSON text stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.checks import violations

#: The raw JSON of a field (null if it is missing), by name, to the errors it may have.
Rule = Callable[[Column, str], Mapping[str, Column]]


def required(raw: Column, name: str) -> dict[str, Column]:
    return {f"{name} is missing": raw.isNull()}


def integer() -> Rule:
    return lambda raw, name: required(raw, name) | {f"{name} is no integer": ~raw.rlike(r"^-?\d+$")}


def number(least: float, most: float) -> Rule:
    def rule(raw: Column, name: str) -> dict[str, Column]:
        value = raw.try_cast("double")
        return required(raw, name) | {f"{name} is no number": value.isNull() & raw.isNotNull(), f"{name} is out of range": (value < least) | (value > most)}

    return rule


def one_of(*allowed: str) -> Rule:
    return lambda raw, name: required(raw, name) | {f"{name} is not allowed": ~raw.isin(*[f'"{a}"' for a in allowed])}


def array() -> Rule:
    return lambda raw, name: required(raw, name) | {f"{name} is no array": ~F.startswith(raw, F.lit("["))}


def errors(rows: DataFrame, payload: str, keys: Sequence[str], rules: Mapping[str, Rule]) -> DataFrame:
    """(keys, error): fields that are missing or break their rule; text that is no JSON has that one error."""
    # A variant's fields keep their JSON types; text that doesn't parse is null.
    value = F.try_parse_json(payload)
    marked = rows.select(*keys, value.isNull().alias("_bad"), *[F.to_json(F.try_variant_get(value, f"$.{n}", "variant")).alias(f"_{n}") for n in rules])
    checks = {"not JSON": F.col("_bad")}
    for name, rule in rules.items():
        checks |= {k: ~F.col("_bad") & c for k, c in rule(F.col(f"_{name}"), name).items()}
    return violations(marked, keys, checks)
