"""DuckDB forms of the text functions, for oracle SQL."""

from __future__ import annotations


def fold(x: str) -> str:
    return f"trim(regexp_replace({fold_ascii(x)}, '\\s+', ' ', 'g'))"


def fold_ascii(x: str) -> str:
    return f"strip_accents(lower({x}))"


def tokens(x: str, n: int = 3) -> str:
    return f"list_distinct(regexp_extract_all({fold(x)}, '[a-z0-9]{{{n},}}'))"


def slug(x: str, n: int = 120) -> str:
    return f"coalesce(nullif(regexp_replace(left(regexp_replace(regexp_replace({fold(x)}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), {n}), '-+$', ''), ''), 'item')"


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"
