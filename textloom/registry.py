"""One registry keeps each query beside its oracle SQL, so that the two can't drift apart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A named query: its builder, its oracle SQL (None if SQL can't express it), and the operators it covers."""

    name: str
    build: Builder
    sql: str | None
    covers: tuple[str, ...]


@dataclass
class Registry:
    """Queries by name, in the order in which they were added."""

    entries: dict[str, Query] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None, covers: str = "") -> Callable[[Builder], Builder]:
        """Decorate a builder ``(spark, sf_dir) -> DataFrame`` to add it under ``name``."""

        def add(build: Builder) -> Builder:
            if name in self.entries:
                raise ValueError(f"{name} is already registered")
            self.entries[name] = Query(name, build, sql, tuple(covers.split()))
            return build

        return add

    def builders(self) -> dict[str, Builder]:
        return {name: q.build for name, q in self.entries.items()}

    def oracles(self) -> dict[str, str]:
        return {name: q.sql for name, q in self.entries.items() if q.sql}
