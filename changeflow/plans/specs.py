"""What a layered change-data flow needs to know about one entity or one report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from changeflow.operators.quality import Rule


@dataclass(frozen=True)
class TableSpec:
    """One entity on its way from change files to the current state.

    A further entity is a further value of this class, not further code.
    """

    name: str
    keys: tuple[str, ...]
    sequence_by: str
    clean: Callable[[DataFrame], DataFrame]
    rules: tuple[Rule, ...] = ()
    tie_break: tuple[str, ...] | None = None
    raw_layout: tuple[str, ...] = ()
    layout: tuple[str, ...] = ()  # of the checked and of the current table
    comments: Mapping[str, str] = field(default_factory=dict)  # by layer
    delete_when: str | None = None  # which raw changes delete their key; None: they are only dropped
    keep_history: bool = False  # a table of all intervals beside the current rows
    buckets: int | None = None  # of the base that compaction writes by key; None: it is laid out by ``layout``

    @property
    def bronze(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver(self) -> str:
        return f"silver_{self.name}"

    @property
    def current(self) -> str:
        return f"gold_{self.name}_current"

    @property
    def history(self) -> str:
        return f"gold_{self.name}_history"


@dataclass(frozen=True)
class ReportSpec:
    """A fully recomputed table: ``build`` gets the current tables by entity name.

    ``uses`` may name the columns it needs of each; what several reports need is then ranked once.
    """

    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    layout: tuple[str, ...] = ()
    comment: str = ""
    uses: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
