"""Entities as rows of a table: a further one is a further row, and needs no code.

A row has what a ``TableSpec`` has. Its cleaning is a list of filters, of derived columns and of
columns to drop, and its rules are names, predicates and actions: SQL expressions over the columns of
one row. ``check_specs`` holds them against the columns of the changes before anything is read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.quality import Rule
from changeflow.plans.specs import TableSpec

# Columns of the table, all but the first three may be NULL.
SCHEMA = """
    name string, keys array<string>, sequence_by string,
    filters array<string>, derived array<struct<name string, expression string>>, dropped array<string>,
    rules array<struct<name string, predicate string, action string>>,
    tie_break array<string>, raw_layout array<string>, layout array<string>,
    comments map<string, string>, delete_when string, keep_history boolean, buckets int
"""

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


class SpecError(ValueError):
    """What is wrong with a row of the table, all of it."""

    def __init__(self, problems: Sequence[str]):
        self.problems = list(problems)
        super().__init__("; ".join(self.problems))


def clean(
    changes: DataFrame, filters: Sequence[str] = (), derived: Sequence[tuple[str, str]] = (), dropped: Sequence[str] = ()
) -> DataFrame:
    """Filters first, each as SQL has it (NULL goes), then derived columns, each from the columns that
    arrived, then the columns that go, where they are there."""
    for predicate in filters:
        changes = changes.filter(F.expr(predicate))
    return changes.withColumns({name: F.expr(expression) for name, expression in derived}).drop(*dropped)


def _problems(row: dict) -> list[str]:
    """What can be seen without the columns of the changes."""
    name = row["name"]
    found = []
    if not name or not _NAME.fullmatch(name):
        found.append(f"{name!r} is no name of an entity")
    if not row["keys"] or any(not k for k in row["keys"]):
        found.append(f"{name}: no keys")
    if not row["sequence_by"]:
        found.append(f"{name}: no sequence column")
    for kind in ("derived", "rules"):
        names = [entry[0] for entry in row[kind] or ()]
        found += [f"{name}: {kind} name {n!r} occurs twice" for n in sorted({n for n in names if names.count(n) > 1}, key=str)]
    for rule, predicate, action in row["rules"] or ():
        try:
            Rule(rule, predicate, action)
        except ValueError as error:
            found.append(f"{name}: {error}")
    return found


def load_specs(table: DataFrame) -> tuple[TableSpec, ...]:
    """The entities of a table with the columns of ``SCHEMA``, in the order of their names.

    Columns the table lacks count as NULL. All that is wrong with any row is told in one
    ``SpecError``. The table has a row for each entity and goes to the driver.
    """
    wanted = T.StructType.fromDDL(SCHEMA)
    have = set(table.columns)
    rows = table.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])
    found = [row.asDict() for row in rows.orderBy("name").collect()]
    problems = [problem for row in found for problem in _problems(row)]
    names = [row["name"] for row in found]
    problems += [f"entity {n!r} occurs twice" for n in sorted({n for n in names if names.count(n) > 1}, key=str)]
    if problems:
        raise SpecError(problems)
    return tuple(_spec(row) for row in found)


def _spec(row: dict) -> TableSpec:
    parts = {
        "filters": tuple(row["filters"] or ()),
        "derived": tuple((n, e) for n, e in row["derived"] or ()),
        "dropped": tuple(row["dropped"] or ()),
    }
    return TableSpec(
        name=row["name"],
        keys=tuple(row["keys"]),
        sequence_by=row["sequence_by"],
        clean=partial(clean, **parts),
        rules=tuple(Rule(n, p, a) for n, p, a in row["rules"] or ()),
        tie_break=None if row["tie_break"] is None else tuple(row["tie_break"]),
        raw_layout=tuple(row["raw_layout"] or ()),
        layout=tuple(row["layout"] or ()),
        comments=row["comments"] or {},
        delete_when=row["delete_when"],
        keep_history=bool(row["keep_history"]),
        buckets=row["buckets"],
    )


def check_specs(specs: Sequence[TableSpec], changes: Callable[[str], DataFrame]) -> None:
    """Hold entities against the columns of their changes: expressions that are no SQL, that name a
    column nobody has, that are no conditions, or that need more than one row (an aggregate, a window) are told in one
    ``SpecError``, and so are keys, sequence and layout columns that are not there."""
    problems = []
    for spec in specs:
        raw = changes(spec.name).limit(0)
        try:
            rows = spec.clean(raw)
            names = set(rows.columns)
        except AnalysisException as error:
            problems.append(f"{spec.name}: {str(error).splitlines()[0]}")
            continue
        asked = [*spec.keys, spec.sequence_by, *(spec.tie_break or ()), *spec.layout]
        problems += [f"{spec.name}: there is no column {c!r}" for c in dict.fromkeys(asked) if c not in names]
        conditions = [(rows, rule.predicate) for rule in spec.rules]
        conditions += [(raw, spec.delete_when)] if spec.delete_when else []
        for frame, condition in conditions:
            try:
                frame.filter(F.expr(condition)).schema  # noqa: B018 - analysed here
            except AnalysisException as error:
                problems.append(f"{spec.name}: {condition!r}: {str(error).splitlines()[0]}")
    if problems:
        raise SpecError(problems)
