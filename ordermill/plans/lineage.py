"""The model graph as data: which model reads which.

Edges are not declared; they are taken from the models' own code, by building
the lazy plans once and noting which input each model asks for.  They serve two
uses: a table of edges, and the models to build again when raw tables changed,
in an order in which inputs come first.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ordermill.plans.model import Models
from ordermill.schemas import RAW_TABLES
from ordermill.sources.files import read_table
from ordermill.sources.snapshots import SnapshotTable


class _Noting:
    """A lookup of raw tables that notes what is asked of it."""

    def __init__(self, raw, note):
        self.raw, self.note = raw, note

    def __getitem__(self, name: str) -> DataFrame:
        self.note(name)
        return self.raw[name]

    def order_dates(self) -> DataFrame:
        for name in ("orders_batch", "orders_stream"):
            self.note(name)
        return self.raw.order_dates()


class TracedModels(Models):
    """The models over raw tables, with the edges (model, input) seen so far."""

    def __init__(self, raw):
        self.edges, self._open = set(), []
        super().__init__(_Noting(raw, lambda name: self.edges.add((self._open[-1], name))))

    def __getattribute__(self, name: str):
        if name not in Models.VIEW_LAYERS:
            return super().__getattribute__(name)
        if self._open:
            self.edges.add((self._open[-1], name))
        self._open.append(name)
        try:
            return super().__getattribute__(name)
        finally:
            self._open.pop()


def model_edges(raw, reports: dict | None = None) -> list[tuple[str, str]]:
    """(model, input) of every model layer over ``raw``, and of ``reports``
    (name: (function, dimensions) over the fact)."""
    traced = TracedModels(raw)
    for layer in Models.VIEW_LAYERS:
        getattr(traced, layer)
    of_reports = {(name, x) for name, (_, dims) in (reports or {}).items() for x in ("fact_orders", *dims)}
    return sorted(traced.edges | of_reports)


def downstream(edges: list[tuple[str, str]], changed: set[str]) -> list[str]:
    """Models that read a changed one, near or far, inputs before their readers."""
    reached, grew = set(changed), True
    while grew:
        more = {model for model, source in edges if source in reached} - reached
        reached |= more
        grew = bool(more)
    order, todo = [], sorted(reached - set(changed))
    while todo:
        ready = [m for m in todo if not any(model == m and source in todo for model, source in edges)]
        if not ready:
            raise ValueError(f"models read each other: {todo}")
        order += ready
        todo = [m for m in todo if m not in ready]
    return order


def fingerprint(spark: SparkSession, path: str) -> str:
    """What changes with every write to a stored table: the version of a
    snapshot table, or the names of a folder's files (no write reuses one)."""
    table = SnapshotTable(spark, path)
    if table.exists():
        return f"version {table.versions()[-1]}"
    rows = read_table(spark, path)
    names = [] if rows is None else sorted(rows.inputFiles())
    return hashlib.md5("\n".join(names).encode()).hexdigest()


def raw_fingerprints(spark: SparkSession, raw_root: str) -> dict[str, str]:
    return {name: fingerprint(spark, f"{raw_root.rstrip('/')}/{name}") for name in RAW_TABLES}
