"""Plans as ordered, named transforms. Unknown names are errors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..functions.text import is_junk
from ..operators import density, keywords, lines, reconcile, structure
from ..sources.shared import written

Transform = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]
_STEPS: dict[str, Transform] = {}


def step(name: str) -> Callable[[Transform], Transform]:
    """Registers a transform: it takes the relations so far, by name, and gives
    those that it adds or replaces."""

    def put(f: Transform) -> Transform:
        if name in _STEPS:
            raise ValueError(f"step {name} is registered twice")
        _STEPS[name] = f
        return f

    return put


def names() -> list[str]:
    return list(_STEPS)


def run(steps: Sequence[str], relations: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The relations after all steps, over all documents at once. Relations that
    several later steps read (lines, cells) are written where they are made."""
    unknown = [s for s in steps if s not in _STEPS]
    if unknown:
        raise KeyError(f"unknown steps: {', '.join(unknown)}")
    for s in steps:
        relations = relations | _STEPS[s](relations)
    return relations


#: Boxes with recognised words to corrected tables.
TABLES = ("clean", "lines", "tabular", "header", "cells", "reconcile")


@step("clean")
def _clean(r):
    p = r["polygons"]
    return {"polygons": p.where(~is_junk(p["ocr_text"], p["confidence"]))}


@step("lines")
def _lines(r):
    assigned = written(lines.assign(r["polygons"]), "assigned")
    return {"assigned": assigned, "lines": lines.lines(assigned)}


@step("tabular")
def _tabular(r):
    labels = density.clusters(density.scaled(density.features(r["lines"], 480_000.0)))
    return {"lines": written(density.mark_tabular(r["lines"], density.tabular_interval(labels)), "lines")}


@step("header")
def _header(r):
    return {"header": structure.header_before(r["lines"])}


@step("keyword_header")
def _keyword_header(r):
    return {"header": keywords.header_lines(r["assigned"], keywords.lexicon(r["assigned"].sparkSession))}


@step("cells")
def _cells(r):
    keep = r["lines"].where("tabular_line").select("doc_id", "line_no").unionByName(r["header"].selectExpr("doc_id", "header_line AS line_no")).distinct()
    return {"cells": written(structure.cells(r["assigned"].join(keep, ["doc_id", "line_no"], "left_semi"), r["header"]), "cells")}


@step("reconcile")
def _reconcile(r):
    return {"cells": reconcile.reconcile(r["cells"])}


@step("reconcile_documented")
def _reconcile_documented(r):
    return {"cells": reconcile.reconcile(r["cells"], "documented", keep_fills=True)}
