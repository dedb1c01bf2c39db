"""Named steps run in order; the first failure ends the run.

Destructive work is always two steps: a plan, which is a table, and its
application, which gives a new snapshot.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import curate, merge, publish


@dataclass
class Run:
    """Tables by name, and the names of the steps that are done."""

    tables: dict[str, DataFrame]
    done: list[str] = field(default_factory=list)


Step = tuple[str, Callable[[dict[str, DataFrame]], dict[str, DataFrame]]]


def run(steps: list[Step], tables: dict[str, DataFrame]) -> Run:
    state = Run(dict(tables))
    for name, step in steps:
        state.tables.update(step(state.tables))
        state.done.append(name)
    return state


PREP: list[Step] = [
    ("prepare", lambda t: {"prepared": curate.prepare(t["intake"], t["live"], t["denied"])}),
    ("flag", lambda t: {"flags": curate.flags(t["prepared"])}),
    ("cluster", lambda t: {"clusters": merge.cluster_rows(t["prepared"].where("disposition <> 'Dropped'"))}),
    ("merge", lambda t: {"merged": merge.merge_rows(t["prepared"].where("disposition <> 'Dropped'"), t["clusters"])}),
]
MAINTAIN: list[Step] = [
    ("plan", lambda t: {"plan": merge.merge_plan(t["live"])}),
    ("clean", lambda t: {"clean": curate.clean_plan(t["live"])}),
    ("purge", lambda t: {"purge": curate.purge_plan(t["live"])}),
]
PUBLISH: list[Step] = [
    ("slugs", lambda t: {"slugs": publish.assign_slugs(t["live"])}),
    ("pages", lambda t: {"pages": publish.changed_pages(publish.page_records(t["live"], t["slugs"]), t.get("manifest"))}),
]
