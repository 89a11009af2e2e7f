"""Jobs in a row: what each needs is checked before anything is written, and counters are gathered while it is written."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation

from . import relational as R


@dataclass
class Job:
    """name; build: from the tables there are, by name, to the new table; needs: of each table read, the headers it must have (any of each tuple); counters: over the new table's rows."""

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    needs: dict[str, list[tuple[str, ...]]] = field(default_factory=dict)
    counters: dict[str, Column] = field(default_factory=dict)


class Missing(ValueError):
    pass


def check(jobs: list[Job], tables: dict[str, DataFrame]) -> None:
    """Raise, before any job runs, what they need and what neither a table nor an earlier job gives."""
    made, wrong = set(), []
    for job in jobs:
        for name, headers in job.needs.items():
            if name in made:
                continue  # its columns are known once it is built
            if name not in tables:
                wrong.append(f"{job.name}: no table {name}")
                continue
            there = {R.normalize_header(x) for x in tables[name].columns}
            wrong += [f"{job.name}: {name} lacks {' | '.join(any_of)}" for any_of in headers if not there & {R.normalize_header(x) for x in any_of}]
        made.add(job.name)
    if wrong:
        raise Missing("; ".join(wrong))


def run(jobs: list[Job], tables: dict[str, DataFrame], write: Callable[[str, DataFrame], DataFrame]) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """(all tables after the jobs; by job its counters and seconds). ``write`` stores a table and gives it back; a job's counters come from that one pass."""
    check(jobs, tables)
    tables, said = dict(tables), {}
    for job in jobs:
        check([job], tables)
        began, new, seen = time.monotonic(), job.build(tables), None
        if job.counters:
            seen = Observation(job.name)
            new = new.observe(seen, *[x.alias(k) for k, x in job.counters.items()])
        tables[job.name] = write(job.name, new)
        said[job.name] = {**(seen.get if seen else {}), "seconds": time.monotonic() - began}
    return tables, said
