"""Timing and schema output of the jobs."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field


@dataclass
class JobReport:
    """What a job did. ``rejects`` counts input values lost by lenient parsing.

    ``months`` is the number of months written, where only changed ones are.

    The counts are observed while the job writes; they describe the run and decide
    nothing, since a task that runs twice may be counted twice.
    """

    job: str
    seconds: float = 0.0
    rows_read: int = 0
    months: int | None = None
    rejects: dict[str, int] = field(default_factory=dict)


@contextmanager
def timed(report: JobReport) -> Iterator[JobReport]:
    start = time.perf_counter()
    yield report
    report.seconds = time.perf_counter() - start
    print(f"job {report.job} took {report.seconds:.1f} seconds")
