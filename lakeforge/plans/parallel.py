"""Concurrent submission of independent Spark jobs from driver threads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor


def concurrently(tasks: Sequence[Callable[[], object]]) -> list[object]:
    """Run independent job-submitting callables at once and wait for all.

    Spark schedules the concurrent jobs on the shared executors, so small
    jobs (few tasks each) no longer leave most of the cluster idle.  Results
    keep the order of ``tasks``; the first failure is re-raised.
    """
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]
