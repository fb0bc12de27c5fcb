"""Submit independent Spark jobs from several driver threads.

Spark schedules jobs from different threads concurrently, so small outputs
that do not depend on each other (a summary file and a histogram file) share
the cluster instead of queueing behind one another.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_all(*tasks: Callable[[], object]) -> list:
    """Run the callables concurrently; return their results in order, re-raising the first error."""
    if len(tasks) == 1:
        return [tasks[0]()]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]
