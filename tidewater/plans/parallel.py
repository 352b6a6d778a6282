"""Independent Spark actions submitted side by side from driver threads."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Dict


def run_jobs(tasks: Dict[str, Callable[[], object]], concurrent: bool = True) -> dict:
    """Run independent Spark actions, each from its own driver thread.

    Spark schedules jobs of one session concurrently: the tasks of the five
    Gold aggregates share the executors, so a job in its small final stage
    does not leave the cluster idle. Only job handles pass through the
    driver; the first failure is raised (the others still finish). Results
    keep the order of ``tasks``.
    """
    if not concurrent or len(tasks) < 2:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=len(tasks), thread_name_prefix="tidewater-job") as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}
