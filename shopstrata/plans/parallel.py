"""Independent writes submitted side by side, so that small jobs do not wait for each other."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any


def in_parallel(*steps: Callable[[], Any]) -> list[Any]:
    """Run independent Spark actions from several driver threads; results in order.

    All steps are waited for, then the first error is raised.
    """
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(step) for step in steps]
    return [f.result() for f in futures]
