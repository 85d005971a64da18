"""What fits of many small passes over the same rows share."""

from __future__ import annotations

import gc


def settle_worker() -> None:
    """Called in a task: take what its Python worker has loaded by now out of garbage collection.

    Spark collects garbage in a reused worker after every task, before the
    worker is free again; a walk through all loaded modules takes 20 to 30 ms,
    more than a small pass computes. Done once a worker; objects made later
    are collected as before."""
    if not gc.get_freeze_count():
        gc.freeze()
