"""Column-expression helpers (built-in Spark functions only)."""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_session(fn):
    """Reuse the Column a builder returns for the lifetime of the SparkContext.

    Columns are immutable, unresolved expression trees, so one instance can
    serve any number of DataFrames; caching them saves the thousands of
    gateway calls it takes to assemble the larger expressions (scoring, date
    parsing) for every query. Arguments must be hashable. Without a classic
    SparkContext (e.g. Spark Connect) nothing is cached.
    """

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        sc = SparkContext._active_spark_context
        if sc is None:
            return fn(*args, **kwargs)
        store = sc.__dict__.setdefault("_vulnsift_columns", {})
        key = (fn.__module__, fn.__qualname__, args, tuple(sorted(kwargs.items())))
        col = store.get(key)
        if col is None:
            col = store[key] = fn(*args, **kwargs)
        return col

    return wrapper
