"""Vulnerability-record curation as Spark DataFrame transformations.

Stages are ``DataFrame -> DataFrame`` functions built from built-in column
expressions: normalise two sources, merge with source precedence, score,
filter into routes, sample per severity, isolate post-cutoff records and
summarise. See ``vulnsift.plans`` for the end-to-end compositions.
"""

from vulnsift.config import DEFAULT_CONFIG, CurationConfig

__all__ = ["CurationConfig", "DEFAULT_CONFIG"]
