"""Layer transformations as pure DataFrame functions (no I/O).

``bronze -> silver`` is F1, F2 and P4-P6; ``wire -> silver`` chains the
Bronze projection in front. The jobs in ``plans.jobs`` add
the reads and writes; the registered queries call these directly on data
Spark derives from the supplied tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.enrich import enrich_silver
from ..operators.quality import dedupe_events, drop_unparsed
from ..operators.wire import bronze_from_wire


def silver_from_bronze(bronze: DataFrame, clock=None, fast_dedupe: bool = False) -> DataFrame:
    """F1 (before the shuffle) -> F2 -> P5, P6, P4."""
    return enrich_silver(dedupe_events(drop_unparsed(bronze), fast=fast_dedupe), clock)


def silver_from_wire(wire: DataFrame, clock=None, fast_dedupe: bool = False) -> DataFrame:
    return silver_from_bronze(bronze_from_wire(wire, clock), clock, fast_dedupe)
