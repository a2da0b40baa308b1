"""cdcmart: from row-level change events to sales reports, as Spark jobs.

Layers (each a module of plain functions from DataFrames to DataFrames):

* ``sources``    change logs in, typed table specs, batch publishing out
* ``functions``  column expressions: money, time, wire values, text
* ``operators``  current state, typed change tables, quarantine, skew-safe joins,
                 as-of costs, order pricing and lifecycle, data quality
* ``plans``      cleaned entities, dimensions, facts, reports
* ``streaming``  Structured Streaming ingestion and live current state
"""

from cdcmart.plans.warehouse import Warehouse
from cdcmart.session import build_session, configure

__all__ = ["Warehouse", "build_session", "configure"]
