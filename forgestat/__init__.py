"""forgestat — software-project activity analytics on Spark.

Layers (each a set of DataFrame-returning functions, no hidden reads):

* ``sources``    bronze schemas, landing JSON reads, flattening, child tables,
                 incremental cursors and merge / append / replace writes;
                 adapters that give the driver's tables the bronze shape.
* ``functions``  Column helpers (surrogate keys, hour boundaries, calendar parts,
                 bot flag, size-checked broadcast).
* ``operators``  staging, intermediate, dimension, fact and metric models, and
                 data-quality checks that return their failing rows.
* ``plans``      the warehouse DAG wiring and the analytical queries.
* ``streaming``  Structured Streaming form of the ingest and live counts.
"""

from forgestat.params import WarehouseParams

__all__ = ["WarehouseParams"]
