"""ledgerflow — card-transaction analytics expressed as PySpark DataFrame plans.

Layers (each a plain ``DataFrame -> DataFrame`` function or ``Column`` builder):

* ``functions``  – column expressions (JSON payload parsing, tiers, keys, predicates)
* ``sources``    – readers, landing writer, idempotent loader, catalog, fixtures
* ``operators``  – dedupe, batch transform, staging, events join, daily fact,
                   merge, schema sync, data-quality rules
* ``plans``      – run modes: full refresh, incremental look-back, late-settlement
                   redo, the chained hourly run
* ``streaming``  – Structured Streaming forms of ingest, dedupe, linking, merge
"""

__version__ = "0.1.0"
