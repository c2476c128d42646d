"""tillstar: point-of-sale feeds into a star schema, on Spark.

Entry points: ``tillstar.plans.load.load_batch`` (batch load),
``tillstar.streaming.ingest.ingest`` (file stream), ``tillstar.plans.audit``
(per-batch audit), ``tillstar.operators.flat`` (flat variant),
``tillstar.functions.pgtypes`` (Postgres column types), and the command line
``python -m tillstar``.
"""

__version__ = "0.1.0"
