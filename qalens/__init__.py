"""qalens — per-tag answer-latency reports for Q&A dumps, built on Spark DataFrames.

Layout:

* ``sources``   — text-line scan, header strip, strict line ingest, table views
* ``functions`` — Column-expression helpers (strict parsing, elapsed minutes, rendering)
* ``operators`` — joins, the skew-safe nearest-answer scan, aggregates, sort
* ``plans``     — the two reports built on one shared per-tag aggregate
* ``sinks``     — text output in tuple form
* ``streaming`` — intentionally empty (the reference job is batch only)
* ``job``       — ``run(...)`` batch entry and ``spark-submit`` module
"""

from qalens.model import QAData

__all__ = ["QAData"]
