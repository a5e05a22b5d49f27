"""basketry: grocery basket and reorder analytics as Spark DataFrame plans.

Sub-packages:

- ``sources``   readers for the five order tables (CSV layout and the TPC-H test
                fixtures), table scopes, writers.
- ``functions`` column-level helpers: R-style NA rules, text formatting,
                size-checked broadcast, the binary encoder.
- ``operators`` DataFrame -> DataFrame operators: profiling, basket mining,
                features, split, model, evaluation, recommendation lists.
- ``plans``     end-to-end plans for the three analyses and the registry of
                named queries used by ``__spark_entry__``.
- ``streaming`` intentionally empty (no streaming operator exists upstream).
"""

__version__ = "0.1.0"
