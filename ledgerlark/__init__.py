"""ledgerlark: credit-history analytics as distributed Spark DataFrame operators.

Subpackages:
  functions  -- column helpers that pin the reference dialect's semantics
  sources    -- raw table loaders and the test-data fixture views
  operators  -- staging, features, marts, reports, audits, checks, ntile
  plans      -- the model catalog (DAG), query registry, sinks
  streaming  -- incremental staging over file streams
  oracle     -- DuckDB text of every query, for the correctness gate
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
