"""cardwatch: card-transaction risk analytics expressed as Spark DataFrame jobs.

Sub-packages
  functions  column-expression helpers (time arithmetic, rounding, hour-of-day)
  sources    table/stream readers, JSON codec, idempotent sinks, fixtures
  operators  rules, velocity, verdicts, validation, enrichment, feedback
  plans      reports and the registered query catalog
  streaming  Structured Streaming jobs built from the same operators
"""

__version__ = "0.1.0"
