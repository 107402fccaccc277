"""gridmix — electricity carbon-footprint analytics on Spark DataFrames.

Layers (each a plain ``DataFrame -> DataFrame`` function, composed lazily so
Catalyst sees one plan per job):

* ``gridmix.sources``   landed files / feeds -> bronze frames, sinks
* ``gridmix.functions`` column expressions (cleaning, calendar, CO2 KPIs)
* ``gridmix.operators`` dedup, upsert, incremental merge, column sync, checks
* ``gridmix.plans``     staging -> enriched -> marts, dashboard queries, registry
* ``gridmix.streaming`` Structured Streaming ingestion and half-hour windows
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
