"""quayside: AIS vessel-position analytics as Spark DataFrame / SQL / Structured Streaming plans.

Entry points: :class:`quayside.plans.tables.Tables` (every layer as a lazy DataFrame),
``quayside.plans.kpis`` / ``dashboard`` (KPI and roll-up queries), ``quayside.operators``
(region, fact, join, track and exploration operators), ``quayside.pipeline`` (filter,
transform and export runs on real archives) and ``quayside.streaming.ingest``.
"""

__version__ = "0.1.0"
