"""presslens: press-coverage analytics as Spark DataFrame jobs.

Sub-packages
------------
functions   native Column expressions (URL canonicalisation, HTML text, dates, tokens)
sources     table readers and adapters that turn input tables into article rows
operators   reusable DataFrame operators (dedup, clean, upsert, top-k, neighbours, ...)
plans       registered analytical queries, each paired with an independent SQL oracle
streaming   Structured Streaming jobs over the article stream
"""

__all__ = ["session"]
