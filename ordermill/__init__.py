"""ordermill: a PySpark toolkit for retail order data.

Batch and stream ingest (validate, route errors, deduplicate, upsert), a layered
model (staging -> intermediate -> marts), reports, data-quality checks and
governed views.  Every operator is a function from DataFrames to a DataFrame so
that Catalyst sees one plan from the raw scan to the report.
"""

__version__ = "0.1.0"
