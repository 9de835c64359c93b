"""Review and context data jobs on PySpark: ingestion, cleaning, near-duplicate
clustering, page text, context chunks, feature tables and streaming upserts."""
