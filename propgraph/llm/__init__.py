"""Training-data operators: sharding, deduplication, scans, WARC, toxicity,
SentencePiece, benchmark decontamination, conversation repair, source
divergence and personal data.

Nothing outside this package imports it (``__spark_entry__`` adds its queries
only when the package is there). Each module holds one operator; ``queries``
holds the thin registered queries and ``oracle`` their DuckDB SQL.
"""
