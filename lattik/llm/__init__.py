"""Training-data operators (near-dedup, extraction, filters, tokenising, sharding, audit).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries only when it is present.
"""
