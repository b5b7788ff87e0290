"""Training-data operators: decontamination, packing, language and quality models, near-duplicates, WARC, sharding.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
