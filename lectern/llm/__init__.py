"""Training-data operators (``opN``): sharding, deduplication, language ID, packing, scoring.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it is there.
"""
