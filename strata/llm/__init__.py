"""Training-data operators: filters, near-duplicates, mixing, sharding, token output.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries only when it can be imported.
"""
