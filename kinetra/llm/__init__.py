"""Training-data operators: corpus operators and their queries.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries only when it is present.
"""
