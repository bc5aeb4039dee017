"""Training-data operators: ten corpus operators and their registered queries.

Nothing else in the library imports this package; ``registry`` lists its
queries and oracles, ``corpus_pipeline`` (repository top) chains five of them.
"""
