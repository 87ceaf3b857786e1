"""Operators of a training-data pipeline over document tables (see ``README.md``, "Training data").

Nothing else in ``quarry`` imports this subpackage. One operator per module; ``queries.py``
registers the ``opN_*`` queries and ``oracle.py`` holds their SQL.
"""
