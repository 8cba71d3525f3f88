"""Operators for preparing training data at scale, and their registered queries (``queries.py``)."""
