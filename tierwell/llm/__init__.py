"""Operators of a training-data pipeline over `documents` and `conversations`.

Nothing outside this folder imports it. Each module holds one operator with its general interface;
`queries.py` derives the contract columns of the check queries from them.
"""
