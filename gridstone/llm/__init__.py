"""Operators for preparing training text: ten operators over ``documents``.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries`` holds the thin ``opN_<name>`` queries.
"""
