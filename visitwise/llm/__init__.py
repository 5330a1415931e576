"""Operators for training-data pipelines.

Each module holds one operator on a generic table of texts (or vectors);
``queries`` applies them to the driver's tables. Nothing outside this
subpackage imports it.
"""
