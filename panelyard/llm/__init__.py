"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this subpackage; its queries are in
``queries.py``.  Shared conventions: documents are rows of any DataFrame that
has the named columns (further columns are ignored or carried along), words are
maximal runs of bytes other than space and ``\\t\\n\\v\\f\\r``, and null text is
empty text.  Intermediate tables go to the folder of ``spark.checkpoint.dir``.
"""
