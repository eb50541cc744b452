"""Training-data operators: ten text operators over documents, pages and labels.

Nothing outside this subpackage imports it.  Each operator lives in its own
module and takes and returns DataFrames; ``queries`` binds them to the tables.
"""
