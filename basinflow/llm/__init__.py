"""Training-data operators: filtering, deduplication, redaction, packing, search, archives.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and returns
DataFrames; the thin ``opN_*`` queries that apply them to the driver's tables are in
:mod:`basinflow.llm.queries`.
"""
