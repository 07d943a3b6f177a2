"""Training-data operators (tokenising, language, duplicates, search, scoring, packing, archives).

Nothing outside this subpackage imports it but :mod:`veriflume.llm.common` (scratch tables of verification). Every operator takes DataFrames and returns DataFrames; the thin
``opN_*`` queries over the driver tables are in :mod:`veriflume.llm.queries`.
"""
