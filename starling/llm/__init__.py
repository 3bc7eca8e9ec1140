"""Training-data pipeline operators (license scan, decontamination, WARC, LM scoring, line
quality, packing, sharding, language ID, quality scoring, n-gram Jaccard join).

Nothing else in the library imports this subpackage.  ``starling.llm.queries`` binds one
``opN_<name>`` query per operator to the test tables.
"""
