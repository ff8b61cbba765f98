"""Corpus preparation for language-model training: thirteen operators on Spark.

Nothing outside this package imports it.  Each module holds one operator;
``queries`` registers the ``opN_<name>`` queries, ``oracle`` their SQL.
"""
