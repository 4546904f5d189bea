"""Operators of a training-data pipeline over text, pages and vectors.

Every operator takes and returns DataFrames. Their queries are registered in
``airdata.llm.queries``; nothing else in the library imports this subpackage.
"""
