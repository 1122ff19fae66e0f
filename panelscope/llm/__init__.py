"""Operators for large-scale training-data pipelines.

Each module is one operator; :mod:`panelscope.llm.queries` registers one query
per operator.  Nothing outside this subpackage imports it.
"""
