"""Operators for large training-data pipelines; each module holds one operator and its docstring its contract."""
