"""Operators for preparing large training corpora.

Nothing else in the library imports this subpackage.  Every operator takes
and returns DataFrames; ``queries`` holds the registered thin queries and
``oracle`` their DuckDB SQL.
"""
