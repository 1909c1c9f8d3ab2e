"""Operators for preparing training text at scale.

One module per operator; ``queries`` holds the thin registered queries and
``oracle`` their SQL.  Nothing else in the library imports this subpackage.
"""
