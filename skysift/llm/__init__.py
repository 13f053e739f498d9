"""Operators for large-scale training-data preparation.

Nothing else in skysift imports this subpackage.
"""
