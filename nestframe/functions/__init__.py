"""Column functions."""

from nestframe.functions.keys import child_key, row_key
from nestframe.functions.nested import nan_as_null
from nestframe.functions.predicates import any_item_equals, equals

__all__ = ["any_item_equals", "child_key", "equals", "nan_as_null", "row_key"]
