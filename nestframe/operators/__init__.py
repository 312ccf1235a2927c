"""Operators on nested documents and their flat tables."""

from nestframe.operators.align import flatten_aligned
from nestframe.operators.append import absent_rows
from nestframe.operators.assemble import assemble
from nestframe.operators.audit import (
    audit_foreign_key,
    audit_model,
    audit_not_null,
    audit_primary_key,
    difference,
    required_columns,
    table_counts,
)
from nestframe.operators.conform import conform, text_output
from nestframe.operators.fetch import fetch, fetch_by_id, owner_keys
from nestframe.operators.flatten import flatten, flatten_branches, join_renamed
from nestframe.operators.patterns import Condition, matching_keys
from nestframe.operators.locate import digest_tree, locate_differences
from nestframe.operators.pieces import canonical, canonical_tables, count_documents, having
from nestframe.operators.restrict import restrict
from nestframe.operators.shred import shred
from nestframe.operators.shred_once import shred_once

__all__ = [
    "Condition",
    "absent_rows",
    "assemble",
    "audit_foreign_key",
    "audit_model",
    "audit_not_null",
    "audit_primary_key",
    "canonical",
    "canonical_tables",
    "conform",
    "count_documents",
    "difference",
    "digest_tree",
    "fetch",
    "fetch_by_id",
    "flatten",
    "flatten_aligned",
    "flatten_branches",
    "having",
    "join_renamed",
    "locate_differences",
    "matching_keys",
    "owner_keys",
    "required_columns",
    "restrict",
    "shred",
    "shred_once",
    "table_counts",
    "text_output",
]
