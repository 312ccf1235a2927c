"""Nested documents in relational form, on Spark."""

from nestframe.functions import any_item_equals, equals, nan_as_null
from nestframe.operators import (
    Condition,
    absent_rows,
    assemble,
    audit_foreign_key,
    audit_model,
    audit_not_null,
    audit_primary_key,
    canonical,
    canonical_tables,
    conform,
    count_documents,
    difference,
    fetch,
    fetch_by_id,
    flatten,
    flatten_aligned,
    flatten_branches,
    having,
    join_renamed,
    locate_differences,
    matching_keys,
    owner_keys,
    required_columns,
    restrict,
    shred,
    shred_once,
    table_counts,
    text_output,
)
from nestframe.operators.durable import durable
from nestframe.plans import DocumentTables, Table, field, model_schema, spark_type, table_layout
from nestframe.sources import (
    create_store,
    create_tables,
    insert,
    list_tables,
    load_tables,
    open_store,
    parse_documents,
    read_database,
    read_documents,
    save_tables,
    store_stream,
    write_database,
)

__all__ = [
    "Condition",
    "DocumentTables",
    "Table",
    "absent_rows",
    "any_item_equals",
    "assemble",
    "audit_foreign_key",
    "audit_model",
    "audit_not_null",
    "audit_primary_key",
    "canonical",
    "canonical_tables",
    "conform",
    "count_documents",
    "create_store",
    "create_tables",
    "difference",
    "durable",
    "equals",
    "fetch",
    "fetch_by_id",
    "field",
    "flatten",
    "flatten_aligned",
    "flatten_branches",
    "having",
    "insert",
    "join_renamed",
    "list_tables",
    "load_tables",
    "locate_differences",
    "matching_keys",
    "model_schema",
    "nan_as_null",
    "open_store",
    "owner_keys",
    "parse_documents",
    "read_database",
    "read_documents",
    "required_columns",
    "restrict",
    "save_tables",
    "shred",
    "shred_once",
    "spark_type",
    "store_stream",
    "table_counts",
    "table_layout",
    "text_output",
    "write_database",
]
