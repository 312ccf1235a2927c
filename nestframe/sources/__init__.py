"""Reading and writing documents and their tables."""

from nestframe.sources.catalog import (
    create_tables,
    insert,
    list_tables,
    load_tables,
    save_tables,
    table_schema,
)
from nestframe.sources.database import key_slices, read_database, write_database
from nestframe.sources.documents import parse_documents, read_documents
from nestframe.sources.store import Store, create_store, open_store
from nestframe.sources.streams import store_batch, store_stream

__all__ = [
    "Store",
    "create_store",
    "create_tables",
    "insert",
    "key_slices",
    "list_tables",
    "load_tables",
    "open_store",
    "parse_documents",
    "read_database",
    "read_documents",
    "save_tables",
    "store_batch",
    "store_stream",
    "table_schema",
    "write_database",
]
