"""How a nested model maps to flat tables."""

from nestframe.plans.layout import Kind, Table, table_layout
from nestframe.plans.model import field, model_schema, spark_type
from nestframe.plans.tables import DocumentTables

__all__ = [
    "DocumentTables",
    "Kind",
    "Table",
    "field",
    "model_schema",
    "spark_type",
    "table_layout",
]
