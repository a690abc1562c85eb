from fieldnorm.sources.catalog import (
    WorkTableError,
    columns_of,
    create_empty_like,
    rename,
    require_absent,
    require_text_columns,
    same_schema,
    schema_profile,
    text_literal,
)
from fieldnorm.sources.jdbc import append_batch, hash_predicates, jdbc_count, quantile_predicates, read_jdbc, write_jdbc

__all__ = [
    "WorkTableError",
    "append_batch",
    "columns_of",
    "create_empty_like",
    "hash_predicates",
    "jdbc_count",
    "quantile_predicates",
    "read_jdbc",
    "rename",
    "require_absent",
    "require_text_columns",
    "same_schema",
    "schema_profile",
    "text_literal",
    "write_jdbc",
]
