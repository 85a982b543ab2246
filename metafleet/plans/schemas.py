"""Declared schemas of catalog datasets: every column with its type, and the version that it came with."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Schema:
    """``columns``: DDL of the columns that every version has. ``added``: DDL of those that came with a major version."""

    columns: str
    added: tuple[tuple[int, str], ...] = ()

    def struct(self) -> T.StructType:
        """All columns, the oldest first."""
        fields = list(T.StructType.fromDDL(self.columns).fields)
        for _, ddl in self.added:
            fields += T.StructType.fromDDL(ddl).fields
        return T.StructType(fields)

    def since(self) -> dict[str, int]:
        """The version that each later column came with."""
        return {f.name: version for version, ddl in self.added for f in T.StructType.fromDDL(ddl).fields}


# Columns, types and versions of the source's catalog views.
SCHEMAS = {
    "objects": Schema("name string, object_id int, principal_id int, schema_id int, parent_object_id int, type string, type_desc string, create_date timestamp_ntz, is_ms_shipped boolean, is_published boolean, is_schema_published boolean"),
    "views": Schema(
        "name string, object_id int, schema_id int, type string, is_ms_shipped boolean, with_check_option boolean, is_date_correlation_view boolean, is_tracked_by_cdc boolean",
        ((15, "has_snapshot boolean"), (16, "ledger_view_type smallint, ledger_view_type_desc string, is_dropped_ledger_view boolean")),
    ),
    "stats": Schema(
        "object_id int, name string, stats_id int, auto_created boolean, user_created boolean, no_recompute boolean, has_filter boolean, filter_definition string, is_temporary boolean, is_incremental boolean",
        ((15, "has_persisted_sample boolean, stats_generation_method int, stats_generation_method_desc string"), (16, "auto_drop boolean")),
    ),
    "indexes": Schema(
        "object_id int, name string, index_id int, type smallint, type_desc string, is_unique boolean, data_space_id int, is_primary_key boolean, is_unique_constraint boolean, fill_factor smallint, is_disabled boolean, has_filter boolean, filter_definition string",
        ((15, "optimize_for_sequential_key boolean"),),
    ),
    "columns": Schema(
        "object_id int, name string, column_id int, system_type_id smallint, user_type_id int, max_length smallint, precision smallint, scale smallint, collation_name string, is_nullable boolean, is_identity boolean, is_computed boolean",
        ((16, "is_data_deletion_filter_column boolean, ledger_view_column_type int, ledger_view_column_type_desc string, is_dropped_ledger_column boolean"),),
    ),
    "index_columns": Schema("object_id int, index_id int, index_column_id int, column_id int, key_ordinal smallint, partition_ordinal smallint, is_descending_key boolean, is_included_column boolean", ((15, "column_store_order_ordinal smallint"),)),
    "partitions": Schema("partition_id bigint, object_id int, index_id int, partition_number int, hobt_id bigint, rows bigint, data_compression smallint, data_compression_desc string", ((16, "xml_compression boolean, xml_compression_desc string"),)),
    "computed_columns": Schema(
        "object_id int, name string, column_id int, definition string, uses_database_collation boolean, is_persisted boolean",
        ((16, "is_data_deletion_filter_column boolean, ledger_view_column_type int, ledger_view_column_type_desc string, is_dropped_ledger_column boolean"),),
    ),
    "foreign_keys": Schema("name string, object_id int, schema_id int, parent_object_id int, type string, referenced_object_id int, key_index_id int, is_disabled boolean, is_not_trusted boolean, delete_referential_action smallint, update_referential_action smallint, is_ms_shipped boolean"),
    "foreign_key_columns": Schema("constraint_object_id int, constraint_column_id int, parent_object_id int, parent_column_id int, referenced_object_id int, referenced_column_id int"),
    "key_constraints": Schema("name string, object_id int, schema_id int, parent_object_id int, type string, unique_index_id int, is_system_named boolean, is_ms_shipped boolean"),
    "check_constraints": Schema("name string, object_id int, schema_id int, parent_object_id int, type string, parent_column_id int, definition string, is_disabled boolean, is_ms_shipped boolean"),
    "triggers": Schema("name string, object_id int, parent_class smallint, parent_id int, type string, is_ms_shipped boolean, is_disabled boolean, is_instead_of_trigger boolean"),
    "dm_io_virtual_file_stats": Schema("database_id int, file_id int, num_of_reads bigint, num_of_bytes_read bigint, num_of_writes bigint, num_of_bytes_written bigint", ((16, "num_of_pushed_reads bigint, num_of_pushed_bytes_returned bigint"),)),
}


def versioned(df: DataFrame, schema: Schema, version: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of scopes of many versions in the declared columns, in one pass; ``keep`` are columns that go before them.

    A column that came with a later version than a row's is null there, whatever stands in it. A column that isn't declared raises, so that
    a new one is noticed; declared ones that the landed table lacks are typed nulls.
    """
    struct, since = schema.struct(), schema.since()
    unknown = sorted(set(df.columns) - set(struct.fieldNames()) - set(keep))
    if unknown:
        raise ValueError(f"columns that the schema doesn't declare: {', '.join(unknown)}")

    def column(f: T.StructField) -> Column:
        value = (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
        return (F.when(version >= since[f.name], value) if f.name in since else value).alias(f.name)

    return df.select(*keep, *(column(f) for f in struct.fields))
