"""Views that know about soft deletion: instance, database, object, index, column."""

from __future__ import annotations

from pyspark.sql import DataFrame

from metafleet.functions.keys import namespaced, qualified_name
from metafleet.operators.relational import active_only, replica_flag


def vw_instance(instances: DataFrame) -> DataFrame:
    return active_only(instances, enabled="is_enabled").drop("is_enabled")


def vw_database(databases: DataFrame, instance_view: DataFrame, replicas: DataFrame | None = None) -> DataFrame:
    """Enabled databases of enabled instances, with their namespace and, if asked, their replica's role."""
    found = active_only(databases, enabled="is_enabled").drop("is_enabled").join(instance_view, "instance_id")
    found = found.withColumn("database_namespace", namespaced("instance_name", "database_name"))
    return found if replicas is None else replica_flag(found, replicas, "database_id")


def vw_object(objects: DataFrame, database_view: DataFrame) -> DataFrame:
    return active_only(objects, deleted="is_deleted").drop("is_deleted").join(database_view, "database_id")


def vw_index(indexes: DataFrame, object_view: DataFrame) -> DataFrame:
    """Indexes of objects that are there, with the fully qualified name."""
    found = active_only(indexes, deleted="is_deleted").drop("is_deleted").join(object_view, "object_id")
    return found.withColumn("fqin", qualified_name("database_name", "schema_name", "object_name", "index_name"))


def vw_column(columns: DataFrame, object_view: DataFrame) -> DataFrame:
    return active_only(columns, deleted="is_deleted").drop("is_deleted").join(object_view, "object_id")


def index_columns(index_view: DataFrame, index_columns_: DataFrame) -> DataFrame:
    """The key columns of indexes that are there."""
    return index_columns_.join(index_view, "index_id")


def instance_attribute(instance_view: DataFrame, attributes: DataFrame) -> DataFrame:
    return instance_view.join(attributes, "instance_id")
