"""What is collected: a dataset is configuration, not code."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    """``mode``: simple (whole scopes are replaced) or complex (merged by key). ``minutes``: stale age.

    ``volatile`` columns neither count as changes nor for the checksum; those of ``keep_last`` keep their
    value where a snapshot has none; with ``zero`` columns nothing is deleted and they become 0 where a row is missing. ``after``:
    the datasets that run before. ``roles``: id columns and the columns that name their items; ``defines`` is the role whose
    dimension the dataset keeps, ``refers`` says of other roles in which dimension their items are.
    ``plans.sync`` runs datasets by these specs.
    """

    name: str
    level: str
    minutes: int
    mode: str
    has_checksum: bool
    versioned: bool
    keys: tuple[str, ...] = ()
    is_enabled: bool = True
    volatile: tuple[str, ...] = field(default=())
    keep_last: tuple[str, ...] = field(default=())
    zero: tuple[str, ...] = field(default=())
    after: tuple[str, ...] = field(default=())
    roles: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defines: str | None = None
    refers: dict[str, str] = field(default_factory=dict)

    @property
    def on_empty(self) -> str:
        """A merged dataset's scope that comes empty keeps its rows: no export is empty but by mistake."""
        return "clear" if self.mode == "simple" else "keep"

    def __post_init__(self):
        if self.level not in ("instance", "database") or self.mode not in ("simple", "complex"):
            raise ValueError(f"{self.name}: level or mode is unknown")
        if self.versioned and self.mode == "simple":
            raise ValueError(f"{self.name}: only merged datasets have a history")
        if set(self.refers) - set(self.roles) or (self.defines and self.defines not in self.roles):
            raise ValueError(f"{self.name}: no columns name the items of a role")


#: Id columns and the columns that name their items: objects by scope, schema, name and type, the rest under an object.
OBJECT = {"_ObjectID": ("database_id", "_SchemaName", "_ObjectName", "_ObjectType")}
PARENT = {"_ParentObjectID": ("database_id", "_ParentSchemaName", "_ParentObjectName", "_ParentObjectType")}
REFERENCED = {"_ReferencedObjectID": ("database_id", "_ReferencedSchemaName", "_ReferencedObjectName", "_ReferencedObjectType")}
#: ``_IndexKind`` keeps indexes and statistics of one name apart.
INDEX = OBJECT | {"_IndexID": ("_ObjectID", "_IndexName", "_IndexKind")}
COLUMN = OBJECT | {"_ColumnID": ("_ObjectID", "_ColumnName")}
_OF_OBJECT, _OF_INDEX, _OF_COLUMN = ({c: c} for c in ("_ObjectID", "_IndexID", "_ColumnID"))
_OF_PARENT, _OF_REFERENCED = ({c: "_ObjectID"} for c in ("_ParentObjectID", "_ReferencedObjectID"))
_LAST_USED = ("last_user_seek", "last_user_scan", "last_user_lookup", "last_user_update", "last_system_seek", "last_system_scan", "last_system_lookup", "last_system_update")

# Names, levels, stale minutes, modes, whether there is a checksum and a history, keys.
DATASETS = [
    DatasetSpec("dm_hadr_cluster", "instance", 1440, "simple", True, False),
    DatasetSpec("dm_db_log_space_usage", "database", 720, "simple", False, False),
    DatasetSpec("dm_io_virtual_file_stats", "database", 1440, "simple", False, False, ("file_id",)),
    DatasetSpec("dm_os_wait_stats", "instance", 720, "complex", False, False, ("wait_type",), zero=("waiting_tasks_count", "wait_time_ms", "max_wait_time_ms", "signal_wait_time_ms")),
    DatasetSpec("database_query_store_options", "database", 1440, "simple", True, False),
    DatasetSpec("dm_resource_governor_resource_pools", "instance", 720, "simple", False, False),
    DatasetSpec("dm_os_volume_stats", "database", 1440, "simple", False, False, ("file_id",)),
    DatasetSpec("dm_os_host_info", "instance", 1440, "simple", True, False),
    DatasetSpec("dm_db_partition_stats", "database", 720, "complex", False, False, ("_IndexID", "partition_number"), after=("indexes",), roles=INDEX, refers=_OF_INDEX),
    DatasetSpec("dm_os_sys_memory", "instance", 720, "simple", False, False),
    DatasetSpec("dm_os_nodes", "instance", 720, "simple", False, False),
    DatasetSpec("dm_db_index_usage_stats", "database", 720, "complex", False, False, ("_IndexID",), after=("indexes",), keep_last=_LAST_USED, roles=INDEX, refers=_OF_INDEX),
    DatasetSpec("dm_server_services", "instance", 1440, "simple", True, False),
    DatasetSpec("dm_hadr_database_replica_states", "database", 720, "simple", False, False, ("replica_id",)),
    DatasetSpec("dm_os_sys_info", "instance", 720, "simple", False, False),
    DatasetSpec("dm_os_enumerate_fixed_drives", "instance", 720, "simple", False, False),
    DatasetSpec("dm_os_cluster_nodes", "instance", 1440, "simple", True, False),
    DatasetSpec("dm_os_process_memory", "instance", 720, "simple", False, False),
    DatasetSpec("database_automatic_tuning_options", "database", 1440, "simple", True, False),
    DatasetSpec("database_scoped_configurations", "database", 1440, "simple", True, False),
    DatasetSpec("database_files", "database", 720, "simple", False, False),
    DatasetSpec("filegroups", "database", 720, "simple", True, False, ("data_space_id",)),
    DatasetSpec("sql_modules", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT, refers=_OF_OBJECT),
    DatasetSpec("triggers", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT | PARENT, refers=_OF_PARENT),
    DatasetSpec("foreign_key_columns", "database", 720, "complex", True, False, ("_ObjectID", "_ParentObjectID", "_ReferencedObjectID"), after=("foreign_keys",), roles=OBJECT | PARENT | REFERENCED, refers=_OF_PARENT | _OF_REFERENCED),
    DatasetSpec("foreign_keys", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT | PARENT | REFERENCED, refers=_OF_PARENT | _OF_REFERENCED),
    DatasetSpec("default_constraints", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT | PARENT, refers=_OF_PARENT),
    DatasetSpec("check_constraints", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT | PARENT, refers=_OF_PARENT),
    DatasetSpec("key_constraints", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT | PARENT, refers=_OF_PARENT),
    DatasetSpec("stats", "database", 720, "complex", True, False, ("_IndexID",), after=("objects",), roles=INDEX, refers=_OF_OBJECT),
    DatasetSpec("index_columns", "database", 720, "complex", True, True, ("_IndexID", "_ColumnID"), after=("indexes", "columns"), roles=INDEX | COLUMN, refers=_OF_INDEX | _OF_COLUMN),
    DatasetSpec("partitions", "database", 720, "complex", False, False, ("_IndexID", "partition_number"), after=("indexes",), roles=INDEX, refers=_OF_INDEX),
    DatasetSpec("indexes", "database", 720, "complex", True, True, ("_IndexID",), after=("objects",), roles=INDEX, defines="_IndexID", refers=_OF_OBJECT),
    DatasetSpec("identity_columns", "database", 720, "complex", False, False, ("_ColumnID",), after=("columns",), roles=COLUMN, refers=_OF_COLUMN),
    DatasetSpec("computed_columns", "database", 720, "complex", True, True, ("_ColumnID",), after=("columns",), roles=COLUMN, refers=_OF_COLUMN),
    DatasetSpec("columns", "database", 720, "complex", True, True, ("_ColumnID",), after=("objects",), roles=COLUMN, defines="_ColumnID", refers=_OF_OBJECT),
    DatasetSpec("views", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT, refers=_OF_OBJECT),
    DatasetSpec("tables", "database", 720, "complex", True, True, ("_ObjectID",), after=("objects",), roles=OBJECT, refers=_OF_OBJECT),
    DatasetSpec("objects", "database", 720, "complex", True, True, ("_ObjectID",), roles=OBJECT, defines="_ObjectID"),
    DatasetSpec("configurations", "instance", 720, "complex", True, True, ("configuration_id",)),
    DatasetSpec("master_files", "instance", 1550, "complex", True, False, ("_DatabaseName", "file_id")),
    DatasetSpec("databases", "instance", 720, "complex", True, True, ("name",)),
    DatasetSpec("SERVERPROPERTY", "instance", 720, "simple", False, False),
    DatasetSpec("DATABASEPROPERTYEX", "database", 720, "simple", False, False),
    DatasetSpec("restorehistory", "instance", 1440, "simple", True, False, ("restore_history_id",)),
    DatasetSpec("sysarticles", "database", 1440, "complex", True, True, ("_ObjectID", "artid")),
    DatasetSpec("syspublications", "database", 1440, "simple", True, False, ("pubid",)),
    DatasetSpec("sysreplservers", "database", 1440, "simple", True, False, ("srvid",)),
    DatasetSpec("global_variables", "instance", 1440, "simple", False, False),
]


def spec_frame(spark: SparkSession, datasets: list[DatasetSpec] | None = None) -> DataFrame:
    """The registry as a table for ``status.task_matrix``."""
    schema = T.StructType([T.StructField(n, t) for n, t in (("dataset_id", T.IntegerType()), ("name", T.StringType()), ("level", T.StringType()), ("minutes", T.IntegerType()), ("is_enabled", T.BooleanType()), ("has_checksum", T.BooleanType()))])
    rows = [(k, d.name, d.level, d.minutes, d.is_enabled, d.has_checksum) for k, d in enumerate(datasets if datasets is not None else DATASETS, 1)]
    return spark.createDataFrame(rows, schema)
