"""Declared columns and types of every catalog role (DDL text), as FIXTURES.md describes them.

A snapshot is read with its role's schema, so a reader never infers types, and
a file whose columns or types differ is rejected.
"""

from __future__ import annotations

from pyspark.sql import types as T

ROLE_SCHEMAS: dict[str, str] = {
    "archived_log": "db_name string, recid bigint, completion_time timestamp_ntz, blocks bigint, block_size bigint, deleted string, is_recovery_dest_file string",
    "columns": "db_name string, owner string, table_name string, column_name string, data_type string, data_length bigint, nullable string, data_default string",
    "cons_columns": "db_name string, owner string, constraint_name string, table_name string, column_name string, position int",
    "constraints": (
        "db_name string, owner string, constraint_name string, table_name string, constraint_type string, status string, index_owner string, index_name string, "
        "r_owner string, r_constraint_name string"),
    "containers": "db_name string, con_id bigint, name string, guid string, open_mode string",
    "data_files": (
        "db_name string, file_id bigint, file_name string, tablespace_name string, bytes bigint, maxbytes bigint, blocks bigint, autoextensible string, "
        "increment_by bigint"),
    "databases": (
        "db_name string, dbid bigint, name string, flashback_on string, database_role string, open_mode string, log_mode string, db_unique_name string, "
        "primary_db_unique_name string, created timestamp_ntz, platform_name string"),
    "datapump_jobs": "db_name string, owner_name string, job_name string, operation string, job_mode string, state string, attached_sessions bigint",
    "db_properties": "db_name string, property_name string, property_value string",
    "dependencies": "db_name string, owner string, name string, type string, referenced_owner string, referenced_name string, referenced_type string",
    "dict_objects": "db_name string, obj_id bigint, owner string, name string, object_type string",
    "directories": "db_name string, owner string, directory_name string, directory_path string",
    "edition_comments": "db_name string, edition_name string, comments string",
    "edition_objects": "db_name string, edition_name string, object_name string, object_type string, status string, created timestamp_ntz",
    "edition_privs": "db_name string, table_name string, grantee string, privilege string",
    "editions": "db_name string, edition_name string, parent_edition_name string",
    "errors": "db_name string, owner string, name string, type string, line bigint, text string",
    "event_details": "db_name string, event_id bigint, info string",
    "extents": "db_name string, file_id bigint, block_id bigint, blocks bigint, bytes bigint, tablespace_name string",
    "externals": "db_name string, owner string, name string",
    "feature_usage": (
        "db_name string, name string, version string, currently_used string, detected_usages bigint, total_samples bigint, last_usage_date timestamp_ntz, "
        "first_usage_date timestamp_ntz, last_sample_date timestamp_ntz, feature_info string"),
    "files": "db_name string, path string, is_dir boolean, size_bytes bigint, age_days int, age_minutes int, mtime timestamp_ntz",
    "ind_columns": "db_name string, index_owner string, index_name string, table_owner string, table_name string, column_name string, column_position int",
    "ind_flags": "db_name string, obj_id bigint, bo_id bigint, flags bigint",
    "ind_partitions": "db_name string, index_owner string, index_name string, partition_name string, partition_position int, tablespace_name string, status string",
    "index_usage": "db_name string, owner string, index_name string, table_name string, monitoring string, used string, start_monitoring string",
    "indexes": (
        "db_name string, owner string, index_name string, table_owner string, table_name string, index_type string, uniqueness string, status string, "
        "visibility string, degree string, compression string, tablespace_name string"),
    "instance": "db_name string, version string, host_name string, instance_name string",
    "internal_owners": "owner string",
    "jobs": "db_name string, schema_user string, job bigint, broken string, what string",
    "lobs": "db_name string, owner string, table_name string, column_name string, segment_name string",
    "log_lines": "db_name string, ts timestamp_ntz, line string",
    "log_windows": "db_name string, recid bigint, first_time timestamp_ntz, next_time timestamp_ntz",
    "mview_logs": "db_name string, owner string, name string",
    "mviews": "db_name string, owner string, name string",
    "network_acls": "db_name string, acl string, host string",
    "obj_dependency": "db_name string, d_obj bigint, p_obj bigint, p_timestamp timestamp_ntz, property bigint",
    "obj_dict": "db_name string, obj_id bigint, owner string, name string, type_id int, status int, stime timestamp_ntz, subname string",
    "object_usage": "db_name string, obj_id bigint, flags bigint, start_monitoring string, end_monitoring string",
    "objects": (
        "db_name string, owner string, object_name string, object_id bigint, object_type string, status string, created timestamp_ntz, last_ddl_time "
        "timestamp_ntz, edition_name string"),
    "outages": "db_name string, outage_id bigint, started timestamp_ntz, ended timestamp_ntz",
    "parameters": "db_name string, name string, value string",
    "part_indexes": "db_name string, owner string, index_name string, table_name string, def_tablespace_name string",
    "part_tables": "db_name string, owner string, table_name string, def_tablespace_name string, interval string",
    "pga_advice": (
        "db_name string, pga_target_for_estimate bigint, pga_target_factor double, bytes_processed bigint, estd_extra_bytes_rw bigint, "
        "estd_pga_cache_hit_percentage double, estd_overalloc_count bigint"),
    "pgastat": "db_name string, name string, value double, unit string",
    "pwfile_users": "db_name string, username string, sysdba string, sysoper string",
    "recovery_dest": "db_name string, space_limit bigint, space_used bigint, space_reclaimable bigint",
    "recovery_usage": "db_name string, file_type string, percent_space_used double, percent_space_reclaimable double",
    "recyclebin": "db_name string, object_name string, space bigint",
    "redo": "db_name string, thread bigint, group_no bigint, bytes bigint, members bigint, member string",
    "registry": "db_name string, comp_id string, comp_name string, version string, status string",
    "registry_history": "db_name string, action_time timestamp_ntz, action string, namespace string, version string, id bigint, bundle_series string, comments string",
    "restore_points": "db_name string, name string, time timestamp_ntz, guarantee_flashback_database string",
    "role_privs": "db_name string, granted_role string, grantee string, admin_option string",
    "roles": "db_name string, role string, password_required string",
    "saved_states": "db_name string, con_name string, state string, restricted_mode_open string",
    "scheduler_jobs": "db_name string, owner string, job_name string, enabled string, state string",
    "segments": "db_name string, owner string, segment_name string, segment_type string, tablespace_name string, bytes bigint",
    "sequences": "db_name string, sequence_owner string, sequence_name string, increment_by bigint, cycle_flag string, order_flag string, last_number bigint",
    "services": "db_name string, name string, edition string",
    "sessions": "db_name string, inst_id bigint, username string, machine string, status string, sid bigint, type string, module string, program string",
    "sort_usage": "db_name string, tablespace string, blocks bigint",
    "sql_profiles": "db_name string, name string, status string",
    "standby_redo": "db_name string, thread bigint, group_no bigint, bytes bigint, member string",
    "store_lists": "db_name string, owner string, table_name string, tablespace_name string",
    "synonyms": "db_name string, owner string, synonym_name string, table_owner string, table_name string",
    "sys_privs": "db_name string, grantee string, privilege string",
    "sysstat": "db_name string, snap_id bigint, instance_number int, begin_interval_time timestamp_ntz, stat_name string, value bigint",
    "tab_partitions": (
        "db_name string, table_owner string, table_name string, partition_name string, partition_position int, high_value string, tablespace_name string, "
        "segment_created string, compression string, num_rows bigint, last_analyzed timestamp_ntz"),
    "tab_privs": "db_name string, owner string, table_name string, grantee string, privilege string, grantable string",
    "tab_stats": "db_name string, owner string, table_name string, partition_name string, stattype_locked string",
    "tables": (
        "db_name string, owner string, table_name string, num_rows bigint, last_analyzed timestamp_ntz, temporary string, secondary string, segment_created "
        "string, partitioned string, row_movement string, iot_type string, compression string, read_only string, degree string, tablespace_name string"),
    "tablespaces": (
        "db_name string, tablespace_name string, contents string, block_size bigint, initial_extent bigint, extent_management string, allocation_type string, "
        "segment_space_management string, bigfile string"),
    "temp_files": "db_name string, tablespace_name string, file_name string, bytes bigint, maxbytes bigint, autoextensible string, increment_by bigint",
    "triggers": "db_name string, owner string, trigger_name string, trigger_type string, table_owner string, table_name string, status string, base_object_type string",
    "ts_groups": "db_name string, group_name string, tablespace_name string",
    "ts_quotas": "db_name string, username string, tablespace_name string, max_bytes bigint",
    "user_base": "db_name string, name string, user_id bigint, astatus int, ptime timestamp_ntz, type_id int, resource string",
    "user_history": "db_name string, user_id bigint, password_date timestamp_ntz",
    "users": (
        "db_name string, username string, user_id bigint, profile string, account_status string, temporary_tablespace string, default_tablespace string, "
        "created timestamp_ntz, lock_date timestamp_ntz, expiry_date timestamp_ntz, initial_rsrc_consumer_group string, password_versions string, "
        "editions_enabled string, authentication_type string"),
    "users_defpwd": "db_name string, username string, product string",
    "views": "db_name string, owner string, view_name string, text_length bigint",
}


def role_schema(role: str) -> T.StructType | None:
    """The declared schema of a role; None for a role that is not declared."""
    ddl = ROLE_SCHEMAS.get(role)
    return T.StructType.fromDDL(ddl) if ddl is not None else None
