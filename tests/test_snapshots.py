"""Operators give the same result from written snapshots as from live roles."""

import tempfile

from harness import SF_SMALL
from estatelens.operators import capacity as cap
from estatelens.operators import security as sec
from estatelens.sources.roles import Roles
from estatelens.sources.snapshots import SnapshotRoles, write_snapshots


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_snapshot_roles_match_live(spark):
    live = Roles(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="estatelens-snap-")
    write_snapshots(live, path, ["data_files", "extents", "parameters", "segments", "sys_privs", "ts_quotas",
                                 "internal_owners"])
    snap = SnapshotRoles(spark, path)
    assert _same(cap.reclaimable_space(live.data_files, live.extents, live.parameters),
                 cap.reclaimable_space(snap.data_files, snap.extents, snap.parameters))
    assert _same(sec.missing_quota(live.segments, live.sys_privs, live.ts_quotas),
                 sec.missing_quota(snap.segments, snap.sys_privs, snap.ts_quotas))
    one = SnapshotRoles(spark, path, databases=["DB1"])
    assert {r.db_name for r in one.extents.select("db_name").distinct().collect()} == {"DB1"}


def test_health_report_from_snapshots_matches_live(spark):
    from estatelens.plans.health_report import health_report
    live = Roles(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="estatelens-snap-")
    names = ["indexes", "ind_partitions", "columns", "internal_owners", "constraints", "synonyms", "objects",
             "tab_privs", "dependencies", "users", "tables", "tab_stats", "externals", "datapump_jobs", "obj_dict",
             "obj_dependency", "triggers", "users_defpwd", "db_properties", "segments", "sys_privs", "ts_quotas",
             "registry", "restore_points", "databases", "network_acls", "user_history", "user_base", "pwfile_users",
             "role_privs", "parameters"]
    write_snapshots(live, path, names)
    snap = SnapshotRoles(spark, path)
    assert _same(health_report(snap), health_report(live))
