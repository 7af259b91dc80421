"""Catalog snapshots on shared storage: the production input layout.

Collectors (or a one-off ingest from projections) write each catalog role
once as Parquet partitioned by ``db_name``; operators then read only the
columns and databases they need. ``SnapshotRoles`` is a drop-in for
``sources.roles.Roles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estatelens.sources import catalog as cat


def write_snapshots(roles, path: str, names) -> None:
    """Write the named roles of ``roles`` (any object with role
    attributes) below ``path``, one folder per role."""
    for name in names:
        df = roles.get(name)
        target = f"{path.rstrip('/')}/{name}"
        if "db_name" in df.columns:
            cat.write_catalog(df, target)
        else:                                   # fleet-wide lists (internal owners)
            df.write.mode("overwrite").parquet(target)


class SnapshotRoles:
    """Roles read back from ``write_snapshots`` output."""

    def __init__(self, spark: SparkSession, path: str, databases=None):
        self._spark = spark
        self._path = path.rstrip("/")
        self._databases = databases
        self._cache: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = cat.scan_catalog(self._spark, f"{self._path}/{name}", name, self._databases)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.get(name)
