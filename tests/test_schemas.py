"""Declared schemas of the catalog roles."""

import pytest
from pyspark.sql import functions as F

from estatelens.sources import catalog
from estatelens.sources.roles import ROLE_SQL, Roles
from estatelens.sources.schemas import ROLE_SCHEMAS, role_schema
from harness import SF_SMALL


def test_every_role_is_declared_as_it_is(spark):
    assert set(ROLE_SCHEMAS) == set(ROLE_SQL)
    R = Roles(spark, SF_SMALL)
    for name in ROLE_SQL:
        assert [(f.name, f.dataType) for f in R.get(name).schema.fields] == [(f.name, f.dataType) for f in role_schema(name).fields], name


def test_other_types_and_missing_columns_are_rejected(spark, tmp_path):
    good = spark.createDataFrame([("D", "cpu_count", "4")], "db_name string, name string, value string")
    for k, (df, message) in enumerate([(good, None), (good.withColumn("more", F.lit(1)), None), (good.drop("value"), r"lacks columns \['value'\]"),
                                       (good.withColumn("value", F.lit(4)), "value: int, declared string")]):
        path = str(tmp_path / str(k))
        catalog.write_catalog(df, path)
        if message is None:
            assert catalog.scan_catalog(spark, path, "parameters").count() == 1
        else:
            with pytest.raises(ValueError, match=message):
                catalog.scan_catalog(spark, path, "parameters")
    catalog.write_catalog(good.drop("value"), str(tmp_path / "other"))
    assert catalog.scan_catalog(spark, str(tmp_path / "other"), "no_such_role").count() == 1
