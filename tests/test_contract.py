"""The driver contract: stable schemas, flat checked outputs."""

import pytest

import __spark_entry__ as E
from ashgrid.plans.catalog import REGISTRY
from tests.conftest import SF_ORACLE, SF_SMALL


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_schema_is_stable_across_scales(spark, name):
    q = E.queries()[name]
    small, larger = q(spark, SF_SMALL).schema, q(spark, SF_ORACLE).schema
    assert [(f.name, f.dataType.simpleString()) for f in small] == \
        [(f.name, f.dataType.simpleString()) for f in larger]
    for f in small:
        assert f.dataType.typeName() not in ("array", "map", "struct"), (name, f.name)


def test_entry_is_lazy_and_named(spark):
    df = E.entry(spark)
    assert df.isStreaming is False
    assert len(set(df.columns)) == len(df.columns)
