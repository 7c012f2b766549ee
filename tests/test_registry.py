"""Registered queries in a session that has opened several folders."""

from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from checks import registry

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.mark.skipif(not all(Path(f).exists() for f in FOLDERS), reason="no test data")
def test_folders_do_not_mix(spark):
    def rows(name, folder):
        return sorted(map(repr, registry.QUERIES[name](spark, folder).collect()))

    small, large = FOLDERS
    first = rows("b02_operations_usage", small)
    rows("b01_operations_users", large)
    lazy = registry.QUERIES["b02_operations_usage"](spark, small)
    rows("b01_operations_users", large)
    assert rows("b02_operations_usage", small) == first and sorted(map(repr, lazy.collect())) == first
