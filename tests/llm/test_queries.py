"""Every registered query of the subpackage at the smallest scale, against its SQL where it has some."""

import __spark_entry__ as entry
import pytest
from check import connect, difference

from sluicegate.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert queries.QUERIES.items() <= entry.queries().items()
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    assert difference(spark, connect(SF_DIR), name, SF_DIR) == ""
