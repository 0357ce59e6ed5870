import pytest

from checks.compare import compare, duck
from lanelux.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) == ""


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
