"""Every query with an oracle against DuckDB on the smallest tables."""

import duckdb
import pytest

from millrace.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_oracle(spark, duck, tmp_path, name):
    out = catalogue.queries()[name](spark, SF)
    out.write.parquet(str(tmp_path / "o"))
    columns = ", ".join(f'"{c}"' for c in sorted(out.columns))
    sql = f"select {columns} from ({catalogue.oracle_sql()[name]})"
    got = f"select {columns} from '{tmp_path}/o/*.parquet'"
    assert duck.sql(f"({got}) except all ({sql})").fetchall() == []
    assert duck.sql(f"({sql}) except all ({got})").fetchall() == []


def test_others_run(spark):
    import __spark_entry__ as entry

    for name in set(catalogue.queries()) - set(catalogue.oracle_sql()):
        assert catalogue.queries()[name](spark, SF).count() > 0
    assert entry.entry(spark).count() > 0
    assert set(catalogue.queries()) <= set(entry.queries())
