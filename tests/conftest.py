import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from faresight.session import build_session
    s = build_session("local[*]", app_name="faresight-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.fixture(scope="session")
def oracle_count(duck):
    """Number of rows that the SQL of a registered query gives."""
    from faresight.plans.oracle import ORACLE
    return lambda name: duck.execute(f"SELECT count(*) FROM ({ORACLE[name]})").fetchall()[0][0]


@pytest.fixture(scope="session")
def tables(spark):
    from faresight.sources import fixtures
    return fixtures.load(spark, SF_SMALL)
