import pytest

from ledgerforge.plans.sample_ledger import SampleLedger
from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(**{"spark.sql.shuffle.partitions": "4"})
    yield session
    SampleLedger.release_shared(session)
    session.stop()


@pytest.fixture
def frame(spark):
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


def rows_by(df, key):
    return {row[key]: row for row in df.collect()}
