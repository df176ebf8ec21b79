import pytest

from webloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "3g", **{"spark.sql.shuffle.partitions": "4"})
