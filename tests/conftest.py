import pytest

from tabloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tabloom-tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    yield session
    session.stop()
