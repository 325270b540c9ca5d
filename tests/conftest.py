import pytest

from tidemark.session import local_session

# Compiling a plan takes longer than running it on a handful of rows.
INTERPRETED = {
    "spark.sql.codegen.wholeStage": "false",
    "spark.sql.codegen.factoryMode": "NO_CODEGEN",
}


@pytest.fixture(scope="session")
def compiled_spark():
    """The session as a user has it."""
    return local_session("tidemark-tests", cores=4, shuffle_partitions=4)


@pytest.fixture
def spark(compiled_spark):
    for key, value in INTERPRETED.items():
        compiled_spark.conf.set(key, value)
    yield compiled_spark
    for key in INTERPRETED:
        compiled_spark.conf.unset(key)
