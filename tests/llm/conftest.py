import pytest

from ladle.llm.queries import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark.sparkContext)
