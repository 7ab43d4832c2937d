import pytest
from pyspark.sql import SparkSession

from tidelog.session import configure


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tidelog-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    return session()
