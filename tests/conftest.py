import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskmart.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[4]").appName("riskmart-tests")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
               .config("spark.sql.session.timeZone", "UTC"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    return tune(session)
