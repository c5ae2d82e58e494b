import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("OMP_NUM_THREADS", "1")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def shuffled(spark):
    """Rows that ``run()`` writes to shuffles."""
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm.java.util.ArrayList

    def stages():
        found = store.stageList(none(), False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), none())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (found.apply(k) for k in range(found.size()))}

    def count(run):
        before = stages()
        run()
        return sum(n for k, n in stages().items() if k not in before)

    return count
