import json
import os
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from newsfold.session import configured

os.environ.setdefault("PYTHONHASHSEED", "0")
FEED_FILE = Path(__file__).parent / "data" / "feed.json"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("newsfold-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="newsfold-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configured(session)
    session.stop()


@pytest.fixture(scope="session")
def feed_records():
    return json.loads(FEED_FILE.read_text())


@pytest.fixture(scope="session")
def normalized(spark, feed_records):
    from tests.helpers import normalize_values

    return normalize_values(spark, feed_records).cache()


@pytest.fixture(scope="session")
def tables(spark, normalized):
    """(mentions, sources) of the feed file after one batch."""
    from pyspark.sql import functions as F

    from newsfold.operators import merge

    now = F.timestamp_millis(F.lit(1_786_900_000_000))
    mentions = merge.with_search_text(merge.fold_rows(merge.as_rows(normalized, now))).cache()
    return mentions, merge.batch_sources(normalized, now).cache()
