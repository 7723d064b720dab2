import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402



@pytest.fixture(scope="session")
def awkward(spark):
    return cases.frame(spark, cases.awkward()).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return cases.frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (7, 1, 0), (7, 0, 0), (None, 1, 1), (8, None, None), (11, 0, 1), (13, 1, 0), (99, 1, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
