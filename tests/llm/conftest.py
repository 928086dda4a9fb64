import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_fixtures import frame, odd_rows

# This file stands in for the other ``conftest`` once both are loaded.
SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def odd(spark):
    return frame(spark, odd_rows(), clashing=True)


@pytest.fixture
def nothing(spark):
    return frame(spark, [])
