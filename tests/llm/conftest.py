from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import llm_cases  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(llm_cases.documents(), llm_cases.SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], llm_cases.SCHEMA)
