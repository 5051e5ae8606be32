import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet").cache()
