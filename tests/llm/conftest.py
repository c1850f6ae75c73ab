from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Scratch tables of the tests go below one folder of the test session."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
