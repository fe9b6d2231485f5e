import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, shared_dir

    s = build_session(
        "tidemark-tests",
        master="local[8]",
        extra={"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "8"},
    )
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # tests own no cluster: register a local shared folder
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
