import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeshelf.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lakeshelf-tests-")
    session = build_session(
        "lakeshelf-tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.driver.extraJavaOptions": f"-Dderby.stream.error.file={scratch}/derby.log",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
