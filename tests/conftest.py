import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeforge.session import build_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lakeforge-tests-")
    session = build_session(
        "local[4]",
        app_name="lakeforge-tests",
        shuffle_partitions=4,
        conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    # Tests run without a cluster-provided shared folder: set one.
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


def rows(df, *cols, order=None):
    """Collect a small test result as sorted tuples."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
