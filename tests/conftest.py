import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = local_session(4, memory="4g", **{"spark.checkpoint.dir": str(checkpoints)})
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column expression to a list of values."""

    def apply(f, items, type_name="string"):
        df = spark.createDataFrame(list(enumerate(items)), f"i int, x {type_name}")
        return [r[0] for r in df.orderBy("i").select(f(df["x"])).collect()]

    return apply
