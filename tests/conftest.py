import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marquee.session import build_session  # noqa: E402

# Started here, so that test modules may name columns at import.
SESSION = build_session(
    "tests",
    **{
        "spark.master": "local[*]",
        "spark.sql.shuffle.partitions": 8,
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="marquee-tests-"),
    },
)


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def value(spark):
    """Evaluate one column expression over `t` per given text."""

    def evaluate(expression, texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
        return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]

    return evaluate
