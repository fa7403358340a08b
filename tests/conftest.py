import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from agora.session import build_session

    session = build_session(
        "tests",
        4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.driver.memory": "4g",
            "spark.sql.adaptive.coalescePartitions.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
