import pytest

from rollbook.session import SessionOptions, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        SessionOptions(
            app_name="tests",
            master="local[4]",
            shuffle_partitions=4,
            extra={
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.checkpoint.dir": str(root / "shared"),
                "spark.sql.warehouse.dir": str(root / "warehouse"),
            },
        )
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """The physical plan of a frame, as text."""

    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
