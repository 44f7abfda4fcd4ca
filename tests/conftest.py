import pytest

from quotelake.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "quotelake-tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted([tuple(r) for r in picked.collect()], key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
