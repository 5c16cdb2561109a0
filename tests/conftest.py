import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests").master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.codegen.wholeStage", "false")  # a few rows per plan: compiling costs more
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")  # whole paths in plans
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collected rows as a sorted list of plain tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
