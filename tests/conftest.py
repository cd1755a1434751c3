import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import configure, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = configure(local_session(4, "4g", **{"spark.checkpoint.dir": shared}))
    session.conf.set("spark.sql.shuffle.partitions", "3")
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), ...)``."""

    def make(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make


@pytest.fixture
def grid(spark):
    """``grid("ab. c", ...)``: one text per row; a dot or blank is a blank cell."""

    def make(*lines, file="f", sheet="S"):
        cells = [
            (file, sheet, r, c, v, 0)
            for r, line in enumerate(lines)
            for c, v in enumerate(line if isinstance(line, (list, tuple)) else list(line))
            if v not in (".", " ", None)
        ]
        return spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string, indent int")

    return make


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
