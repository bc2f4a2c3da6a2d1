import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="3",
        # Inputs are tiny: compiling a stage would take longer than running it.
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SENSOR = "arr int, id string, ts bigint, vc int"


@pytest.fixture
def sensors(spark):
    """Sensor rows (id, ts, vc) in arrival order, numbered in ``arr``."""

    def make(*rows, parts=None):
        numbered = [(i + 1, *r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, SENSOR)
        return df.repartition(parts) if parts else df

    return make


@pytest.fixture
def stream_of(spark, tmp_path):
    """A file stream with one file, and so one micro-batch, per group of rows.

    State lives in one partition here: starting a Python worker per partition and
    micro-batch is what these tests spend their time on.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")

    def make(schema, *groups, name="in"):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        for i, rows in enumerate(groups):
            part = tmp_path / f"{name}-part{i}"
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
            (source,) = part.glob("*.parquet")
            target = folder / f"{i:04d}.parquet"
            target.write_bytes(source.read_bytes())
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
        from tidemark.streaming.runs import file_stream
        from pyspark.sql import types as T

        return file_stream(spark, str(folder), T._parse_datatype_string(schema), files=1)

    yield make
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
