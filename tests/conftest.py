import os
import sys
import uuid

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vialis.session import clear_scratch, open_session

    session = open_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def layers(spark, tmp_path):
    """A set of layer databases of its own."""
    from vialis.plans import Layers
    from vialis.sources.tables import create_layers

    mark = uuid.uuid4().hex[:8]
    names = Layers(*(f"{layer}_{mark}" for layer in ("bronze", "silver", "gold")))
    create_layers(spark, str(tmp_path / "tables"), [names.bronze, names.silver, names.gold])
    return names


@pytest.fixture
def one(spark):
    """Results of an expression of ``x`` for each value."""
    def evaluate(values, schema, expression):
        frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {schema}")
        return [r["y"] for r in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]
    return evaluate
