import pytest
from import_data import READING_COLUMNS, make_source
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings():
    """Meter readings: four required columns, key of two parts, skip, all or nothing."""
    return make_source(
        "messung", READING_COLUMNS, derived=[("monat", "ladezeitpunkt_jahrmonat")], upsert_key=["geraet", "kanal"],
    )


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def put(name, content):
        data = content if isinstance(content, bytes) else content.encode()
        (folder / name).write_bytes(data)
        return str(folder)

    put.folder = str(folder)
    return put
