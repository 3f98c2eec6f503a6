import pytest
from pyspark import cloudpickle

import feedloom

cloudpickle.register_pickle_by_value(feedloom)


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The folder that executors share."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string, map string"


@pytest.fixture(scope="session")
def table(spark):
    """Documents with odd rows and columns whose names the operators use themselves."""

    def make(texts, parts=3, sources=None):
        rows = []
        for i, text in enumerate(texts):
            doc, body = text if isinstance(text, tuple) else (i, text)
            source = sources[i] if sources else f"s{i % 3}"
            rows.append((doc, body, "en" if i % 2 else None, source, None, "x", "y", "z"))
        df = spark.createDataFrame(rows, DOCS)
        return df.repartition(parts) if parts else df

    return make


ODD = [None, "", " ", "a", "\n\n", "İ ß 😀", "word " * 3000, "same text twice " * 9, "same text twice " * 9]
