import pytest
from pyspark.sql import SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """Builds documents of (id, text) or (id, text, source), with an extra column of a clashing name."""

    def build(rows, extra: str | None = None, partitions: int = 3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(partitions)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumn(extra, F.lit("mine"))
        return df

    return build


#: Texts that every operator has to take: NULL, empty, blank, short, long, odd characters, ties.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "word " * 30000), (6, "a" * 50000),
    (7, "tie tie tie tie tie tie"), (8, "tie tie tie tie tie tie"), (8, "tie tie tie tie tie tie"),
    (None, "no id here at all"), (10, "éü 漢字 \U0001f600 x\x00y\x1cz"), (11, "line\n\nline\nline"),
]


@pytest.fixture
def odd():
    return ODD
