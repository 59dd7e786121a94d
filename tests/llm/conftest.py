import pytest

#: Rows that every operator must take: nulls, empty and odd texts, repeated rows, a column with a clashing name.
ODD = [
    (1, None, None, None, 0, 7),
    (2, "", "en", "src0", 0, 7),
    (3, " \n\t ", "en", None, 4, 7),
    (4, "word", None, "src0", 4, 7),
    (4, "word", None, "src0", 4, 7),
    (5, "Zoë naïve ☃ 𝒳 \x1c\x85 mixed  spaces\n\n\nend's 12345", "fr", "src1", 40, 7),
    (6, "the same few words come again and the same few words come again " * 4000, "en", "src1", 250000, 7),
    (7, "12 34 !! ???", "de", "src2", 12, 7),
    (8, None, "de", "src2", None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_dir(odd, tmp_path_factory):
    """The odd rows as tables in a folder, for the registered queries."""
    d = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{d}/documents.parquet")
    odd.sparkSession.createDataFrame([(4, 1, 0), (5, 1, 0), (6, 0, 0), (7, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="session")
def none_dir(none, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("none"))
    none.write.parquet(f"{d}/documents.parquet")
    none.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d
