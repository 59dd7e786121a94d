import duckdb
import oracle
import pytest

from skein.plans import catalogue

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(D)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, con, name):
    oracle.compare(spark, con, D, catalogue.QUERIES[name], catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, D).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(catalogue.ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def odd(spark, tmp_path, table, rows, schema):
    """A folder with that one table, and a connection that sees it."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/rows")
    next((tmp_path / "rows").glob("*.parquet")).rename(tmp_path / f"{table}.parquet")
    made = duckdb.connect()
    made.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet')")
    return made


def test_async_answers_of_letters_without_a_single_capital(spark, tmp_path):
    texts = ["Enßau dem", "ßßßx", "\ufb01n", "\u0149ab", "\u1fb3bc", "\u01c6b", "\u0131i\u0130", "", "x" * 11, None]
    con = odd(spark, tmp_path, "conversations", [(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    assert oracle.compare(spark, con, str(tmp_path), catalogue.QUERIES["async_answers"], catalogue.ORACLES["async_answers"]) == len(texts)


def test_overlay_text_of_rows_of_one_id_and_of_none(spark, tmp_path):
    """A row's verdict is its own, and is found without a shuffle."""
    rows = [(k, "x" * n) for n in range(13) for k in (1, 2 + n, None)] + [(99, None)]
    con = odd(spark, tmp_path, "documents", rows, "doc_id long, text string")
    assert oracle.compare(spark, con, str(tmp_path), catalogue.QUERIES["overlay_text_stage"], catalogue.ORACLES["overlay_text_stage"]) == 40
    assert "Exchange" not in catalogue.QUERIES["overlay_text_stage"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_archives_of_documents_without_source_or_text(spark, tmp_path):
    rows = [(1, "a", "en", "web"), (2, "", "en", None), (3, None, None, "web"), (4, "dß", None, None)]
    con = odd(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string, source string")
    assert oracle.compare(spark, con, str(tmp_path), catalogue.QUERIES["archive_round_trip"], catalogue.ORACLES["archive_round_trip"]) == 4
