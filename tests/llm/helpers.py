import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Rows of (doc_id, text) as the documents table, with an extra column whose name clashes in case."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)


def table(sf, name):
    return duckdb.sql(f"SELECT * FROM read_parquet('/root/testdata/{sf}/{name}.parquet')").fetchall()
