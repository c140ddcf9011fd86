import duckdb
import pyarrow as pa
import pytest

from compare import rows_of


@pytest.fixture
def against_sql():
    """Difference between a frame and SQL over Arrow tables given by name; None if they agree."""

    def compare(df, sql, **tables):
        con = duckdb.connect()
        for name, table in tables.items():
            con.register(name, table)
        cursor = con.execute(sql)
        theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
        mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
        return None if mine == theirs else (mine, theirs)

    return compare


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, for Spark and for SQL."""

    def make(rows):
        full = [(*r, "s")[:3] for r in rows]
        table = pa.table({
            "doc_id": pa.array([r[0] for r in full], pa.int64()),
            "text": pa.array([r[1] for r in full], pa.string()),
            "lang": pa.array(["en"] * len(full), pa.string()),
            "source": pa.array([r[2] for r in full], pa.string()),
            "n_chars": pa.array([len(r[1] or "") for r in full], pa.int64()),
        })
        df = spark.createDataFrame(
            table.to_pylist(), "doc_id long, text string, lang string, source string, n_chars long"
        ).repartition(3)
        return df, table

    return make
