import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
NAMES = ("documents", "benchmark", "labels", "pages", "embeddings")


@pytest.fixture
def same_as_sql(spark):
    """A registered query has the rows of its SQL over the smallest tables."""
    from viagrid.llm.queries import ORACLES, QUERIES

    def compare(name):
        frame = QUERIES[name](spark, SMALL)
        duck = duckdb.connect()
        for t in NAMES:
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        names = sorted(frame.columns)
        found = duck.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
        assert sorted(map(tuple, frame.select(*names).collect()), key=repr) == sorted(found, key=repr)

    return compare


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) rows, with further columns whose names may clash."""

    def make(rows, kind="doc_id long, text string"):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame(rows, kind)
        extra = {"id": F.lit("x"), "key": F.lit(None).cast("string"), "n": F.lit(1), "sig": F.lit("s"), "rep": F.lit(2), "size": F.lit(3), "band": F.lit(0)}
        return frame.withColumns({k: v for k, v in extra.items() if k not in frame.columns})

    return make
