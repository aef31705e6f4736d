import pytest


@pytest.fixture(autouse=True)
def shipped(spark):
    from pagetrail.llm.shared import ship

    ship(spark)


@pytest.fixture()
def against_sql():
    """Compare a query with its SQL, whole tables, values as text."""
    import duckdb

    def run(df, sql, sf):
        con = duckdb.connect()
        for t in "documents embeddings pages benchmark labels conversations".split():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        got = df.select(sorted(df.columns)).collect()
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        order = [names.index(c) for c in sorted(names)]
        assert sorted(names) == sorted(df.columns)
        want = [tuple(r[i] for i in order) for r in cur.fetchall()]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
        return len(got)

    return run
