import math

import pytest

from basinflow.queries import QUERIES, SQL
from basinflow.streaming import ingest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    if name not in SQL:
        assert got
        return
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("keys", [[], ["event_type"]])
def test_stream_reads_a_table_that_is_a_folder(spark, tmp_path, keys):
    query, events = QUERIES["stream_daily_means"], spark.read.parquet(f"{DATA}/events.parquet")
    want = sorted(query(spark, DATA).collect())
    events.repartition(3).write.partitionBy(*keys).parquet(str(tmp_path / "events.parquet"))
    for part in [p for p in tmp_path.rglob("part-*.parquet")][:1]:  # a name without the ending
        part.rename(part.with_suffix(""))
    assert want and sorted(query(spark, str(tmp_path)).collect()) == want


def test_stream_of_an_absent_table_raises(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not.?(found|exist)"):
        ingest.table_stream(spark, str(tmp_path / "events.parquet"), "value double")


def test_entry_module_registers_everything(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0
