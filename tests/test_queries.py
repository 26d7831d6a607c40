"""Every registered query of the core against its SQL in DuckDB."""

import os
from pathlib import Path

import duckdb
import pytest

from cliploom.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in Path(DATA).iterdir():
        c.execute(f"create view {p.stem} as from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, db, name):
    df = catalog.queries()[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got
    if sql := catalog.oracle_sql().get(name):
        r = db.sql(sql)
        want = rows(r.columns, r.fetchall())
        assert sorted(df.columns) == sorted(r.columns)
        assert len(got) == len(want)
        bad = [(a, b) for a, b in zip(got, want, strict=True) if repr(a) != repr(b)]
        assert not bad, bad[:3]


def _tied(tmp_path) -> str:
    """Events of few users with many equal seconds, equal middles and no length, in order of time."""
    import random
    from datetime import datetime, timedelta

    import pyarrow as pa
    import pyarrow.parquet as pq

    r, at = random.Random(5), datetime(2024, 1, 1)
    ts = sorted(at + timedelta(seconds=100 * r.randrange(20000)) for _ in range(3000))
    kind = [r.choice(["click", "view", "error", "purchase", "signup"]) for _ in ts]
    value = [float(r.choice([0, 25, 50, 75, 100, 150])) for _ in ts]
    t = pa.table({"event_id": range(len(ts)), "ts": pa.array(ts, pa.timestamp("us")), "user_id": [r.randrange(400) for _ in ts], "event_type": kind, "value": value, "props": ["{}"] * len(ts)})
    t = pa.concat_tables([t, t.slice(2900).set_column(0, "event_id", pa.array(range(3000, 3100))).set_column(4, "value", pa.array([v + 7 for v in value[2900:]]))])
    pq.write_table(t.sort_by([("ts", "ascending"), ("event_id", "ascending")]), str(tmp_path / "events.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["silence_coverage", "greedy_groups", "segment_rollup", "job_eta"])
def test_ties_and_no_length(spark, tmp_path, name):
    """Where an order leaves ties the first row counts, as in the SQL; a silence without length is no clean one."""
    data = _tied(tmp_path)
    c = duckdb.connect(config={"threads": 1})
    c.execute(f"create view events as from '{data}/events.parquet'")
    df = catalog.queries()[name](spark, data)
    r = c.sql(catalog.oracle_sql()[name])
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows(r.columns, r.fetchall())
