"""Every registered query of the document engine against its SQL in DuckDB, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from docweave import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(float(value)) if type(value).__name__ == "Decimal" else str(value)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = duck.execute(f"SELECT {columns} FROM ({queries.SQL[name]})").fetchall()
    rows = lambda found: sorted(tuple(map(plain, r)) for r in found)
    assert rows(df.collect()) == rows(want)


def test_flagship_and_locks_run(spark):
    assert queries.QUERIES["flagship"](spark, DATA).count() > 0
    assert queries.QUERIES["lock_transitions"](spark, DATA).count() == 1000


def test_the_library_imports_without_the_optional_parts(tmp_path):
    root = Path(__file__).resolve().parents[1]
    (tmp_path / "docweave").mkdir()
    for p in (root / "docweave").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "docweave" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").symlink_to(root / "__spark_entry__.py")
    # The entry file is a link, so its real folder is kept off the path.
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; q = e.queries(); assert 'find_eq' in q and not any(k.startswith('op') for k in q), list(q)"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_lock_transitions_match_a_plain_loop(spark):
    """Each user's lock, replayed by hand in order of time and event."""
    got = queries.QUERIES["lock_transitions"](spark, DATA).collect()
    events = spark.read.parquet(f"{DATA}/events.parquet").selectExpr("user_id", "event_id", "event_type", "unix_millis(cast(ts as timestamp)) as ms").collect()
    want, locks = {}, {}
    for e in sorted(events, key=lambda e: (e.ms, e.event_id)):
        caller, action = f"c{e.event_id % 3}", {"purchase": "release", "error": "ping"}.get(e.event_type, "acquire")
        held = locks.get(e.user_id)
        mine = held is not None and held[0] == caller and held[2] > e.ms
        ok, count = None, 0
        if action == "acquire":
            if mine or held is None or held[2] <= e.ms:
                ok, count = True, held[1] + 1 if mine else 1
                locks[e.user_id] = (caller, count, e.ms + 3_600_000)
            else:
                ok = False
        elif mine and action == "release":
            count = held[1] - 1
            ok = count == 0
            locks[e.user_id] = (caller, count, held[2]) if count else None
        elif mine:
            ok, count = True, held[1]
            locks[e.user_id] = (caller, count, e.ms + 3_600_000)
        want[e.event_id] = (f"r{e.user_id}", caller, action, ok, count)
    assert {r.seq: (r.resource, r.caller, r.action, r.ok, r["count"]) for r in got} == want


def test_lock_resources_grow_with_the_users(spark):
    data = DATA.replace("0.001", "0.01")
    users = spark.read.parquet(f"{data}/events.parquet").select("user_id").distinct().count()
    assert users > 20
    assert queries.QUERIES["lock_transitions"](spark, data).select("resource").distinct().count() == users
