"""Missing fields, paths, plans, writes, versions, locks, the store, the catalog and requests on small documents."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.errors import DocumentError
from docweave.operators import coordination, mutate, versions
from docweave.plans import request
from docweave.plans.query import compile_query, matching
from docweave.sources import catalog, documents
from docweave.sources.store import Store

SCHEMA = "_id string, s string, n long, a array<long>, b array<long>, o array<struct<x:string,y:long,z:array<long>>>, d struct<p:string,q:long>"
ROWS = [
    ("1", "abc", 1, [1, 2, 3], [1, 2, 3], [("u", 1, [1]), ("v", 2, [])], ("p", 1)),
    ("2", None, None, None, None, None, None),
    ("3", "ABC", 5, [], [1], [], ("q", None)),
    ("4", "x", 2, [2, None], [2, 3], [(None, 7, None), ("u", None, [7, 8])], (None, 5)),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


CASES = [
    ({"field": "s", "op": "=", "rvalue": "abc"}, "1"),
    ({"field": "s", "op": "!=", "rvalue": "abc"}, "234"),
    ({"$not": {"field": "s", "op": "=", "rvalue": "abc"}}, "234"),
    ({"$not": {"field": "s", "op": "!=", "rvalue": "abc"}}, "1"),
    ({"$not": {"$or": [{"field": "n", "op": ">", "rvalue": 1}, {"field": "s", "op": "$in", "values": ["abc"]}]}}, "2"),
    ({"field": "n", "op": "<", "rvalue": "3"}, "14"),
    ({"$not": {"field": "n", "op": "<", "rvalue": 3}}, "23"),
    ({"field": "n", "op": "=", "rvalue": None}, "2"),
    ({"field": "n", "op": "!=", "rvalue": None}, "134"),
    ({"field": "s", "op": "$in", "values": []}, ""),
    ({"field": "s", "op": "$nin", "values": ["abc", "x"]}, "23"),
    ({"field": "s", "op": "$in", "values": [None, "x"]}, "24"),
    ({"field": "a", "op": "=", "rvalue": 2}, "14"),
    ({"field": "a", "op": "!=", "rvalue": 2}, "23"),
    ({"field": "a", "op": "$in", "values": [3, 9]}, "1"),
    ({"field": "a", "op": "$nin", "values": [3, 9]}, "234"),
    ({"field": "a", "op": "=", "rfield": "b"}, "1"),
    ({"field": "a", "op": "!=", "rfield": "b"}, "234"),
    ({"field": "n", "op": "$in", "rfield": "a"}, "14"),
    ({"field": "n", "op": "$nin", "rfield": "a"}, "23"),
    ({"field": "s", "regex": "^ab", "caseInsensitive": True}, "13"),
    ({"$not": {"field": "s", "regex": "b"}}, "234"),
    ({"array": "a", "contains": "$all", "values": [1, 2]}, "1"),
    ({"array": "a", "contains": "$any", "values": [2, 9]}, "14"),
    ({"array": "a", "contains": "$none", "values": [1]}, "234"),
    ({"array": "o", "elemMatch": {"field": "x", "op": "=", "rvalue": "u"}}, "14"),
    ({"array": "o", "elemMatch": {"$not": {"field": "x", "op": "=", "rvalue": "u"}}}, "14"),
    ({"array": "o", "elemMatch": {"$and": [{"field": "x", "op": "=", "rvalue": "u"}, {"field": "y", "op": "=", "rvalue": 1}]}}, "1"),
    ({"array": "a", "elemMatch": {"field": "$this", "op": ">", "rvalue": 2}}, "1"),
    ({"field": "o.*.y", "op": ">", "rvalue": 1}, "14"),
    ({"field": "o.0.x", "op": "=", "rvalue": "u"}, "1"),
    ({"field": "o.-1.x", "op": "=", "rvalue": "u"}, "4"),
    ({"field": "d.q", "op": ">=", "rvalue": 1}, "14"),
    ({"field": "a#", "op": "=", "rvalue": 0}, "3"),
    (None, "1234"),
]


@pytest.mark.parametrize(("query", "ids"), CASES)
def test_match_or_no_match(docs, query, ids):
    assert "".join(sorted(r._id for r in matching(docs, query).collect())) == ids
    # Strictly compiled it is never null, so its negation is the rest.
    strict = docs.select("_id", compile_query(query, docs.schema).alias("m")).collect()
    assert "".join(sorted(r._id for r in strict if r.m)) == ids
    assert all(r.m is not None for r in strict)


@pytest.mark.parametrize("query", [{"field": "nope", "op": "=", "rvalue": 1}, {"field": "d", "op": "<", "rvalue": 1}, {"field": "s", "op": "~", "rvalue": 1}, {"array": "s", "elemMatch": {"field": "x", "op": "=", "rvalue": 1}}, {}, {"$and": []}])
def test_bad_queries_raise_before_any_job(docs, query):
    with pytest.raises(DocumentError):
        compile_query(query, docs.schema)


def test_filters_reach_the_scan_and_unread_fields_do_not(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    query = {"$and": [{"field": "o_orderstatus", "op": "=", "rvalue": "F"}, {"field": "o_totalprice", "op": ">", "rvalue": 10}, {"field": "o_orderpriority", "op": "$in", "values": ["1-URGENT"]}, {"field": "o_custkey", "op": "!=", "rvalue": 4}]}
    told = request.explain(orders, query)
    assert told["pushed"] == told["fields"] == ["o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
    plan = matching(orders, query).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" not in plan


def test_update_reports_what_it_matched_and_changed(docs):
    out = mutate.update(docs, {"field": "n", "op": ">", "rvalue": 0}, [{"$set": {"s": "abc"}}, {"$append": {"a": 9}}, {"$foreach": {"o": {"field": "x", "op": "=", "rvalue": "u"}, "$update": {"$set": {"y": 0}}}}])
    got = {r._id: r for r in out.collect()}
    assert [got[i]._changed for i in "1234"] == [True, False, True, True]
    assert got["1"].a == [1, 2, 3, 9] and got["2"].a is None and got["3"].a == [9]
    assert [e.y for e in got["4"].o] == [7, 0]
    same = mutate.counts(mutate.update(docs, {"field": "s", "op": "=", "rvalue": "abc"}, {"$set": {"s": "abc"}})).first()
    assert tuple(same) == (1, 0, 0)
    with pytest.raises(DocumentError):
        mutate.update(docs, None, {"$set": {"s": "x"}})


def test_size_limit_stops_before_writing(docs):
    total = mutate.check_size(docs, 1 << 20)
    with pytest.warns(UserWarning, match="bytes"):
        mutate.check_size(docs, 1 << 20, 10)
    with pytest.raises(DocumentError):
        mutate.check_size(docs, total - 1)


def test_versions(docs):
    stamped = docs.select(versions.stamp(versions.stamp(F.lit(None).cast("array<struct<version:string,ms:bigint>>"), "old", 1), "new", 100_000).alias("v")).first().v
    assert [x.version for x in stamped] == ["new"]
    assert versions.with_retries(lambda n: n == 2) == 3
    with pytest.raises(DocumentError):
        versions.with_retries(lambda n: False)


def test_locks(spark):
    step = coordination.transitions(10)
    state, ok, n = step(None, "a", "acquire", 0)
    assert (ok, n) == (True, 1)
    assert step(state, "b", "acquire", 5)[1:] == (False, 0)
    assert step(state, "b", "acquire", 11)[1:] == (True, 1)
    state, ok, n = step(state, "a", "acquire", 5)
    assert (ok, n) == (True, 2)
    state, ok, n = step(state, "a", "release", 6)
    assert (ok, n) == (False, 1)
    assert step(state, "a", "release", 7) == (None, True, 0)
    assert step(state, "b", "ping", 7)[1] is None
    calls = spark.createDataFrame([("r", 2, 20, "b", "acquire"), ("r", 1, 0, "a", "acquire"), ("q", 3, 1, "b", "count")], "resource string, seq long, ms long, caller string, action string")
    assert {r.seq: (r.ok, r["count"]) for r in coordination.replay(calls, 10).collect()} == {1: (True, 1), 2: (True, 1), 3: (None, 0)}


def test_store_commits_and_retries(spark, docs, tmp_path):
    store = Store(spark, str(tmp_path / "c"))
    store.create(docs)
    raced = []

    def change(df):
        if not raced:  # another writer comes first
            raced.append(1)
            Store(spark, str(tmp_path / "c")).change(lambda x: x.where("_id <> '1'"))
        return df.withColumn("n", F.col("n") + 1)

    assert store.change(change) == 2
    assert {r._id: r.n for r in store.read().collect()} == {"2": None, "3": 6, "4": 3}
    assert store.read(0).count() == 4
    with pytest.raises(DocumentError):
        store.change(lambda df: df.unionAll(df), unique=[["_id"]])
    assert store.versions() == [0, 1, 2] and store.healthy()["ok"]


def test_catalog(spark, docs, tmp_path):
    cat = catalog.Catalog(spark, str(tmp_path / "meta"))
    two = catalog.Version("t", "2.0", docs.schema.json(), access={"find": ["r1"]}, field_access={"n": {"find": ["r2"]}})
    with pytest.raises(DocumentError):
        cat.create(catalog.Entity("t", "x", "1.0"), two)
    cat.create(catalog.Entity("t", "x", "2.0", [{"fields": ["s"], "unique": True}]), two)
    cat.add(catalog.Version("t", "1.0-SNAPSHOT", docs.schema.json()))
    cat.add(catalog.Version("t", "1.0-SNAPSHOT", docs.schema.json(), "deprecated"))
    with pytest.raises(DocumentError):
        cat.add(two)
    with pytest.raises(DocumentError):
        cat.add(catalog.Version("t", "3.0", T.StructType([T.StructField("z", T.LongType())]).json()))
    assert cat.versions("t") == ["1.0-SNAPSHOT", "2.0"] and cat.names() == ["t"]
    assert cat.names({"deprecated"}) == ["t"] and cat.names({"disabled"}) == []
    assert cat.version("t").version == "2.0"
    with pytest.raises(DocumentError):
        cat.version("t", "9")
    with pytest.raises(DocumentError):
        cat.set_status("t", "2.0", "disabled")
    assert {(r.role, r.operation): r.paths for r in cat.access_report().collect()} == {("r1", "find"): ["t"], ("r2", "find"): ["t.n"]}
    with pytest.raises(DocumentError):
        cat.remove("t")
    cat.update(catalog.Entity("t", "x", None))
    cat.set_status("t", "2.0", "disabled")
    cat.set_status("t", "1.0-SNAPSHOT", "disabled")
    assert cat.version("t", "2.0").history == ["active"]
    cat.remove("t")
    assert cat.names() == []


def test_index_changes():
    old = [{"fields": ["_id"], "unique": True}, {"name": "i", "fields": ["a"]}, {"fields": ["b"]}]
    make, drop = catalog.index_changes([{"name": "i", "fields": ["a"], "unique": True}], old)
    assert make == [{"name": "i", "fields": ["a"], "unique": True}] and drop == old[1:]


def test_indexes_are_remade_and_checked(spark):
    named = [{"name": "i", "fields": ["a"]}, {"fields": ["b"]}]
    assert catalog.index_changes([{"name": "j", "fields": ["a"]}, {"fields": ["b"]}], named) == ([{"name": "j", "fields": ["a"]}], [named[0]])
    assert catalog.index_changes([{"fields": ["a"]}, {"fields": ["b"], "unique": True}], named) == ([{"fields": ["b"], "unique": True}], [named[1]])
    for bad in ([{"fields": ["a"]}, {"fields": ["a"], "unique": True}], [{"fields": ["o.*"]}]):
        with pytest.raises(DocumentError):
            catalog.check_indexes(bad)
    catalog.check_indexes([{"fields": ["a"]}, {"fields": ["a"], "directions": ["$desc"]}])
    e = lambda flag=None: catalog.Entity("t", "x", manage_indexes=flag)
    assert [catalog.manages_indexes(c, x) for c, x in (({}, e()), ({"managedEntities": ["u"]}, e()), ({"managedEntities": ["u"]}, e(True)), ({"unmanagedEntities": ["t"]}, e()), ({}, e(False)))] == [True, False, True, False, False]


def test_catalog_opens_the_entitys_documents(spark, docs, tmp_path):
    cat = catalog.Catalog(spark, str(tmp_path / "meta"))
    few = T.StructType([docs.schema["_id"], T.StructField("later", T.LongType())])
    docs.write.parquet(str(tmp_path / "plain"))
    Store(spark, str(tmp_path / "store")).create(docs.where("_id < '3'"))
    for name, n in (("plain", 4), ("store", 2)):
        cat.create(catalog.Entity(name, str(tmp_path / name), "1"), catalog.Version(name, "1", few.json()))
        found = cat.documents(name)
        assert found.columns == ["_id", "later"] and found.count() == n


def test_ids_are_given_and_missing_ones_are_no_duplicates(spark):
    base = spark.createDataFrame([("a", 1)], "_id string, n int")
    new = spark.createDataFrame([(None, 2), (None, 3), ("b", 4), ("b", 5), ("a", 6)], "_id string, n int")
    _, result = mutate.insert(base, new)
    assert {r.n: r._errors for r in result.collect()} == {2: [], 3: [], 4: [], 5: ["duplicate:_id"], 6: ["duplicate:_id"]}
    after, _ = mutate.insert(base, mutate.with_ids(new))
    first, again = after.collect(), after.collect()
    assert sorted(first) == sorted(again) and sorted(r.n for r in first) == [1, 2, 3, 4]
    assert all(len(r._id) == 24 for r in first if r.n in (2, 3))


@pytest.mark.parametrize("values", [[1, 2], [2, 1]])
def test_the_last_saved_document_wins(spark, values):
    base = spark.createDataFrame([("a", 0)], "_id string, n int")
    new = spark.createDataFrame([("a", n) for n in values], "_id string, n int").coalesce(1)
    after, result = mutate.save(base, new, ["_id"], False)
    assert [r.n for r in after.collect()] == [values[1]]
    assert {r.n: r._op for r in result.collect()} == {values[0]: "superseded", values[1]: "saved"}
    assert [r.n for r in mutate.save(base, new, ["_id"], False, order="n")[0].collect()] == [2]


def test_nothing_is_sorted_unasked(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    out, _ = request.find(orders, {"query": {"field": "o_orderstatus", "op": "=", "rvalue": "F"}, "projection": {"field": "*"}}, key="o_orderkey")
    assert "Exchange" not in plan(out)
    late = request.find(orders, {"sort": {"o_totalprice": "$desc"}, "range": [7, None], "projection": {"field": "*"}}, key="o_orderkey")[0]
    assert "Limit" not in plan(late) and "SinglePartition" not in plan(late).split("Window")[0]
    want = sorted(orders.collect(), key=lambda r: (-r.o_totalprice, r.o_orderkey))[7:]
    assert [r.o_orderkey for r in late.collect()] == [r.o_orderkey for r in want]


def test_hex_ids_match_in_lower_case(spark):
    df = spark.createDataFrame([("0123456789abcdef01234567", 1), ("ABC", 2)], "_id string, n int")
    ask = lambda q: [r.n for r in matching(df, q).collect()]
    assert ask({"field": "_id", "op": "=", "rvalue": "0123456789ABCDEF01234567"}) == [1]
    assert ask({"field": "_id", "op": "$in", "values": ["0123456789ABCDEF01234567", "abc"]}) == [1]
    assert ask({"field": "_id", "op": "=", "rvalue": "ABC"}) == [2]


def test_sequences_go_on_where_they_stopped(spark, tmp_path):
    path = str(tmp_path / "seq")
    first = coordination.Sequences(spark, path)
    assert [first.take("a", 10, 5), first.take("a", 99, 7, 3), coordination.Sequences(spark, path).take("a"), first.take("b", increment=0)] == [10, 15, 30, 1]


def test_locking_domains():
    config = {"extensions": {"locking": [{"domain": "d", "datasource": "s", "collection": "locks"}]}}
    assert coordination.domains(config, {"s": "/data/"}) == {"d": "/data/locks"} and coordination.domains({}, {}) == {}
    with pytest.raises(DocumentError):
        coordination.domains(config, {})


def test_write_requests(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "_id string, n int, s string")
    version = catalog.Version("t", "1", base.schema.json(), access={"insert": ["r"], "update": ["r"]}, field_access={"s": {"update": ["boss"], "insert": ["boss"]}})
    with pytest.raises(DocumentError):
        request.write(base, {"data": []}, "insert", version, {"nobody"})
    seen = []
    hooks = request.Hooks({"insert": [lambda df: df.withColumn("n", F.col("n") * 10)]}, {"insert": [lambda df: seen.append(df.count())]})
    asked = json.dumps({"data": [{"n": 3}, {"_id": "c", "n": 4, "s": "no"}, {"_id": "a", "n": 5}], "projection": [{"field": "n"}, {"field": "_id"}]})
    done = request.write(base, asked, "insert", version, {"r"}, hooks=hooks, mark="m", upper=["s"])
    rows = {r.n: r for r in done.collection.collect()}
    assert set(rows) == {1, 2, 30} and rows[30].docver[0].version == "m" and len(rows[30]._id) == 24 and seen == [3]
    assert sorted((r.n or 0) for r in done.output.collect()) == [0, 0, 30] and {r._id for r in done.output.where("n is null").collect()} == {"a", "c"}
    change = {"query": {"field": "n", "op": ">", "rvalue": 0}, "update": {"$set": {"n": 2}}, "projection": {"field": "n"}}
    done = request.write(base, change, "update", version, {"r"}, mark="m2", upper=["s"])
    assert {r._id: (r.n, r.docver and r.docver[0].version, r.upper_s) for r in done.collection.collect()} == {"a": (2, "m2", "X"), "b": (2, None, None)}
    done = request.write(base, change | {"update": {"$set": {"s": "z"}}}, "update", version, {"r"})
    assert {r.s for r in done.collection.collect()} == {"x", "y"} and all(r._errors == ["no-access:s"] for r in done.result.collect())
    assert [r.n for r in done.output.collect()] == [None, None]
    done = request.write(base, {"data": {"_id": "b", "n": 7}, "upsert": True}, "save", version, {"r"})
    assert {(r._id, r.n) for r in done.collection.collect()} == {("a", 1), ("b", 7)} and done.output.columns == []
    done = request.write(base, {"query": {"field": "_id", "op": "=", "rvalue": "b"}}, "delete")
    assert [r._id for r in done.collection.collect()] == ["a"] and done.result.count() == 1
    with pytest.raises(DocumentError):
        request.write(base, {}, "delete")


def test_hidden_fields_are_merged_at_any_depth(spark):
    kind = "_id string, d struct<p:string,h:long,l:array<struct<k:long,v:string,in:struct<a:long,b:long>>>>, gone string"
    old = spark.createDataFrame([("1", ("p", 5, [(1, "x", (1, 11)), (2, "y", (2, 22))]), "g"), ("2", ("q", 6, [(3, "u", (3, 33)), (3, "w", (4, 44))]), "h")], kind)
    new = spark.createDataFrame([("1", ("P", [(2, (9,)), (7, (8,))])), ("2", ("Q", [(3, (5,)), (3, None)])), ("9", ("R", []))], "_id string, d struct<p:string,l:array<struct<k:long,in:struct<a:long>>>>")
    got = {r._id: r for r in mutate.merge_invisible(old, new, "_id", {"d.l": "k"}).collect()}
    assert (got["1"].d.p, got["1"].d.h, got["1"].gone) == ("P", 5, "g")
    assert [(e.k, e.v, e["in"].a, e["in"].b) for e in got["1"].d.l] == [(2, "y", 9, 22), (7, None, 8, None)]
    assert [(e.k, e.v, e["in"] and e["in"].b) for e in got["2"].d.l] == [(3, "u", 33), (3, "w", None)]
    assert got["9"].d.h is None and got["9"].d.l == []


def test_outcomes_without_reevaluation(spark):
    now = spark.createDataFrame([("a", 1, [("other", 5)]), ("b", 0, [("mine", 5)])], "_id string, n int, docver array<struct<version:string,ms:bigint>>")
    tried = spark.createDataFrame([("a",), ("b",), ("c",)], "_id string")
    query = {"field": "n", "op": ">", "rvalue": 3}
    told = lambda o: {r._id: r.outcome for r in versions.outcomes(tried, now, "_id", "docver", "mine", query, o).collect()}
    assert told(versions.Conflicts()) == {"a": "lost", "b": "updated", "c": "lost"}
    assert told(versions.Conflicts(reevaluate=False)) == {"a": "failed", "b": "updated", "c": "lost"}
    read = spark.createDataFrame([("a", 1), ("b", 9), ("z", 1)], "_id string, n int")
    assert {r._id for r in versions.skipped(now, read, "_id", "n").collect()} == {"b", "z"}


def test_requests(spark, docs):
    version = catalog.Version("t", "1", docs.schema.json(), access={"find": ["r"]}, field_access={"d.q": {"find": ["boss"]}})
    asked = json.dumps({"query": {"field": "n", "op": ">", "rvalue": 0}, "projection": [{"field": "*", "recursive": True}], "sort": {"n": "$desc"}, "range": [-3, 1]})
    with pytest.raises(DocumentError):
        request.find(docs, asked, version, {"nobody"})
    out, found = request.find(docs, asked, version, {"r"})
    assert [r._id for r in out.collect()] == ["3", "4"] and found.count() == 3
    assert out.schema["d"].dataType.names == ["p"]
    assert request.guarded({"$and": [1]}, "e") == {"$and": [1, {"field": "objectType", "op": "=", "rvalue": "e"}]}
    assert request.preference('nearest({"a": "b"})') == ("nearest", [{"a": "b"}])
    with pytest.raises(DocumentError):
        request.preference("farthest")


def test_time_limit_stops_jobs(spark):
    assert request.limited(spark, lambda: spark.range(5).count(), "soon") == 5
    with pytest.raises(Exception, match="(?i)cancel"):
        request.limited(spark, lambda: spark.range(0, 1 << 35, 1, 1000).selectExpr("sum(hash(id))").collect(), 1500)


def test_json_documents(spark):
    schema = T.StructType.fromDDL("_id string, at timestamp, o array<struct<x:long,at:timestamp>>")
    text = ['{"_id":"1","at":"20240102T03:04:05.678+0000","o":[{"x":1,"at":"20240101T00:00:00.000+0000"},null],"extra":1}', '{"_id":"2","at":"no date"}', "none"]
    df = documents.decode(spark.createDataFrame([(t,) for t in text], "t string"), "t", schema)
    got = df.collect()
    assert got[0].at.microsecond == 678_000 and got[0].o[0].x == 1 and got[0].o[1] is None
    assert got[1].at is None and got[1].o is None and got[2]["_id"] is None
    assert json.loads(documents.encode(df).collect()[0].json)["at"] == "20240102T03:04:05.678+0000"
    assert json.loads(documents.encode(df).collect()[1].json) == {"_id": "2"}


def test_queries_filter_streams(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    run = matching(stream, {"array": "o", "elemMatch": {"field": "x", "op": "=", "rvalue": "u"}}).select("_id").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert {r._id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"1", "4"}
