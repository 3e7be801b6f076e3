"""The registered queries of the document engine over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import associate, coordination, mutate, versions
from .plans import ordering, projection, request
from .plans.query import fields_read, matching
from .sources import catalog, documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested documents: each with its lines, an empty array if it has none."""
    line = F.struct(
        F.col("l_linenumber").alias("linenumber"), F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"), F.col("l_shipdate").alias("shipdate"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return joined.withColumn("lines", F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType)))


def find(name: str, source: str | Callable, query: dict | None, columns: list[str], sql: str) -> None:
    """Register a query that matches and selects."""
    read = (lambda s, d: table(s, d, source)) if isinstance(source, str) else source
    QUERIES[name] = lambda s, d: matching(read(s, d), query).select(*columns)
    SQL[name] = sql


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def lines_sql(condition: str, columns: str = "o_orderkey") -> str:
    return f"SELECT {columns} FROM orders o WHERE {condition}"


# Scalar predicates.
find("find_eq", "orders", {"field": "o_orderstatus", "op": "=", "rvalue": "F"}, ["o_orderkey", "o_orderstatus"], "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
find("find_neq", "orders", {"field": "o_orderstatus", "op": "$neq", "rvalue": "F"}, ["o_orderkey", "o_orderstatus"], "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
find("find_range_ops", "events", {"$and": [{"field": "value", "op": ">", "rvalue": 10}, {"field": "value", "op": "$lte", "rvalue": 50}, {"field": "user_id", "op": ">=", "rvalue": 20}, {"field": "user_id", "op": "$lt", "rvalue": "100"}]}, ["event_id"], "SELECT event_id FROM events WHERE value > 10 AND value <= 50 AND user_id >= 20 AND user_id < 100")
find("find_literal_cast", "part", {"field": "p_size", "op": "=", "rvalue": "10"}, ["p_partkey", "p_size"], "SELECT p_partkey, p_size FROM part WHERE p_size = 10")
find("find_date_literal", "orders", {"field": "o_orderdate", "op": ">=", "rvalue": "1996-01-01"}, ["o_orderkey"], "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'")


def events_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("kind", F.expr("nullif(event_type, 'error')"))


_MISSING = "(SELECT *, nullif(event_type, 'error') AS kind FROM events)"
find("find_missing_neq", events_with_missing, {"field": "kind", "op": "!=", "rvalue": "click"}, ["event_id", "kind"], f"SELECT event_id, kind FROM {_MISSING} WHERE kind IS DISTINCT FROM 'click'")
find("find_missing_not", events_with_missing, {"$not": {"field": "kind", "op": "=", "rvalue": "click"}}, ["event_id"], f"SELECT event_id FROM {_MISSING} WHERE kind IS NULL OR kind <> 'click'")
find("find_null_eq", events_with_missing, {"field": "kind", "op": "=", "rvalue": None}, ["event_id"], f"SELECT event_id FROM {_MISSING} WHERE kind IS NULL")
find("find_in", "customer", {"field": "c_mktsegment", "op": "$in", "values": ["BUILDING", "MACHINERY"]}, ["c_custkey"], "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
find("find_nin", events_with_missing, {"field": "kind", "op": "$nin", "values": ["click", "view"]}, ["event_id"], f"SELECT event_id FROM {_MISSING} WHERE kind IS NULL OR kind NOT IN ('click', 'view')")
find("find_in_null", events_with_missing, {"field": "kind", "op": "$in", "values": ["click", None]}, ["event_id"], f"SELECT event_id FROM {_MISSING} WHERE kind IS NULL OR kind = 'click'")
find("find_in_empty", "customer", {"field": "c_mktsegment", "op": "$in", "values": []}, ["c_custkey"], "SELECT c_custkey FROM customer WHERE false")
find("find_field_cmp", "lineitem", {"field": "l_discount", "op": "<", "rfield": "l_tax"}, ["l_orderkey", "l_linenumber", "l_discount", "l_tax"], "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount < l_tax")


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("status", F.expr("nullif(o_orderstatus, 'F')")).withColumn("first", F.substring("o_orderpriority", 3, 1))


find("find_field_cmp_missing", orders_with_gaps, {"field": "status", "op": "!=", "rfield": "first"}, ["o_orderkey"], "SELECT o_orderkey FROM (SELECT *, nullif(o_orderstatus, 'F') AS status, substr(o_orderpriority, 3, 1) AS first FROM orders) WHERE status <> first")
find("find_regex", "documents", {"field": "text", "regex": "licensed under"}, ["doc_id"], "SELECT doc_id FROM documents WHERE regexp_matches(text, 'licensed under')")
find("find_regex_ci", "pages", {"field": "url", "regex": "HTTPS://WWW", "options": "i"}, ["page_id", "url"], "SELECT page_id, url FROM pages WHERE regexp_matches(url, 'HTTPS://WWW', 'i')")
find("find_regex_flags", "documents", {"field": "text", "regex": "^the .*\\n", "caseInsensitive": True, "multiline": True}, ["doc_id"], "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?im)^the .*\\n')")
find(
    "find_and_or_not", "customer", {"$and": [{"$or": [{"field": "c_nationkey", "op": "<", "rvalue": 5}, {"field": "c_acctbal", "op": "<", "rvalue": 0}]}, {"$not": {"field": "c_mktsegment", "op": "=", "rvalue": "BUILDING"}}]},
    ["c_custkey"], "SELECT c_custkey FROM customer WHERE (c_nationkey < 5 OR c_acctbal < 0) AND NOT c_mktsegment = 'BUILDING'",
)
find("find_object_type", lambda s, d: table(s, d, "events").withColumnRenamed("event_type", "objectType"), {"$and": [{"field": "value", "op": ">", "rvalue": 20}, {"field": "objectType", "op": "=", "rvalue": "purchase"}]}, ["event_id", "value"], "SELECT event_id, value FROM events WHERE value > 20 AND event_type = 'purchase'")

# Arrays and elements.
_LINE = "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND {})"
find("find_any_element", order_docs, {"field": "lines.*.quantity", "op": ">", "rvalue": 49}, ["o_orderkey"], lines_sql(_LINE.format("l_quantity > 49")))
find("find_no_element", order_docs, {"field": "lines.*.returnflag", "op": "!=", "rvalue": "R"}, ["o_orderkey"], lines_sql("NOT " + _LINE.format("l_returnflag = 'R'")))
find("find_scalar_vs_array", order_docs, {"field": "o_totalprice", "op": "<", "rfield": "lines.*.price"}, ["o_orderkey"], lines_sql(_LINE.format("o.o_totalprice < l_extendedprice")))
find("find_star_star", order_docs, {"field": "lines.*.partkey", "op": "=", "rfield": "lines.*.suppkey"}, ["o_orderkey"], lines_sql("EXISTS (SELECT 1 FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey WHERE a.l_orderkey = o.o_orderkey AND a.l_partkey = b.l_suppkey)"))
find("find_in_field", order_docs, {"field": "o_custkey", "op": "$in", "rfield": "lines.*.suppkey"}, ["o_orderkey"], lines_sql(_LINE.format("o.o_custkey = l_suppkey")))
find("find_nin_field", order_docs, {"field": "o_custkey", "op": "$nin", "rfield": "lines.*.suppkey"}, ["o_orderkey"], lines_sql("NOT " + _LINE.format("o.o_custkey = l_suppkey")))
_ALL = "(SELECT count(DISTINCT l_returnflag) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag IN ('R', 'A')) = 2"
find("find_contains_all", order_docs, {"array": "lines.*.returnflag", "contains": "$all", "values": ["R", "A"]}, ["o_orderkey"], lines_sql(_ALL))
find("find_contains_any", order_docs, {"array": "lines.*.returnflag", "contains": "$any", "values": ["R", "A"]}, ["o_orderkey"], lines_sql(_LINE.format("l_returnflag IN ('R', 'A')")))
find("find_contains_none", order_docs, {"array": "lines.*.returnflag", "contains": "$none", "values": ["R", "A"]}, ["o_orderkey"], lines_sql("NOT " + _LINE.format("l_returnflag IN ('R', 'A')")))
find("find_elem_match", order_docs, {"array": "lines", "elemMatch": {"$and": [{"field": "quantity", "op": ">", "rvalue": 40}, {"field": "returnflag", "op": "=", "rvalue": "R"}]}}, ["o_orderkey"], lines_sql(_LINE.format("l_quantity > 40 AND l_returnflag = 'R'")))
find("find_elem_match_not", order_docs, {"array": "lines", "elemMatch": {"$not": {"field": "returnflag", "op": "=", "rvalue": "N"}}}, ["o_orderkey"], lines_sql(_LINE.format("l_returnflag <> 'N'")))
find("find_elem_match_parent", order_docs, {"array": "lines", "elemMatch": {"field": "price", "op": ">", "rfield": "$parent.$parent.o_totalprice"}}, ["o_orderkey"], lines_sql(_LINE.format("l_extendedprice > o.o_totalprice")))
find("find_elem_match_this", "embeddings", {"array": "embedding", "elemMatch": {"field": "$this", "op": ">", "rvalue": 0.3}}, ["vec_id"], "SELECT vec_id FROM embeddings WHERE EXISTS (SELECT 1 FROM (SELECT unnest(embedding) AS x) WHERE x > 0.3::FLOAT)")
find("find_array_index", "embeddings", {"field": "embedding.0", "op": ">", "rvalue": 0}, ["vec_id"], "SELECT vec_id FROM embeddings WHERE embedding[1] > 0")
find("find_array_last", "embeddings", {"field": "embedding.-1", "op": ">", "rvalue": 0}, ["vec_id"], "SELECT vec_id FROM embeddings WHERE embedding[-1] > 0")
find("find_array_out_of_range", "embeddings", {"field": "embedding.900", "op": "=", "rvalue": None}, ["vec_id"], "SELECT vec_id FROM embeddings WHERE embedding[901] IS NULL")
find("find_array_size", order_docs, {"field": "lines#", "op": "=", "rvalue": 0}, ["o_orderkey"], lines_sql("NOT " + _LINE.format("true")))


def token_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with the codes of the text's first and last letters, as arrays of equal and unequal length."""
    t = table(spark, sf_dir, "conversations")
    return t.withColumn("a", F.when(F.pmod("turn", F.lit(3)) > 0, F.array(F.col("conv_id") % 5, F.col("turn") % 4))).withColumn("b", F.when(F.col("turn") % 5 == 0, F.array(F.col("turn") % 3)).otherwise(F.array(F.col("conv_id") % 4, F.col("turn") % 3)))


_ARRAYS = "(SELECT conv_id, turn, CASE WHEN turn % 3 > 0 THEN [conv_id % 5, turn % 4] END AS a, CASE WHEN turn % 5 = 0 THEN [turn % 3] ELSE [conv_id % 4, turn % 3] END AS b FROM conversations)"
find("find_array_vs_array", token_arrays, {"field": "a", "op": "<=", "rfield": "b"}, ["conv_id", "turn"], f"SELECT conv_id, turn FROM {_ARRAYS} WHERE a IS NOT NULL AND len(a) = len(b) AND a[1] <= b[1] AND (len(a) < 2 OR a[2] <= b[2])")
find("find_array_neq", token_arrays, {"field": "a", "op": "!=", "rfield": "b"}, ["conv_id", "turn"], f"SELECT conv_id, turn FROM {_ARRAYS} WHERE a IS DISTINCT FROM b")


# Projections.
def _lines_out(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("o_orderkey", F.explode("lines").alias("e")).select("o_orderkey", *[F.col(f"e.{c}").alias(c) for c in columns])


@register("project_array_elems", "SELECT l_orderkey AS o_orderkey, l_partkey AS partkey, l_quantity AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(s, d):
    df = projection.project(order_docs(s, d), [{"field": "o_orderkey"}, {"field": "lines.*.partkey"}, {"field": "lines.*.quantity"}])
    return _lines_out(df, *df.schema["lines"].dataType.elementType.names)


@register("project_nested", "SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer")
def _(s, d):
    docs = table(s, d, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")).alias("place")).alias("info"))
    df = projection.project(docs, [{"field": "c_custkey"}, {"field": "info.name"}, {"field": "info.place.nation"}])
    return df.select("c_custkey", "info.name", "info.place.nation")


@register("project_recursive", "SELECT o_orderkey, l_linenumber AS linenumber, l_tax AS tax FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(s, d):
    return _lines_out(projection.project(order_docs(s, d), {"field": "*", "recursive": True}), "linenumber", "tax")


@register("project_exclude", "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders")
def _(s, d):
    return projection.project(table(s, d, "orders"), [{"field": "*"}, {"field": "o_totalprice", "include": False}, {"field": "o_orderstatus", "include": False}])


@register("project_array_size", 'SELECT o_orderkey, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS "lines#" FROM orders o')
def _(s, d):
    return projection.project(order_docs(s, d), [{"field": "o_orderkey"}, {"field": "lines#"}])


@register("project_by_role", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def _(s, d):
    return projection.project(table(s, d, "customer"), {"field": "*", "recursive": True}, hidden=["c_acctbal"])


# Sorting, pages, counts.
@register("sort_composite", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100")
def _(s, d):
    return ordering.page(table(s, d, "orders"), [{"o_orderpriority": "$asc"}, {"o_totalprice": "$desc"}], 0, 99, "o_orderkey").select("o_orderkey", "o_totalprice")


@register("sort_array_key", "SELECT o_orderkey, max(l_extendedprice) AS top FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY top DESC NULLS LAST, o_orderkey LIMIT 50")
def _(s, d):
    return ordering.page(order_docs(s, d), {"lines.*.price": "$desc"}, 0, 49, "o_orderkey").select("o_orderkey", F.array_max("lines.price").alias("top"))


@register("page_range", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 11 OFFSET 20")
def _(s, d):
    return ordering.page(table(s, d, "orders"), {"o_orderdate": "$desc"}, 20, 30, "o_orderkey").select("o_orderkey")


@register("page_to_lt_from", "SELECT o_orderkey FROM orders WHERE false")
def _(s, d):
    return ordering.page(table(s, d, "orders"), {"o_orderdate": "$desc"}, 20, 10, "o_orderkey").select("o_orderkey")


@register("count_matches", "SELECT count(*) AS matched FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def _(s, d):
    query = {"$and": [{"field": "o_orderstatus", "op": "=", "rvalue": "F"}, {"field": "o_totalprice", "op": ">", "rvalue": 1000}]}
    return matching(table(s, d, "orders"), query).agg(F.count("*").alias("matched"))


@register("data_size", "SELECT sum(octet_length(('{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"c_nationkey\":' || c_nationkey || ',\"c_mktsegment\":\"' || c_mktsegment || '\"}')::BLOB))::BIGINT AS bytes FROM customer")
def _(s, d):
    df = table(s, d, "customer").drop("c_acctbal")
    return df.agg(F.sum(mutate.data_size(df)).alias("bytes"))


# Associations.
@register("assoc_scalar", "SELECT c_custkey, count(o_orderkey) AS n, min(o_orderkey) AS first FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def _(s, d):
    df = associate.associate(table(s, d, "customer"), table(s, d, "orders"), "c_custkey", "o_custkey", "$parent.c_custkey", "orders", ["o_orderkey"])
    return df.select("c_custkey", F.coalesce(F.size("orders"), F.lit(0)).cast("long").alias("n"), F.array_min("orders.o_orderkey").alias("first"))


@register("assoc_array_in", "SELECT o_orderkey, count(DISTINCT p_partkey) AS n, min(p_size) AS least FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1")
def _(s, d):
    df = associate.associate(order_docs(s, d), table(s, d, "part"), "o_orderkey", "p_partkey", "$parent.lines.*.partkey", "parts", ["p_size"])
    return df.select("o_orderkey", F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n"), F.array_min("parts.p_size").alias("least"))


@register("assoc_empty", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(s, d):
    df = associate.associate(order_docs(s, d), table(s, d, "part"), "o_orderkey", "p_partkey", "$parent.lines.*.partkey", "parts", ["p_size"])
    return df.where("parts is null").select("o_orderkey")


@register("assoc_in_elements", "SELECT l_orderkey AS o_orderkey, l_linenumber AS linenumber, l_suppkey AS suppkey, s_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey")
def _(s, d):
    df = associate.associate_elements(order_docs(s, d), table(s, d, "supplier"), "o_orderkey", "lines", "s_suppkey", "suppkey", "supplier", ["s_name"])
    return df.select("o_orderkey", F.explode("lines").alias("e")).select("o_orderkey", "e.linenumber", "e.suppkey", "e.supplier.s_name")


@register("required_fields", "SELECT * FROM (VALUES ('o_orderdate'), ('o_orderkey'), ('o_orderstatus'), ('o_totalprice')) t(field)")
def _(s, d):
    query = {"$and": [{"field": "o_orderstatus", "op": "=", "rvalue": "F"}, {"field": "o_totalprice", "op": ">", "rvalue": 1}]}
    return s.createDataFrame([(x,) for x in fields_read(query, [{"field": "o_orderkey"}], {"o_orderdate": "$asc"})], "field string")


# Updates.
_F = {"field": "o_orderstatus", "op": "=", "rvalue": "F"}


def updated(name: str, source: str | Callable, query: dict, change: dict | list, columns: list[str], sql: str) -> None:
    read = (lambda s, d: table(s, d, source)) if isinstance(source, str) else source
    QUERIES[name] = lambda s, d: mutate.update(read(s, d), query, change).select(*columns)
    SQL[name] = sql


updated("update_set", "orders", _F, {"$set": {"o_orderpriority": "9-DONE"}}, ["o_orderkey", "o_orderpriority", "_changed"], "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '9-DONE' ELSE o_orderpriority END AS o_orderpriority, o_orderstatus = 'F' AS _changed FROM orders")
updated("update_set_valueof", "orders", _F, {"$set": {"o_custkey": {"valueof": "o_orderkey"}}}, ["o_orderkey", "o_custkey"], "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE o_custkey END AS o_custkey FROM orders")
updated("update_add", "customer", {"field": "c_nationkey", "op": "<", "rvalue": 10}, {"$add": {"c_custkey": 1000000}}, ["c_custkey", "c_name"], "SELECT CASE WHEN c_nationkey < 10 THEN c_custkey + 1000000 ELSE c_custkey END AS c_custkey, c_name FROM customer")
updated("update_unset", "customer", {"field": "c_acctbal", "op": "<", "rvalue": 0}, {"$unset": ["c_mktsegment"]}, ["c_custkey", "c_mktsegment"], "SELECT c_custkey, CASE WHEN NOT c_acctbal < 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
updated("update_list", "orders", _F, [{"$set": {"o_custkey": 5}}, {"$add": {"o_custkey": {"valueof": "o_custkey"}}}, {"$set": {"o_orderstatus": "X"}}], ["o_orderkey", "o_custkey", "o_orderstatus"], "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 10 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")


def line_updates(name: str, query: dict, change: dict | list, columns: list[str], sql: str) -> None:
    QUERIES[name] = lambda s, d: _lines_out(mutate.update(order_docs(s, d), query, change), *columns)
    SQL[name] = sql


_ROWS = "(SELECT o.*, l.*, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS i, count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders o JOIN lineitem l ON l_orderkey = o_orderkey)"
line_updates("update_array_index", _F, {"$set": {"lines.0.quantity": 1, "lines.-1.returnflag": "Z"}}, ["partkey", "quantity", "returnflag"], f"SELECT o_orderkey, l_partkey AS partkey, CASE WHEN o_orderstatus = 'F' AND i = 0 THEN 1 ELSE l_quantity END AS quantity, CASE WHEN o_orderstatus = 'F' AND i = n - 1 THEN 'Z' ELSE l_returnflag END AS returnflag FROM {_ROWS}")
line_updates("update_append", _F, {"$append": {"lines": {"partkey": 7, "quantity": 1}}}, ["partkey", "quantity"], "SELECT l_orderkey AS o_orderkey, l_partkey AS partkey, l_quantity AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey UNION ALL SELECT o_orderkey, 7, 1 FROM orders WHERE o_orderstatus = 'F'")
line_updates("update_append_empty", _F, [{"$append": {"lines": {}}}, {"$set": {"lines.-1.partkey": 3}}], ["partkey", "quantity"], "SELECT l_orderkey AS o_orderkey, l_partkey AS partkey, l_quantity AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey UNION ALL SELECT o_orderkey, 3, NULL FROM orders WHERE o_orderstatus = 'F'")
line_updates("update_unset_element", _F, {"$unset": "lines.0"}, ["partkey"], f"SELECT o_orderkey, l_partkey AS partkey FROM {_ROWS} WHERE o_orderstatus <> 'F' OR i > 0")
line_updates("update_foreach", _F, {"$foreach": {"lines": {"field": "returnflag", "op": "=", "rvalue": "R"}, "$update": [{"$set": {"quantity": 0}}, {"$add": {"suppkey": {"valueof": "partkey"}}}]}}, ["partkey", "quantity", "suppkey"], "SELECT o_orderkey, l_partkey AS partkey, CASE WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 0 ELSE l_quantity END AS quantity, CASE WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN l_suppkey + l_partkey ELSE l_suppkey END AS suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
line_updates("update_foreach_remove", _F, {"$foreach": {"lines": {"field": "quantity", "op": "<", "rvalue": 25}, "$update": "$remove"}}, ["partkey", "quantity"], "SELECT o_orderkey, l_partkey AS partkey, l_quantity AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE NOT (o_orderstatus = 'F' AND l_quantity < 25)")


@register("update_insert_at", "SELECT vec_id, unnest(e) AS x, (generate_subscripts(e, 1) - 1)::BIGINT AS pos FROM (SELECT vec_id, CASE WHEN label = 1 THEN list_concat(embedding[1:1], [7::FLOAT, 8::FLOAT], embedding[2:]) ELSE embedding END AS e FROM embeddings)")
def _(s, d):
    df = mutate.update(table(s, d, "embeddings"), {"field": "label", "op": "=", "rvalue": 1}, {"$insert": {"embedding.1": [7, 8]}})
    return df.select("vec_id", F.posexplode("embedding").alias("pos", "x")).withColumn("pos", F.col("pos").cast("long"))


@register("update_counts", "SELECT count(*) FILTER (o_orderstatus = 'F') AS matched, count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') AS updated, 0::BIGINT AS failed FROM orders")
def _(s, d):
    return mutate.counts(mutate.update(table(s, d, "orders"), _F, {"$set": {"o_orderpriority": "1-URGENT"}}))


@register("update_errors", "SELECT c_custkey, CASE WHEN c_nationkey < 5 AND c_acctbal >= 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END AS n_errors FROM customer WHERE false UNION ALL SELECT c_custkey, c_mktsegment, CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END FROM customer")
def _(s, d):
    df = mutate.update(table(s, d, "customer"), {"field": "c_nationkey", "op": "<", "rvalue": 5}, {"$unset": "c_mktsegment"}, mutate.Constraints(required=("c_mktsegment",)))
    return df.select("c_custkey", "c_mktsegment", F.size("_errors").alias("n_errors"))


# Inserts, saves, deletes.
def _halves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(s, d, "customer")
    return c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0").withColumn("c_name", F.concat(F.lit("new "), "c_name"))


_NEW = "'new ' || c_name AS c_name"


@register("insert_docs", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, {_NEW} FROM customer WHERE c_custkey % 6 = 0")
def _(s, d):
    return mutate.insert(*_halves(s, d), "c_custkey")[0].select("c_custkey", "c_name")


@register("insert_duplicate", "SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0")
def _(s, d):
    return mutate.insert(*_halves(s, d), "c_custkey")[1].where("size(_errors) > 0").select("c_custkey")


@register("save_upsert", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 1 UNION ALL SELECT c_custkey, {_NEW} FROM customer WHERE c_custkey % 2 = 0")
def _(s, d):
    return mutate.save(*_halves(s, d), ["c_custkey"], True)[0].select("c_custkey", "c_name")


@register("save_no_upsert", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'error' ELSE 'saved' END AS op FROM customer WHERE c_custkey % 2 = 0")
def _(s, d):
    return mutate.save(*_halves(s, d), ["c_custkey"], False)[1].select("c_custkey", F.col("_op").alias("op"))


@register("delete_docs", "SELECT o_orderkey FROM orders WHERE NOT o_orderstatus = 'F'")
def _(s, d):
    return mutate.delete(table(s, d, "orders"), _F)[0].select("o_orderkey")


@register("merge_invisible", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def _(s, d):
    old = table(s, d, "orders")
    return mutate.merge_invisible(old, old.select("o_orderkey", "o_orderstatus"), "o_orderkey").select("o_orderkey", "o_orderstatus", "o_orderpriority")


_ELEMENTS = f"""
WITH r AS (SELECT o_orderkey, i, n, l_partkey, l_shipdate FROM {_ROWS}), twice AS (SELECT o_orderkey, count(DISTINCT l_partkey) < count(*) AS twice FROM r GROUP BY 1)
SELECT a.o_orderkey, (a.n - 1 - a.i)::BIGINT AS pos, a.l_partkey AS partkey, CASE WHEN twice THEN b.l_shipdate ELSE a.l_shipdate END AS shipdate
FROM r a JOIN twice t ON t.o_orderkey = a.o_orderkey JOIN r b ON b.o_orderkey = a.o_orderkey AND b.i = a.n - 1 - a.i
"""


@register("merge_invisible_elements", _ELEMENTS)
def _(s, d):
    """Elements turned round: hidden fields follow their part, or stay in place where a part stands twice."""
    old = order_docs(s, d)
    new = old.select("o_orderkey", F.reverse(F.transform("lines", lambda e: F.struct(e["partkey"].alias("partkey"), e["quantity"].alias("quantity")))).alias("lines"))
    df = mutate.merge_invisible(old, new, "o_orderkey", {"lines": "partkey"})
    return df.select("o_orderkey", F.posexplode("lines").alias("pos", "e")).select("o_orderkey", F.col("pos").cast("long").alias("pos"), "e.partkey", "e.shipdate")


def _order_batch(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A collection of orders, and new documents: every fourth one changed, every eighth a second time with a later turn, and some without an id."""
    o = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("_id"), F.col("o_orderstatus").alias("status"), "o_totalprice", F.lit(1).alias("turn"), F.col("o_orderkey").alias("k"))
    again = o.where("k % 4 = 0").withColumns({"status": F.lit("first"), "turn": F.lit(2)})
    twice = o.where("k % 8 = 0").withColumns({"status": F.lit("second"), "turn": F.lit(3)})
    return o.where("k % 3 <> 0"), twice.unionByName(again)


@register("save_last_wins", "SELECT o_orderkey::VARCHAR AS _id, CASE WHEN o_orderkey % 8 = 0 THEN 'second' WHEN o_orderkey % 4 = 0 THEN 'first' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0")
def _(s, d):
    base, new = _order_batch(s, d)
    return mutate.save(base, new, ["_id"], True, order="turn")[0].select("_id", "status")


@register("save_counts", "SELECT count(*) FILTER (o_orderkey % 4 = 0 AND o_orderkey % 3 = 0) AS inserted, count(*) FILTER (o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0) AS saved, count(*) FILTER (o_orderkey % 8 = 0) AS superseded, 0::BIGINT AS failed FROM orders")
def _(s, d):
    base, new = _order_batch(s, d)
    return mutate.tally(mutate.save(base, new, ["_id"], True, order="turn")[1])


@register("insert_request", "SELECT length(i) AS id_length, status, n FROM (SELECT CASE WHEN o_orderkey % 8 = 0 THEN repeat('x', 24) ELSE o_orderkey::VARCHAR END AS i, 'new' AS status, count(*)::BIGINT AS n FROM orders WHERE o_orderkey % 4 = 0 AND (o_orderkey % 3 = 0 OR o_orderkey % 8 = 0) GROUP BY ALL) t ORDER BY ALL")
def _(s, d):
    """New documents, some without an id and some with one that is taken: each that is written has an id and a version."""
    base, _new = _order_batch(s, d)
    new = table(s, d, "orders").where("o_orderkey % 4 = 0").select(F.when(F.col("o_orderkey") % 8 > 0, F.col("o_orderkey").cast("string")).alias("_id"), F.lit("new").alias("status"), "o_totalprice", F.lit(1).alias("turn"), F.col("o_orderkey").alias("k"))
    done = request.write(base, {"data": new, "projection": {"field": "*"}}, "insert", mark="v1")
    written = done.collection.where("status = 'new' and docver[0].version = 'v1'")
    named = F.when(F.length("_id") == 24, F.lit("x" * 24)).otherwise(F.col("_id"))
    return written.groupBy(named.alias("i"), "status").agg(F.count("*").alias("n")).select(F.length("i").cast("long").alias("id_length"), "status", "n")


@register("update_request", "SELECT c_custkey, CASE WHEN c_nationkey < 5 AND c_acctbal >= 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_nationkey < 5 AND c_acctbal >= 0 THEN 'v2' END AS ver FROM customer")
def _(s, d):
    """An update by a role that may not write the balance: documents whose balance it would change stay as they were, and only what changed is stamped."""
    _old, version = _customer_versions(s, d)
    change = [{"$unset": "c_mktsegment"}, {"$foreach": {"debts": {"field": "$this", "op": "<", "rvalue": 0}, "$update": {"$set": {"$this": 0}}}}]
    docs = table(s, d, "customer").withColumn("debts", F.array("c_acctbal"))
    shut = catalog.Version("customer", "2.0", version.schema, access=version.access, field_access={"debts": {"update": ["chief"]}})
    done = request.write(docs, {"query": {"field": "c_nationkey", "op": "<", "rvalue": 5}, "update": change}, "update", shut, {"clerk"}, "c_custkey", mark="v2")
    return done.collection.select("c_custkey", "c_mktsegment", F.get("docver", F.lit(0)).getField("version").alias("ver"))


@register("merge_invisible_nested", "SELECT o_orderkey, i::BIGINT AS pos, l_partkey AS partkey, l_shipdate AS shipdate FROM (SELECT o_orderkey, l_partkey, l_shipdate, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey)")
def _(s, d):
    """Hidden fields of elements in an object: line numbers stand twice in some orders, so elements are matched by position there, elsewhere by number."""
    old = order_docs(s, d).select("o_orderkey", F.struct("lines", F.col("o_orderpriority").alias("priority")).alias("box"))
    new = old.select("o_orderkey", F.struct(F.transform("box.lines", lambda e: F.struct(e["linenumber"].alias("linenumber"), e["partkey"].alias("partkey"))).alias("lines")).alias("box"))
    df = mutate.merge_invisible(old, new, "o_orderkey", {"box.lines": "linenumber"})
    return df.select("o_orderkey", F.posexplode("box.lines").alias("pos", "e")).select("o_orderkey", F.col("pos").cast("long").alias("pos"), "e.partkey", "e.shipdate")


@register("reindex_some", "SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN upper(s_name) END AS upper_s_name FROM supplier")
def _(s, d):
    return mutate.reindex(table(s, d, "supplier"), ["s_name"], {"field": "s_nationkey", "op": "<", "rvalue": 10}).select("s_suppkey", "upper_s_name")


@register("page_open_end", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r > 20")
def _(s, d):
    return ordering.page(table(s, d, "orders"), {"o_orderdate": "$desc"}, 20, None, "o_orderkey").select("o_orderkey")


@register("hidden_upper", "SELECT s_suppkey, upper(s_name) AS upper_s_name FROM supplier")
def _(s, d):
    return mutate.hidden_upper(table(s, d, "supplier"), ["s_name"]).select("s_suppkey", "upper_s_name")


@register("unique_index_check", "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return mutate.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("partial_unique_check", "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem WHERE l_quantity > 25 GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return mutate.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], {"field": "l_quantity", "op": ">", "rvalue": 25})


# Versions.
def _versioned(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").withColumn("ver", F.when(F.col("o_orderkey") % 5 > 0, (F.col("o_orderkey") % 7).cast("string")))


@register("update_if_same", "SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 < 4")
def _(s, d):
    now = _versioned(s, d)
    read = now.withColumn("ver", F.when(F.col("ver") < "4", F.col("ver")).when(F.col("ver").isNotNull(), F.lit("old")))
    return versions.same_version(now, read, "o_orderkey", "ver").select("o_orderkey")


@register("detect_lost_updates", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 = 0")
def _(s, d):
    o = table(s, d, "orders")
    kind = "array<struct<version:string,ms:bigint>>"
    stamped = o.withColumn("docver", versions.stamp(F.lit(None).cast(kind), "mine", 1000))
    other = o.withColumn("docver", versions.stamp(F.lit(None).cast(kind), "theirs", 2000))
    now = stamped.where("o_orderkey % 4 <> 0").unionByName(other.where("o_orderkey % 4 = 0"))
    return versions.lost_updates(now, o.where("o_orderstatus = 'F'"), "o_orderkey", "docver", "mine").select("o_orderkey")


@register("update_lost", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'lost' WHEN o_orderkey % 4 = 1 THEN 'updated' WHEN o_orderkey % 4 = 2 THEN 'failed' ELSE 'lost' END AS outcome FROM orders WHERE o_orderstatus = 'F'")
def _(s, d):
    """Orders that we updated, when another writer has deleted some, closed some, and touched others that still match."""
    o = table(s, d, "orders")
    kind = "array<struct<version:string,ms:bigint>>"
    entry_of = lambda name: versions.stamp(F.lit(None).cast(kind), name, 1000)
    now = o.where("o_orderkey % 4 <> 0").withColumn("docver", F.when(F.col("o_orderkey") % 4 == 1, entry_of("mine")).otherwise(entry_of("theirs")))
    now = now.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 3, "X").otherwise(F.col("o_orderstatus")))
    return versions.outcomes(o.where("o_orderstatus = 'F'"), now, "o_orderkey", "docver", "mine", _F)


@register("entity_names", "SELECT * FROM (VALUES ('customer', 'deprecated'), ('customer', 'active')) t(name, status)")
def _(s, d):
    return s.createDataFrame([(v.name, v.status) for v in _customer_versions(s, d)], "name string, status string").distinct()


@register("version_text", "SELECT o_orderkey, o_orderkey::VARCHAR AS id, CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 7)::VARCHAR END AS version FROM orders")
def _(s, d):
    df = _versioned(s, d).withColumn("t", versions.text(F.col("o_orderkey"), F.col("ver")))
    key, version = versions.split(F.col("t"))
    return df.select("o_orderkey", key.alias("id"), version.alias("version"))


@register("sequence_ids", "SELECT o_orderkey, 100 + 10 * (row_number() OVER (ORDER BY o_orderkey) - 1) AS seq FROM orders")
def _(s, d):
    return coordination.sequence(table(s, d, "orders"), ["o_orderkey"], "seq", 100, 10).select("o_orderkey", "seq")


_LOCKS = """
WITH RECURSIVE e AS (
  SELECT 'r' || user_id AS resource, event_id AS seq, epoch_ms(ts) AS ms, 'c' || (event_id % 3) AS caller,
    CASE event_type WHEN 'purchase' THEN 'release' WHEN 'error' THEN 'ping' ELSE 'acquire' END AS action,
    row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS k FROM events
), s AS (
  SELECT DISTINCT resource, 0::BIGINT AS k, NULL::VARCHAR AS owner, 0::BIGINT AS n, 0::BIGINT AS until, NULL::BIGINT AS seq, NULL::VARCHAR AS caller, NULL::VARCHAR AS action, NULL::BOOLEAN AS ok, 0::BIGINT AS count FROM e
  UNION ALL
  SELECT resource, k,
    CASE WHEN action = 'acquire' AND NOT mine AND free THEN caller WHEN action = 'release' AND mine AND n <= 1 THEN NULL ELSE owner END,
    CASE WHEN action = 'acquire' AND mine THEN n + 1 WHEN action = 'acquire' AND free THEN 1 WHEN action = 'release' AND mine THEN n - 1 ELSE n END,
    CASE WHEN action = 'acquire' AND (mine OR free) OR action = 'ping' AND mine THEN ms + 3600000 ELSE until END,
    seq, caller, action,
    CASE WHEN action = 'acquire' THEN mine OR free WHEN NOT mine THEN NULL WHEN action = 'release' THEN n <= 1 ELSE true END,
    CASE WHEN action = 'acquire' AND mine THEN n + 1 WHEN action = 'acquire' AND free THEN 1 WHEN NOT mine OR action = 'acquire' THEN 0 WHEN action = 'release' THEN greatest(n - 1, 0) ELSE n END
  FROM (SELECT e.*, s.owner, s.n, s.until, coalesce(s.owner = e.caller AND s.until > e.ms, false) AS mine, s.owner IS NULL OR s.until <= e.ms OR s.n <= 0 AS free
    FROM s JOIN e ON e.resource = s.resource AND e.k = s.k + 1)
)
SELECT resource, seq, caller, action, ok, count FROM s WHERE seq IS NOT NULL
"""


@register("lock_transitions", _LOCKS)
def _(s, d):
    e = table(s, d, "events")
    action = F.when(F.col("event_type") == "purchase", "release").when(F.col("event_type") == "error", "ping").otherwise("acquire")
    calls = e.select(F.concat(F.lit("r"), F.col("user_id")).alias("resource"), F.col("event_id").alias("seq"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.concat(F.lit("c"), F.col("event_id") % 3).alias("caller"), action.alias("action"))
    return coordination.replay(calls, 3_600_000)


@register("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(s, d):
    return table(s, d, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@register("explain_filter", "SELECT * FROM (VALUES ('o_orderstatus', true), ('o_totalprice', true), ('o_orderkey', false)) t(field, pushed)")
def _(s, d):
    query = {"$and": [_F, {"field": "o_totalprice", "op": ">", "rvalue": 1000}]}
    told = request.explain(table(s, d, "orders"), query, {"field": "o_orderkey"})
    return s.createDataFrame([(f, f in told["pushed"]) for f in told["fields"]], "field string, pushed boolean")


# Requests, catalog, codecs.
@register("find_request", "SELECT event_id, value FROM events WHERE event_type = 'purchase' AND value > 20 ORDER BY value DESC, event_id LIMIT 20 OFFSET 5")
def _(s, d):
    asked = {"objectType": "purchase", "query": {"field": "value", "op": ">", "rvalue": 20}, "projection": [{"field": "event_id"}, {"field": "value"}], "sort": {"value": "$desc"}, "range": [5, 24]}
    return request.find(table(s, d, "events").withColumnRenamed("event_type", "objectType"), asked, key="event_id")[0]


def _customer_versions(s: SparkSession, d: str) -> list[catalog.Version]:
    schema = table(s, d, "customer").schema
    old = schema.fieldNames()[:3]
    return [
        catalog.Version("customer", "1.0", T.StructType([schema[c] for c in old]).json(), "deprecated", access={"find": ["anyone"], "update": ["clerk"]}),
        catalog.Version("customer", "2.0", T.StructType([*schema.fields, T.StructField("c_note", T.StringType())]).json(), access={"find": ["anyone"], "update": ["clerk", "chief"]}, field_access={"c_acctbal": {"find": ["chief"], "update": ["chief"]}}),
    ]


@register("find_version_view", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey < 5")
def _(s, d):
    asked = {"query": {"field": "c_nationkey", "op": "<", "rvalue": 5}, "projection": {"field": "*", "recursive": True}}
    return request.find(table(s, d, "customer"), asked, _customer_versions(s, d)[0], key="c_custkey")[0]


@register("find_version_roles", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, NULL::VARCHAR AS c_note FROM customer WHERE c_nationkey < 5")
def _(s, d):
    asked = {"query": {"field": "c_nationkey", "op": "<", "rvalue": 5}, "projection": {"field": "*", "recursive": True}}
    return request.find(table(s, d, "customer"), asked, _customer_versions(s, d)[1], {"clerk"}, "c_custkey")[0]


@register("access_report", "SELECT * FROM (VALUES ('anyone', 'find', 'customer'), ('clerk', 'update', 'customer'), ('chief', 'update', 'customer,customer.c_acctbal'), ('chief', 'find', 'customer.c_acctbal')) t(role, operation, paths)")
def _(s, d):
    return catalog.access_rows(s, _customer_versions(s, d)).withColumn("paths", F.array_join("paths", ","))


@register("json_round_trip", "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m%dT%H:%M:%S.000+0000') AS written, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day FROM orders")
def _(s, d):
    docs = table(s, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    text = documents.encode(docs)
    back = documents.decode(text, "json", docs.schema)
    return back.select("o_orderkey", "o_orderstatus", F.date_format(F.to_utc_timestamp("o_orderdate", F.current_timezone()), "yyyyMMdd'T'HH:mm:ss.SSS'+0000'").alias("written"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"))


@register("json_loose", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(s, d):
    return documents.loose(table(s, d, "events"), "props").select("event_id", F.try_variant_get("value", "$.k", "long").alias("k"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: orders with a large returned line, some nested fields and the customer, sorted, the first 100."""
    query = {"$and": [{"field": "o_orderstatus", "op": "$in", "values": ["F", "O"]}, {"array": "lines", "elemMatch": {"$and": [{"field": "quantity", "op": ">", "rvalue": 40}, {"field": "returnflag", "op": "=", "rvalue": "R"}]}}]}
    found = matching(order_docs(spark, sf_dir), query)
    first = ordering.page(found, [{"o_totalprice": "$desc"}], 0, 99, "o_orderkey")
    joined = associate.associate(first, table(spark, sf_dir, "customer"), "o_orderkey", "c_custkey", "$parent.o_custkey", "customer", ["c_name"])
    items = [{"field": "o_orderkey"}, {"field": "o_totalprice"}, {"field": "lines.*.partkey"}, {"field": "lines.*.quantity"}, {"field": "customer.*.c_name"}]
    return ordering.page(projection.project(joined, items), [{"o_totalprice": "$desc"}], last="o_orderkey")


@register("flagship", """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_lines, (SELECT sum(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) AS quantity, (SELECT any_value(c_name) FROM customer WHERE c_custkey = o_custkey) AS customer
FROM orders o WHERE o_orderstatus IN ('F', 'O') AND EXISTS (SELECT 1 FROM lineitem l WHERE l_orderkey = o_orderkey AND l_quantity > 40 AND l_returnflag = 'R') ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def _(s, d):
    total = F.aggregate("lines.quantity", F.lit(0.0), lambda a, x: a + x)
    return entry(s, d).select("o_orderkey", "o_totalprice", F.size("lines").cast("long").alias("n_lines"), total.alias("quantity"), F.get("customer.c_name", F.lit(0)).alias("customer"))
