"""Scans, sinks, format round trips, the frame bridge, user functions and table statistics."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.catalog import query
from tarnwork.functions import legacy
from tarnwork.functions.user import UserAggregate
from tarnwork.session import fresh_dir
from tarnwork.sources import frames, json, ranges, text

c = F.col


def _table(t, label: str, columns: str, partitioned_by: str = "") -> tuple[str, str]:
    """An empty external Parquet table under the shared folder."""
    name, path = f"tw_{label}_{uuid.uuid4().hex[:8]}", fresh_dir(t.spark, label)
    by = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    t.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{path}'")
    return name, path


@query("src01_parquet_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")
def _(t):
    return t.spark.read.parquet(t.path("lineitem")).where("l_quantity > 45 AND l_returnflag = 'R'").select("l_orderkey", "l_quantity")


def _event_json(t) -> str:
    path = fresh_dir(t.spark, "events-json")
    shape = F.struct(
        "event_id", "event_type", F.when(c("event_id") % 2 == 0, c("value")).alias("value"),
        F.struct(F.get_json_object("props", "$.k").cast("long").alias("k")).alias("props"),
    )
    t.events.select(F.to_json(shape).alias("value")).write.text(path)
    return path


_JSON = "SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN value END AS value, json_extract_string(props, '$.k')::BIGINT AS k FROM events"


@query("src02_json_inferred", _JSON)
def _(t):
    return json.read_lines(t.spark, _event_json(t)).select("event_id", "event_type", "value", c("props.k").alias("k"))


@query("src03_json_given_schema", _JSON)
def _(t):
    schema = T.StructType.fromDDL("event_id long, event_type string, value double, props struct<k: long>")
    return json.read_lines(t.spark, _event_json(t), schema).select("event_id", "event_type", "value", c("props.k").alias("k"))


@query("src04_json_sampled", _JSON)
def _(t):
    return json.read_lines(t.spark, _event_json(t), sampling_ratio=0.5).select("event_id", "event_type", "value", c("props.k").alias("k"))


@query("src05_json_schema_inference", "SELECT 'a:bigint,b:string,c:struct<x:double,y:string>,d:array<bigint>,e:string' AS fields, count(*) AS n FROM part")
def _(t):
    # Kinds that conflict between rows: number/text, integer/real inside a struct, absent and null fields.
    body = F.when(
        c("p_size") % 3 == 0, F.concat(F.lit('{"b":1,"a":'), c("p_size"), F.lit(',"c":{"x":1}}'))
    ).when(
        c("p_size") % 3 == 1, F.concat(F.lit('{"a":2,"b":"t","c":{"y":"'), c("p_type"), F.lit('","x":1.5},"e":null}'))
    ).otherwise(F.lit('{"d":[1,2],"b":true}'))
    rows = t.part.select(body.alias("j"))
    schema = json.infer_schema(rows, "j")
    fields = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema)
    return json.parse_column(rows, "j", schema).agg(F.lit(fields).alias("fields"), F.count("*").alias("n"))


@query("src06_json_column_to_rows", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def _(t):
    return json.parse_column(t.events.select("event_id", "props"), "props", T.StructType.fromDDL("k long"))


@query("src07_create_parquet_table", "SELECT r_regionkey, r_name FROM region")
def _(t):
    name, path = _table(t, "created", "r_regionkey INT, r_name STRING")
    assert t.spark.table(name).isEmpty()
    t.region.write.insertInto(name)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


@query("src08_save_parquet", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0")
def _(t):
    path = fresh_dir(t.spark, "saved")
    t.customer.where("c_acctbal > 0").select("c_custkey", "c_mktsegment").write.mode("errorifexists").parquet(path)
    return t.spark.read.parquet(path)


@query("src09_temp_view", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    t.customer.createOrReplaceTempView("tw_clients")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS n FROM tw_clients GROUP BY c_mktsegment")


@query("src10_insert_into", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 5000")
def _(t):
    name, path = _table(t, "inserted", "s_suppkey BIGINT, s_acctbal DOUBLE")
    pick = t.supplier.select("s_suppkey", "s_acctbal")
    pick.where("s_acctbal <= 0").write.insertInto(name)
    pick.where("s_acctbal > 0").write.insertInto(name, overwrite=True)
    pick.where("s_acctbal > 5000").write.insertInto(name)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


@query("src11_save_as_table", "SELECT n_name, n_regionkey FROM nation WHERE n_regionkey < 3")
def _(t):
    name, path = f"tw_saved_{uuid.uuid4().hex[:8]}", fresh_dir(t.spark, "table")
    t.nation.where("n_regionkey < 3").select("n_name", "n_regionkey").write.option("path", path).saveAsTable(name)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


@query("src12_sql_insert", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 300000")
def _(t):
    name, path = _table(t, "sqlinsert", "o_orderkey BIGINT")
    s = t.views("orders")
    s.sql(f"INSERT OVERWRITE TABLE {name} SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
    s.sql(f"INSERT INTO {name} SELECT o_orderkey FROM orders WHERE o_totalprice > 300000")
    s.sql(f"DROP TABLE {name}")
    return s.read.parquet(path)


@query("src13_create_table_as_select", "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1")
def _(t):
    name, path = f"tw_ctas_{uuid.uuid4().hex[:8]}", fresh_dir(t.spark, "ctas")
    t.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey", "orders")
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


@query("src14_insert_static_partition", "SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus IN ('F', 'P')")
def _(t):
    name, _path = _table(t, "parted", "o_orderkey BIGINT, status STRING", "status")
    s = t.views("orders")
    for status in ("F", "P"):
        s.sql(f"INSERT INTO {name} PARTITION (status = '{status}') SELECT o_orderkey FROM orders WHERE o_orderstatus = '{status}'")
    return s.table(name)


@query("src15_multi_insert", "SELECT p_partkey, 'small' AS target FROM part WHERE p_size < 10 UNION ALL SELECT p_partkey, 'dear' FROM part WHERE p_retailprice > 950")
def _(t):
    small, small_path = _table(t, "small", "p_partkey BIGINT, target STRING")
    dear, dear_path = _table(t, "dear", "p_partkey BIGINT, target STRING")
    s = t.views("part")
    s.sql(f"FROM part INSERT INTO {small} SELECT p_partkey, 'small' WHERE p_size < 10 INSERT INTO {dear} SELECT p_partkey, 'dear' WHERE p_retailprice > 950")
    s.sql(f"DROP TABLE {small}")
    s.sql(f"DROP TABLE {dear}")
    return s.read.parquet(small_path).union(s.read.parquet(dear_path))


@query("src16_partition_pruned_scan", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag = 'N' AND l_quantity < 3")
def _(t):
    path = fresh_dir(t.spark, "by-flag")
    t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    return t.spark.read.parquet(path).where("l_returnflag = 'N' AND l_quantity < 3")


@query("src17_table_lookup", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    return t.views("nation").table("nation").select("n_nationkey", "n_name")


@query("src18_apply_schema", "SELECT c_custkey AS id, c_name AS label, c_acctbal AS amount FROM customer")
def _(t):
    # Untyped text columns take the schema by cast and by position.
    schema = T.StructType.fromDDL("id long, label string, amount double")
    untyped = t.customer.select(*[c(x).cast("string") for x in ("c_custkey", "c_name", "c_acctbal")])
    return untyped.select(*[c(u).cast(f.dataType).alias(f.name) for u, f in zip(untyped.columns, schema)])


@query("src19_rows_from_objects", "SELECT n_nationkey, n_name, CASE n_regionkey WHEN 0 THEN 'south' WHEN 2 THEN 'east' END AS side FROM nation")
def _(t):
    sides = t.spark.createDataFrame([Row(n_regionkey=0, side="south"), Row(n_regionkey=2, side="east")])
    return t.nation.join(F.broadcast(sides), "n_regionkey", "left").select("n_nationkey", "n_name", "side")


@query("src20_infer_from_first_row", "SELECT s_suppkey AS k, s_name AS name FROM supplier")
def _(t):
    # The schema comes from one row; the data itself never leaves the executors.
    first = t.supplier.select(c("s_suppkey").alias("k"), c("s_name").alias("name")).head(1)
    schema = t.spark.createDataFrame([Row(**first[0].asDict())]).schema
    return t.supplier.toDF("k", "name", "s_nationkey", "s_acctbal").select("k", "name").to(schema)


def _text_lines(t, df, label, **options) -> str:
    path = fresh_dir(t.spark, label)
    df.write.options(**options).text(path)
    return path


@query("src21_text_file", "SELECT o_orderkey::VARCHAR || '|' || o_orderstatus AS line FROM orders")
def _(t):
    path = _text_lines(t, t.orders.select(F.concat_ws("|", c("o_orderkey").cast("string"), "o_orderstatus")), "lines")
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query("src22_whole_text_files", "SELECT text, true AS named FROM benchmark")
def _(t):
    path = _text_lines(t, t.benchmark.select("text"), "whole", maxRecordsPerFile=1)
    files = t.spark.read.text(path, wholetext=True).withColumn("name", F.input_file_name())
    return files.select(F.regexp_replace("value", "\n$", "").alias("text"), c("name").contains(path.rsplit("/", 1)[1]).alias("named"))


@query("src23_sequence_file", "SELECT c_custkey AS k, c_name AS v FROM customer")
def _(t):
    path = fresh_dir(t.spark, "sequence")
    t.customer.select("c_custkey", "c_name").rdd.map(tuple).saveAsSequenceFile(path)
    return t.spark.createDataFrame(t.spark.sparkContext.sequenceFile(path), "k long, v string")


@query("src24_object_file", "SELECT event_id, ts::VARCHAR AS ts, user_id, event_type, value, props FROM events")
def _(t):
    path = fresh_dir(t.spark, "objects")
    t.events.withColumn("props", F.from_json("props", "k long")).write.parquet(path)
    back = t.spark.read.parquet(path)
    return back.withColumn("ts", F.regexp_replace(c("ts").cast("string"), r"(\.\d*?)0+$", "$1")).withColumn("props", F.format_string('{"k": %d}', "props.k"))


@query("src25_save_text_compressed", "SELECT p_name AS line FROM part")
def _(t):
    return t.spark.read.text(_text_lines(t, t.part.select("p_name"), "gz", compression="gzip")).withColumnRenamed("value", "line")


@query("src26_save_sequence_file", "SELECT s_suppkey AS k, s_acctbal AS v FROM supplier")
def _(t):
    path = fresh_dir(t.spark, "sequence-out")
    t.supplier.select("s_suppkey", "s_acctbal").rdd.map(tuple).saveAsSequenceFile(path, "org.apache.hadoop.io.compress.DefaultCodec")
    return t.spark.createDataFrame(t.spark.sparkContext.sequenceFile(path), "k long, v double")


@query(
    "src27_database_range_split",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) + 1 AS len FROM orders),
            p AS (SELECT i::INTEGER AS part, lo + i * len // 7 AS a, lo + (i + 1) * len // 7 - 1 AS z FROM range(7) r(i), b)
       SELECT part, count(*) AS n, min(o_orderkey) AS first_key FROM p JOIN orders ON o_orderkey BETWEEN a AND z GROUP BY 1""",
)
def _(t):
    # Each range is the predicate one database query would carry; here the Parquet scan answers it.
    lo, hi = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).head()
    pieces = ranges.range_predicates("o_orderkey", lo, hi, 7)
    part = F.coalesce(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(pieces)])
    return t.orders.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")).where("part IS NOT NULL")


@query("src28_local_rows", "SELECT o_orderstatus, count(*) AS n, max(w) AS weight FROM orders JOIN (VALUES ('F', 1.5::DOUBLE), ('O', 2.0), ('P', 0.5)) x(s, w) ON s = o_orderstatus GROUP BY 1")
def _(t):
    weights = t.spark.createDataFrame([("F", 1.5), ("O", 2.0), ("P", 0.5)], "o_orderstatus string, weight double")
    return t.orders.join(F.broadcast(weights), "o_orderstatus").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("weight").alias("weight"))


@query("src29_empty_dataset", "SELECT r_regionkey, r_name FROM region")
def _(t):
    return t.spark.createDataFrame([], t.region.schema).unionByName(t.region)


_DIRTY = """SELECT p_partkey AS id, CASE WHEN p_size % 7 IN (0, 1, 2) THEN NULL ELSE p_size END AS size,
                   CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS price,
                   CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag FROM part"""


@query("src30_csv_with_missing_values", _DIRTY)
def _(t):
    size, key = c("p_size"), c("p_partkey")
    raw = t.part.select(
        key.alias("id"),
        F.when(size % 7 == 0, "NA").when(size % 7 == 1, " n/a ").when(size % 7 == 2, "x9").otherwise(size.cast("string")).alias("size"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit(" "), c("p_retailprice").cast("string"))).alias("price"),
        F.when(size % 3 == 0, "Yes").when(size % 3 == 1, "FALSE").otherwise("maybe").alias("flag"),
    )
    path = fresh_dir(t.spark, "dirty-csv")
    raw.write.option("header", True).csv(path)
    return text.read_csv_with_na(t.spark, path, T.StructType.fromDDL("id long, size int, price double, flag boolean"))


@query("src31_headered_csv", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 7")
def _(t):
    path = fresh_dir(t.spark, "csv")
    t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").write.option("header", True).csv(path)
    t.spark.read.csv(path, header=True, inferSchema=True).createOrReplaceTempView("tw_csv_customers")
    return t.spark.sql("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_acctbal, c_mktsegment FROM tw_csv_customers WHERE c_nationkey = 7")


@query("src32_table_to_frame", "SELECT p_size::DOUBLE AS p_size, CASE WHEN p_size % 4 = 0 THEN 'nan'::DOUBLE ELSE p_retailprice END AS price FROM part")
def _(t):
    return frames.table_to_frame(t.part.select("p_size", F.when(c("p_size") % 4 != 0, c("p_retailprice")).alias("price")))


@query("src33_rows_to_frame", "SELECT p_partkey::DOUBLE AS p_partkey, (p_size > 25)::INTEGER::DOUBLE AS big, 'nan'::DOUBLE AS p_name FROM part")
def _(t):
    return frames.rows_to_frame(t.part.select("p_partkey", (c("p_size") > 25).alias("big"), "p_name"))


@query("src34_frame_to_rows", "SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_size END AS size FROM part")
def _(t):
    frame = frames.rows_to_frame(t.part.select("p_partkey", F.when(c("p_size") % 4 != 0, c("p_size")).alias("size"), "p_retailprice"))
    return frames.frame_to_rows(frame, T.StructType.fromDDL("p_partkey long, size int"))


def _vectors(t):
    return t.embeddings.select(c("label").cast("double").alias("label"), array_to_vector(c("embedding").cast("array<double>")).alias("features"))


_VECTOR_SUMS = "SELECT label::DOUBLE AS label, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 9) AS total, len(embedding)::INTEGER AS dims FROM embeddings"


def _vector_sums(df):
    values = c("values")
    return df.select("label", vector_to_array("features").alias("values")).select(
        "label", F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.size(values).alias("dims")
    )


def _libsvm(t) -> str:
    path = fresh_dir(t.spark, "libsvm")
    _vectors(t).write.format("libsvm").save(path)
    return path


@query("src35_load_libsvm", _VECTOR_SUMS)
def _(t):
    dims = t.embeddings.agg(F.max(F.size("embedding"))).head()[0]
    return _vector_sums(t.spark.read.format("libsvm").option("numFeatures", dims).load(_libsvm(t)))


@query("src36_save_libsvm", "SELECT label::VARCHAR || '.0' AS label, (len(list_filter(embedding, lambda x: x <> 0)) + 1)::INTEGER AS fields FROM embeddings")
def _(t):
    line = F.split(F.trim("value"), " ")
    return t.spark.read.text(_libsvm(t)).select(line[0].alias("label"), F.size(line).alias("fields"))


@query("src37_load_vectors", "SELECT round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 9) AS total FROM embeddings")
def _(t):
    path = _text_lines(t, t.embeddings.select(F.to_json(c("embedding").cast("array<double>")).alias("value")), "vectors")
    return text.read_vectors(t.spark, path).select(F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 9).alias("total"))


@query("src37_load_labelled_vectors", _VECTOR_SUMS)
def _(t):
    rows = t.embeddings.select("label", c("embedding").cast("array<double>").alias("f"))
    path = _text_lines(t, text.labelled_lines(rows, "label", "f"), "labelled")
    return text.read_labelled_vectors(t.spark, path).select(
        "label", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 9).alias("total"), F.size("features").alias("dims")
    )


@query("src38_edge_list", "SELECT least(o_custkey, o_orderkey % 100) AS src, greatest(o_custkey, o_orderkey % 100) AS dst FROM orders")
def _(t):
    lines = t.orders.select(F.concat_ws(" ", c("o_custkey").cast("string"), (c("o_orderkey") % 100).cast("string")))
    comments = t.region.select(F.concat(F.lit("# "), "r_name"))
    return text.read_edge_list(t.spark, _text_lines(t, lines.union(comments), "edges"), canonical=True)


@query("src39_delimited_text", "SELECT p_partkey AS id, p_brand AS brand, p_size AS size, len(string_split(p_name, ' '))::INTEGER AS words FROM part")
def _(t):
    line = F.concat_ws("\t", c("p_partkey").cast("string"), F.regexp_replace("p_name", " ", ","), F.concat(F.lit("b:"), "p_brand", F.lit(",s:"), c("p_size").cast("string")))
    schema = T.StructType.fromDDL("id long, words array<string>, attrs map<string,string>")
    rows = text.read_delimited(t.spark, _text_lines(t, t.part.select(line), "tabs"), schema)
    return rows.select("id", c("attrs")["b"].alias("brand"), c("attrs")["s"].cast("int").alias("size"), F.size("words").alias("words"))


@query("src40_regex_text", "SELECT CASE WHEN n_nationkey % 5 <> 0 THEN n_nationkey::VARCHAR END AS k, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS v FROM nation")
def _(t):
    line = F.when(c("n_nationkey") % 5 == 0, F.lit("?? unreadable")).otherwise(F.concat(c("n_nationkey").cast("string"), F.lit("="), "n_name"))
    return text.read_regex(t.spark, _text_lines(t, t.nation.select(line), "regex"), r"^(\d+)=(\w+)$", ["k", "v"])


# ---- user functions ------------------------------------------------------


@query("udf01_register_vectorised", "SELECT c_custkey, c_acctbal * 2 + 1 AS v FROM customer")
def _(t):
    @F.pandas_udf("double")
    def tw_double_plus_one(x: pd.Series) -> pd.Series:
        return x * 2 + 1

    t.spark.udf.register("tw_double_plus_one", tw_double_plus_one)
    return t.sql("SELECT c_custkey, tw_double_plus_one(c_acctbal) AS v FROM customer", "customer")


@query("udf02_register_with_type", "SELECT p_partkey, p_size + length(p_name)::INTEGER AS v FROM part")
def _(t):
    @F.pandas_udf(T.IntegerType())
    def tw_weight(size: pd.Series, name: pd.Series) -> pd.Series:
        return size + name.str.len()

    t.spark.udf.register("tw_weight", tw_weight)
    return t.sql("SELECT p_partkey, tw_weight(p_size, p_name) AS v FROM part", "part")


@query("udf03_register_lambda", "SELECT n_nationkey, lower(n_name) AS v FROM nation")
def _(t):
    t.spark.udf.register("tw_lower", F.udf(lambda s: s.lower(), useArrow=True))  # text by default
    return t.sql("SELECT n_nationkey, tw_lower(n_name) AS v FROM nation", "nation")


@query("udf04_simple_class", "SELECT s_suppkey, s_nationkey * 10 AS v FROM supplier")
def _(t):
    class TimesTen:
        def evaluate(self, x):
            return x * 10

    t.spark.udf.register("tw_times_ten", F.udf(TimesTen().evaluate, "int", useArrow=True))
    return t.sql("SELECT s_suppkey, tw_times_ten(s_nationkey) AS v FROM supplier", "supplier")


@query("udf05_typed_by_input", "SELECT o_orderkey, o_orderstatus || '/' || substring(o_orderpriority, 1, 1) AS v FROM orders")
def _(t):
    @F.pandas_udf("string")
    def join_parts(row: pd.DataFrame) -> pd.Series:
        return row["a"] + "/" + row["b"].str[:1]

    return t.orders.select("o_orderkey", join_parts(F.struct(c("o_orderstatus").alias("a"), c("o_orderpriority").alias("b"))).alias("v"))


@query("udf06_user_aggregate", "SELECT l_suppkey, round(sum(l_quantity * l_quantity), 4) AS result FROM lineitem GROUP BY 1")
def _(t):
    squares = UserAggregate(lambda: 0.0, lambda s, v: s + v * v, lambda a, b: a + b, "double", lambda s: F.round(s, 4))
    return squares.by_key(t.lineitem, "l_suppkey", "l_quantity")


@query("udf07_user_table_function", "SELECT p_partkey, unnest(range(1, p_size % 4 + 1))::INTEGER AS step, p_size * unnest(range(1, p_size % 4 + 1))::INTEGER AS v FROM part")
def _(t):
    @F.udtf(returnType="step int, v int")
    class Steps:
        def eval(self, size: int):
            for i in range(1, size % 4 + 1):
                yield i, size * i

    t.spark.udtf.register("tw_steps", Steps)
    return t.sql("SELECT p_partkey, step, v FROM part, LATERAL tw_steps(p_size)", "part")


@query("udf08_temporary_function", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def _(t):
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tw_net(price DOUBLE, off DOUBLE) RETURNS DOUBLE RETURN price * (1 - off)")
    return t.sql("SELECT l_orderkey, l_linenumber, tw_net(l_extendedprice, l_discount) AS net FROM lineitem", "lineitem")


@query(
    "cmd01_table_statistics",
    " UNION ALL ".join(
        f"SELECT '{x}' AS column_name, count(*) AS n, count(*) - count({x}) AS nulls, min({x})::VARCHAR AS low, max({x})::VARCHAR AS high FROM lineitem"
        for x in ("l_orderkey", "l_suppkey", "l_returnflag")
    ),
)
def _(t):
    stats = legacy.compute_stats(t.lineitem, ["l_orderkey", "l_suppkey", "l_returnflag"])
    return stats.select("column_name", "n", "nulls", "low", "high")
