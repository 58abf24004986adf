"""Queries over tables: one for each operator of the engine, with the SQL an independent engine runs for it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafspark.functions import geometry as geo
from leafspark.functions import raster, stats
from leafspark.operators import fields, sequences, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


ROBUST = """
WITH r AS ({rows}), m AS (SELECT k, median(v) med, count(*) n FROM r GROUP BY k),
d AS (SELECT r.k, any_value(med) med, any_value(n) n, median(abs(v - med)) mad FROM r JOIN m USING (k) GROUP BY r.k)
SELECT r.k AS {name}, round(CASE WHEN any_value(n) <= 2 OR any_value(mad) < 1e-9 THEN any_value(med)
  ELSE median(v) FILTER (abs(v - med) <= 2 * mad) END, 6) AS robust, any_value(n) AS n
FROM r JOIN d USING (k) GROUP BY r.k"""


@query(ROBUST.format(rows="SELECT l_returnflag k, l_extendedprice v FROM lineitem", name="l_returnflag"))
def robust_median_price(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.robust_median(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", "robust")
    return out.withColumn("robust", F.round("robust", 6))


@query(f"""
WITH q AS ({ROBUST.format(rows="SELECT c_mktsegment k, abs(c_acctbal) / 10000 v FROM customer", name="c_mktsegment")})
SELECT c_mktsegment, robust AS score, CASE WHEN robust < 0.1 THEN 'none' WHEN robust < 0.3 THEN 'mild'
  WHEN robust < 0.6 THEN 'moderate' ELSE 'severe' END AS severity FROM q""")
def severity_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    scored = table(spark, sf, "customer").withColumn("score", F.abs("c_acctbal") / 10000)
    out = stats.robust_median(scored, ["c_mktsegment"], "score", "score").withColumn("score", F.round("score", 6))
    return out.select("c_mktsegment", "score", stats.severity(F.col("score")).alias("severity"))


@query("""SELECT o_orderpriority, CASE WHEN d < 5 THEN 'none' WHEN d < 15 THEN 'slight_warm' ELSE 'strong_warm' END AS cast_label,
count(*) AS n FROM (SELECT o_orderpriority, floor(o_totalprice) % 30 AS d FROM orders) GROUP BY ALL""")
def color_cast_label(spark: SparkSession, sf: str) -> DataFrame:
    d = F.floor("o_totalprice") % 30
    return table(spark, sf, "orders").groupBy("o_orderpriority", stats.color_cast(d).alias("cast_label")).agg(F.count("*").alias("n"))


@query("""SELECT year(l_shipdate) AS y, 2 * count(*) FILTER (l_returnflag = 'R') > count(*) AS most_returned,
100 * count(*) FILTER (l_linestatus = 'O') >= 30 * count(*) AS third_open FROM lineitem GROUP BY 1""")
def majority_vote(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").cast("long").alias("y")).agg(
        stats.majority(F.col("l_returnflag") == "R").alias("most_returned"),
        stats.voted(F.col("l_linestatus") == "O", 30).alias("third_open"),
    )


@query("""SELECT c_nationkey, count(*) AS total, CASE WHEN count(*) <= 0 THEN 0 ELSE
least(count(*), greatest(10, least(30, count(*) // 10))) END::BIGINT AS n FROM customer GROUP BY 1""")
def sample_size(spark: SparkSession, sf: str) -> DataFrame:
    n = F.count("*")
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(n.alias("total"), stats.sample_size(n).alias("n"))


@query("""
WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS pos FROM orders),
s AS (SELECT o_orderstatus, count(*) total, least(count(*), greatest(10, least(30, count(*) // 10))) n FROM orders GROUP BY 1),
i AS (SELECT DISTINCT o_orderstatus, CASE WHEN n = 1 THEN 0 ELSE i * (total - 1) // (n - 1) END AS pos FROM s, range(0, 30) t(i) WHERE i < n)
SELECT o_orderstatus, r.pos AS "at", o_orderkey FROM r JOIN i USING (o_orderstatus, pos)""")
def even_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey")
    return sequences.even_sample(rows, ["o_orderstatus"], ["o_orderkey"]).withColumn("at", F.col("at").cast("long"))


@query("""
WITH c AS (SELECT user_id, floor(value)::INT % 180 v, count(*) n FROM events GROUP BY ALL),
s AS (SELECT user_id, (v + d + 180) % 180 v, sum(n) s FROM c, range(-2, 3) t(d) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, v) rn FROM s)
SELECT user_id, v::INT AS peak, round(s::DOUBLE / 5, 6) AS height FROM r WHERE rn = 1""")
def circular_histogram_peak(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("hue", F.floor("value").cast("int") % 180)
    return stats.histogram_peak(rows, ["user_id"], "hue", 180)


@query("""
WITH v AS (SELECT DISTINCT user_id, floor(value) % 180 AS v FROM events),
g AS (SELECT user_id, v, v - lag(v) OVER (PARTITION BY user_id ORDER BY v) AS gap FROM v)
SELECT user_id, round(180 - greatest(coalesce(max(gap), 0), 180 - (max(v) - min(v))), 6) AS extent FROM g GROUP BY 1""")
def circular_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("hue", F.floor("value") % 180)
    return stats.circular_range(rows, ["user_id"], "hue", 180)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows as JSON records of mixed kinds."""
    k = F.get_json_object("props", "$.k").cast("long")
    fields_ = F.struct("event_type", "user_id", "value", k.alias("k"), (F.col("value") > 50).alias("high"))
    return table(spark, sf, "events").select("user_id", "event_type", F.to_json(fields_).alias("record"))


FLAT = """f AS (
SELECT 'event_type' AS key, 'string' AS kind, NULL::DOUBLE AS x FROM events UNION ALL
SELECT 'user_id', 'number', user_id FROM events UNION ALL SELECT 'value', 'number', value FROM events UNION ALL
SELECT 'k', 'number', (props->>'$.k')::DOUBLE FROM events UNION ALL SELECT 'high', 'bool', NULL FROM events)"""


@query(f"""WITH {FLAT} SELECT key, count(*) AS n, count(*) FILTER (kind = 'string') AS n_string, count(*) FILTER (kind = 'bool') AS n_bool,
count(*) FILTER (kind = 'number') AS n_number, round(min(x), 6) AS least, round(max(x), 6) AS greatest, round(avg(x), 6) AS mean FROM f GROUP BY key""")
def field_stats(spark: SparkSession, sf: str) -> DataFrame:
    return fields.field_stats(_records(spark, sf), "record")


@query(f"WITH {FLAT} SELECT key, any_value(kind) AS kind, count(*) AS n FROM f GROUP BY key")
def dominant_type(spark: SparkSession, sf: str) -> DataFrame:
    return fields.dominant_kind(_records(spark, sf), "record")


@query("""SELECT user_id, event_type, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type)::INT AS place
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)""")
def value_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return fields.value_distribution(table(spark, sf, "events"), ["user_id"], "event_type")


@query("""
WITH a AS (SELECT user_id, count(*) n, count(*) FILTER (event_type = 'error') e, count(DISTINCT event_type) t,
  count(*) FILTER (value < 5) low, max(value) top, avg(value) mean FROM events GROUP BY 1)
SELECT user_id, 'errors' AS warning FROM a WHERE e > 0 UNION ALL
SELECT user_id, 'blurry' FROM a WHERE 100 * low > 10 * n UNION ALL SELECT user_id, 'several_types' FROM a WHERE t > 4 UNION ALL
SELECT user_id, 'narrow' FROM a WHERE top <= 200 UNION ALL SELECT user_id, 'skewed' FROM a WHERE mean > 20""")
def rule_warnings(spark: SparkSession, sf: str) -> DataFrame:
    n = F.count("*")
    rules = {
        "errors": F.count_if(F.col("event_type") == "error") > 0,
        "blurry": 100 * F.count_if(F.col("value") < 5) > 10 * n,
        "several_types": F.count_distinct("event_type") > 4,
        "narrow": F.max("value") <= 200,
        "skewed": F.avg("value") > 20,
    }
    return fields.warnings(table(spark, sf, "events"), ["user_id"], rules)


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'F') AS n_f,
count(*) FILTER (o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1""")
def stage_counters(spark: SparkSession, sf: str) -> DataFrame:
    return fields.outcome_counts(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", ["O", "F", "P"])


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def end_report(spark: SparkSession, sf: str) -> DataFrame:
    return tables.rolled_up(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice")


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS bytes, sum(n_chars) * 3 > 1000000 AS too_large FROM documents GROUP BY 1")
def size_budget(spark: SparkSession, sf: str) -> DataFrame:
    return tables.disk_budget(table(spark, sf, "documents"), ["lang"], "n_chars", 3, F.lit(1_000_000))


@query("""
WITH l AS (SELECT *, lag(ts) OVER w p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(CASE WHEN epoch_us(ts) - epoch_us(p) <= 1800000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) g FROM l)
SELECT user_id, g::BIGINT AS group_no, count(*) AS n, min(event_id) AS first_event FROM g GROUP BY ALL""")
def consecutive_groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("user_id", "event_id", _seconds("ts").alias("at"))
    near = F.col("at") - F.col("lag_at") <= 1_800_000_000
    out = sequences.neighbour_groups(rows, ["user_id"], ["at", "event_id"], near)
    return out.groupBy("user_id", "group_no").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN 'manual-' || conv_id % 7 ELSE conv_id::VARCHAR END AS group_id FROM conversations""")
def manual_group_override(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    name = F.concat(F.lit("manual-"), F.col("conv_id") % 7)
    manual = rows.select("conv_id").distinct().filter("conv_id % 3 = 0").withColumn("manual_group", name)
    return sequences.with_manual_groups(rows, "conv_id", "group_id", manual)


@query("""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] v FROM embeddings), d AS (
SELECT a.vec_id, b.vec_id other, round(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) d
FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, other) rn, lead(d) OVER (PARTITION BY vec_id ORDER BY d, other) d2 FROM d)
SELECT vec_id, other AS nearest, d, d2, d < 0.75 * d2 AS matched FROM r WHERE rn = 1""")
def two_nearest_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Two nearest of one's own label, with the ratio test; the queries are the ids divisible by 100."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    return tables.nearest_two(e.filter("vec_id % 100 = 0"), e, "label", "vec_id", "v", 0.75)


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def retake_dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Least id of each text; texts meet by their hash, so none is shuffled."""
    key = F.sha2(F.encode("text", "utf-8"), 256).alias("h")
    return table(spark, sf, "documents").groupBy(key).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("h")


@query()
def retake_dedup_greedy(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of one label among each 100 ids, as shots of a group: which stay where a cosine of 0.2 is a retake.

    Sharpness is the number of positive values. A group has at most 100 rows.
    """
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.floor(F.col("vec_id") / 100).alias("part"), F.col("embedding").cast("array<double>").alias("v"))

    def retakes(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("vec_id")
        v = np.stack(g["v"])
        norm = np.linalg.norm(v, axis=1)
        keep = sequences.without_retakes((v > 0).sum(axis=1), lambda i, j: v[i] @ v[j] >= 0.2 * norm[i] * norm[j])
        return g.assign(kept=keep)[["label", "part", "vec_id", "kept"]]

    kind = e.schema["label"].dataType.simpleString()
    return e.groupBy("label", "part").applyInPandas(retakes, f"label {kind}, part long, vec_id long, kept boolean")


@query("""SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) rn
FROM documents) WHERE rn = 1""")
def best_of_group(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.best_of(table(spark, sf, "documents"), ["source"], "n_chars", "doc_id")


@query("""SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""")
def outer_grid(spark: SparkSession, sf: str) -> DataFrame:
    return tables.grid(table(spark, sf, "events"), "user_id", "event_type", ["click", "error", "view"])


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def image_sidecar_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return tables.with_records(docs, table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    return tables.without(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").filter("quality = 1"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_semi(spark: SparkSession, sf: str) -> DataFrame:
    return tables.within(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").filter("quality = 1"), "doc_id")


@query("""SELECT o_custkey, o_orderkey, max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) OVER
(PARTITION BY o_custkey ORDER BY o_orderkey) = 1 AS stale FROM orders""")
def invalidate_downstream(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    out = sequences.stale_from_change(rows, ["o_custkey"], "o_orderkey", F.col("o_orderstatus") == "P")
    return out.drop("o_orderstatus")


@query("""SELECT o_orderkey, substr(sha256('custkey=' || o_custkey || '|priority=' || o_orderpriority || '|status=' || o_orderstatus), 1, 16)
AS hash FROM orders""")
def config_hash(spark: SparkSession, sf: str) -> DataFrame:
    made = fields.settings_hash({"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"), "custkey": F.col("o_custkey")})
    return table(spark, sf, "orders").select("o_orderkey", made.alias("hash"))


@query("""
WITH b AS (SELECT o_orderkey, max(l_shipdate) s FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate <= o_orderdate + INTERVAL 60 DAY GROUP BY 1)
SELECT o_orderkey, epoch_us(b.s) // 1000000 AS shipped, (SELECT max(l_partkey) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate = b.s) AS part
FROM orders o LEFT JOIN b USING (o_orderkey)""")
def previous_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """The last line of an order that shipped within 60 days."""
    left = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("until"))
    right = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_partkey")
    out = sequences.latest_before(left, right, "o_orderkey", "until", "l_shipdate", "l_partkey")
    shipped = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("shipped")
    return out.select("o_orderkey", shipped, F.col("l_partkey").alias("part"))


@query("""
WITH r AS (SELECT l_suppkey, l_extendedprice p, l_quantity w FROM lineitem),
l AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY l_suppkey ORDER BY p, w) <= 200 THEN 0 ELSE 1 END f FROM r),
c AS (SELECT *, sum(f) OVER (PARTITION BY l_suppkey ORDER BY p, w ROWS UNBOUNDED PRECEDING) c FROM l)
SELECT l_suppkey, c::BIGINT AS cluster, count(*) AS n, round(sum(w), 2) AS weight, round(sum(p * w), 2) AS moment
FROM c GROUP BY ALL HAVING sum(w) >= 30""")
def gap_cluster_borders(spark: SparkSession, sf: str) -> DataFrame:
    out = sequences.gap_clusters(table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice", "l_quantity"), ["l_suppkey"], "l_extendedprice", "l_quantity", 200)
    return out.filter("weight >= 30").select("l_suppkey", "cluster", "n", F.round("weight", 2).alias("weight"), F.round(F.col("position") * F.col("weight"), 2).alias("moment"))


@query("""
WITH RECURSIVE v AS (SELECT l_orderkey, l_quantity::DOUBLE q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) i FROM lineitem),
r AS (SELECT l_orderkey, i, 0 AS c, 1 AS n, q AS total FROM v WHERE i = 1 UNION ALL
SELECT v.l_orderkey, v.i, CASE WHEN abs(v.q - r.total / r.n) <= 5 THEN r.c ELSE r.c + 1 END,
CASE WHEN abs(v.q - r.total / r.n) <= 5 THEN r.n + 1 ELSE 1 END, CASE WHEN abs(v.q - r.total / r.n) <= 5 THEN r.total + v.q ELSE v.q END
FROM r JOIN v ON v.l_orderkey = r.l_orderkey AND v.i = r.i + 1)
SELECT l_orderkey, c::INT AS cluster, max(n)::INT AS n, round(max_by(total, n) / max(n), 6) AS mean FROM r GROUP BY l_orderkey, c""")
def running_mean_cluster(spark: SparkSession, sf: str) -> DataFrame:
    values = F.array_sort(F.collect_list("l_quantity"))
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(values.alias("v"))
    out = rows.select("l_orderkey", F.posexplode(sequences.running_mean_clusters(F.col("v"), 5.0)).alias("cluster", "c"))
    return out.select("l_orderkey", "cluster", F.col("c.n").alias("n"), F.round(F.col("c.total") / F.col("c.n"), 6).alias("mean"))


@query("""SELECT page_id, regexp_replace(url, '[.][^./]*$', '') AS stem FROM pages WHERE page_id NOT IN
(SELECT item_id * 3 FROM benchmark) AND url NOT LIKE '%page=2%'""")
def exclude_list(spark: SparkSession, sf: str) -> DataFrame:
    gone = table(spark, sf, "benchmark").select((F.col("item_id") * 3).alias("page_id"))
    rows = table(spark, sf, "pages").filter(~F.col("url").contains("page=2")).select("page_id", tables.stem(F.col("url")).alias("stem"))
    return tables.without(rows, gone, "page_id")


@query("""SELECT p.page_id FROM pages p WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.page_id)
AND NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.item_id = p.page_id)""")
def not_in_either(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id")
    known = tables.without(pages, table(spark, sf, "labels").select(F.col("doc_id").alias("page_id")), "page_id")
    return tables.without(known, table(spark, sf, "benchmark").select(F.col("item_id").alias("page_id")), "page_id")


GRAY = "least(255, greatest(0, floor(v::DOUBLE * 256 + 128)))"


def _gray(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as 8 x 8 rasters of gray values."""
    scale = lambda v: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(v.cast("double") * 256 + 128))).cast("double")
    return table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", scale).alias("g"))


@query(f"""
WITH p AS (SELECT vec_id, label, {GRAY} g FROM (SELECT vec_id, label, unnest(embedding) v FROM embeddings)),
m AS (SELECT vec_id, any_value(label) label, avg(g) mean, stddev_pop(g) sd FROM p GROUP BY 1)
SELECT vec_id, CASE WHEN label >= 4 THEN 'music' WHEN sd < 15 AND mean > 200 THEN 'blank' WHEN sd < 20 THEN 'other' ELSE 'text' END AS page_type,
round(mean, 4) AS mean FROM m""")
def classify_page(spark: SparkSession, sf: str) -> DataFrame:
    px = _gray(spark, sf).select("vec_id", "label", F.explode("g").alias("v"))
    m = px.groupBy("vec_id").agg(F.first("label").alias("label"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"))
    return m.select("vec_id", raster.page_class(F.col("mean"), F.col("sd"), F.col("label")).alias("page_type"), F.round("mean", 4).alias("mean"))


@query("""SELECT row_number() OVER (ORDER BY part, id) AS place, part, id FROM (
SELECT 0 AS part, o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 1, event_id FROM events WHERE event_type = 'error')""")
def ordered_union(spark: SparkSession, sf: str) -> DataFrame:
    """Pages, then annex, numbered."""
    book = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    annex = table(spark, sf, "events").filter("event_type = 'error'").select(F.col("event_id").alias("id"))
    return tables.in_order([book, annex], "id")


@query("SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_except(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))
    return tables.without(table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).distinct(), s, "nation")


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))
    return tables.within(table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).distinct(), s, "nation")


@query("SELECT DISTINCT o_orderkey % 3 AS spec, n::INT AS n FROM orders, range(0, 9) t(n) WHERE CASE o_orderkey % 3 WHEN 0 THEN n IN (0, 2, 3, 4) WHEN 1 THEN n = 7 ELSE n BETWEEN 1 AND 3 OR n = 8 END")
def stage_spec_expand(spark: SparkSession, sf: str) -> DataFrame:
    spec = F.element_at(F.array(F.lit("0,2-4"), F.lit("7"), F.lit("8,1-3,2")), (F.col("spec") + 1).cast("int"))
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") % 3).alias("spec")).distinct()
    return rows.select("spec", F.explode(tables.expanded_ranges(spec)).alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 1.5 WHEN c_nationkey % 2 = 0 THEN 3.0 ELSE 5.0 END::DOUBLE AS max_angle,
c_custkey % 5 = 0 AS overridden FROM customer""")
def config_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Given options over file over defaults, key by key, as maps."""
    given = F.when(F.col("c_custkey") % 5 == 0, F.create_map(F.lit("max_angle"), F.lit(1.5)))
    file = F.when(F.col("c_nationkey") % 2 == 0, F.create_map(F.lit("max_angle"), F.lit(3.0)))
    made = tables.layered("max_angle", F.lit(5.0), given, file)
    return table(spark, sf, "customer").select("c_custkey", made.alias("max_angle"), given.isNotNull().alias("overridden"))


#: A quadrilateral of each order, from its numbers: four corners of a page of 600 x 800, off by up to 40.
OFFSETS = ((7, 3), (11, 5), (13, 17), (19, 23))
PLACES = ((60, 80), (540, 80), (540, 720), (60, 720))


def _quads(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    points = [geo.point(x + (k * a) % 41, y + (k * b) % 41) for (x, y), (a, b) in zip(PLACES, OFFSETS)]
    shuffled = F.array(points[2], points[0], points[3], points[1])
    return table(spark, sf, "orders").select("o_orderkey", shuffled.alias("points")).withColumn("quad", geo.order_corners(F.col("points")))


_XY = ", ".join(f"({x} + (o_orderkey * {a}) % 41)::DOUBLE x{i}, ({y} + (o_orderkey * {b}) % 41)::DOUBLE y{i}" for i, ((x, y), (a, b)) in enumerate(zip(PLACES, OFFSETS)))
QUAD_SQL = f"q AS (SELECT o_orderkey, {_XY} FROM orders)"
_EDGE = "sqrt((x{a} - x{b}) * (x{a} - x{b}) + (y{a} - y{b}) * (y{a} - y{b}))"
_E = {(a, b): _EDGE.format(a=a, b=b) for a, b in ((0, 1), (1, 2), (3, 2), (0, 3))}
_ANG = {(a, b): f"degrees(atan2(y{b} - y{a}, x{b} - x{a}))" for a, b in ((0, 1), (3, 2))}
_AREA = "abs(x0 * y1 - x1 * y0 + x1 * y2 - x2 * y1 + x2 * y3 - x3 * y2 + x3 * y0 - x0 * y3) / 2"
_SKEW = f"greatest(abs({_ANG[0, 1]}), abs({_ANG[3, 2]}))"
W, H = 600, 800


@query(f"WITH {QUAD_SQL} SELECT o_orderkey, x0 AS tl_x, y0 AS tl_y, x1 AS tr_x, y1 AS tr_y, x2 AS br_x, y2 AS br_y, x3 AS bl_x, y3 AS bl_y FROM q")
def order_corners(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda i, c: F.get("quad", F.lit(i))[c]
    return _quads(spark, sf).select("o_orderkey", *[at(i, c).alias(f"{n}_{c}") for i, n in enumerate(geo.CORNERS) for c in "xy"])


@query(f"""WITH {QUAD_SQL} SELECT o_orderkey, round({_AREA}, 4) AS area, round({_SKEW}, 6) AS skew,
round(({_ANG[0, 1]} + {_ANG[3, 2]}) / 2, 6) AS tilt, round_even(greatest({_E[0, 1]}, {_E[3, 2]}), 0)::BIGINT AS width,
round_even(greatest({_E[0, 3]}, {_E[1, 2]}), 0)::BIGINT AS height, round(greatest(0, 1 - ({_AREA}) / {W * H}), 6) AS crop FROM q""")
def quad_metrics(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("quad")
    w, h = geo.target_size(q)
    return _quads(spark, sf).select(
        "o_orderkey", F.round(geo.area(q), 4).alias("area"), F.round(geo.skew(q), 6).alias("skew"), F.round(geo.tilt(q), 6).alias("tilt"),
        w.alias("width"), h.alias("height"), F.round(geo.crop_ratio(q, F.lit(W), F.lit(H)), 6).alias("crop"),
    )


def _move(i: int, v: str, top: int) -> str:
    c = f"({v}0 + {v}1 + {v}2 + {v}3) / 4"
    r = f"sqrt((x{i} - (x0 + x1 + x2 + x3) / 4) ** 2 + (y{i} - (y0 + y1 + y2 + y3) / 4) ** 2)"
    mean = f"({_E[0, 1]} + {_E[1, 2]} + {_E[3, 2]} + {_E[0, 3]}) / 4"
    return f"greatest(0, least({top}, {v}{i} + ({v}{i} - {c}) / {r} * 0.05 * ({mean})))"


@query(f"WITH {QUAD_SQL} SELECT o_orderkey, round({_move(0, 'x', W)}, 4) AS tl_x, round({_move(0, 'y', H)}, 4) AS tl_y, round({_move(2, 'x', W)}, 4) AS br_x, round({_move(2, 'y', H)}, 4) AS br_y FROM q")
def expand_quad(spark: SparkSession, sf: str) -> DataFrame:
    out = _quads(spark, sf).withColumn("quad", geo.expand(F.col("quad"), F.lit(W), F.lit(H)))
    at = lambda i, c: F.round(F.get("quad", F.lit(i))[c], 4)
    return out.select("o_orderkey", *[at(i, c).alias(f"{n}_{c}") for i, n in ((0, "tl"), (2, "br")) for c in "xy"])


def _side(i: int) -> str:
    return f"CASE WHEN 110 - x{i} > {0.04 * W} THEN 110 - {0.02 * W} WHEN x{i} - 530 > {0.04 * W} THEN 530 + {0.02 * W} ELSE x{i} END"


@query(f"WITH {QUAD_SQL} SELECT o_orderkey, " + ", ".join(f"round({_side(i)}, 4) AS x{i}" for i in range(4)) + " FROM q")
def clip_quad(spark: SparkSession, sf: str) -> DataFrame:
    out = _quads(spark, sf).withColumn("quad", geo.clip_to_borders(F.col("quad"), F.lit(110.0), F.lit(530.0), F.lit(W)))
    return out.select("o_orderkey", *[F.round(F.get("quad", F.lit(i))["x"], 4).alias(f"x{i}") for i in range(4)])


@query(f"""WITH {QUAD_SQL}, b AS (SELECT *, least(x0, x3) a, greatest(x1, x2) b, least(y0, y1) c, greatest(y2, y3) d FROM q)
SELECT o_orderkey, greatest(0, floor(a) - floor(0.03 * (b - a)))::BIGINT AS x0, greatest(0, floor(c) - floor(0.03 * (d - c)))::BIGINT AS y0,
least({W}, ceil(b) + floor(0.03 * (b - a)))::BIGINT AS x1, least({H}, ceil(d) + floor(0.03 * (d - c)))::BIGINT AS y1 FROM b""")
def crop_box(spark: SparkSession, sf: str) -> DataFrame:
    return _quads(spark, sf).select("o_orderkey", geo.crop_box(F.col("quad"), F.lit(W), F.lit(H)).alias("b")).select("o_orderkey", "b.*")


@query(f"""WITH {QUAD_SQL} SELECT o_orderkey, CASE WHEN {_SKEW} > 5 THEN 'skew_too_large' WHEN 1 - ({_AREA}) / {W * H} > 0.3 THEN 'crop_too_large'
ELSE 'rest' END AS reason FROM q""")
def warp_decision(spark: SparkSession, sf: str) -> DataFrame:
    reason = geo.warp_reason(F.col("quad"), F.lit(W), F.lit(H), right=0)
    return _quads(spark, sf).select("o_orderkey", F.coalesce(reason, F.lit("rest")).alias("reason"))


LAPLACE = """
WITH p AS (SELECT vec_id, (generate_subscripts(embedding, 1) - 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
g AS (SELECT vec_id, i % 8 AS x, i // 8 AS y, v FROM p),
s AS (SELECT vec_id, x + dx AS x, y + dy AS y, v * w AS v FROM g, (VALUES (0, 0, -4), (1, 0, 1), (-1, 0, 1), (0, 1, 1), (0, -1, 1)) m(dx, dy, w)),
r AS (SELECT vec_id, x, y, sum(v) AS r FROM s WHERE x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6 GROUP BY ALL)
SELECT vec_id, round(var_pop(r), 6) AS focus FROM r GROUP BY 1"""


@query(LAPLACE)
def laplacian_focus(spark: SparkSession, sf: str) -> DataFrame:
    px = raster.pixels(table(spark, sf, "embeddings"), "vec_id", "embedding", 8)
    return raster.laplacian_focus(px, "vec_id", 8, 8).withColumn("focus", F.round("focus", 6))


@query(LAPLACE)
def laplacian_focus_array(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", F.round(raster.laplacian_variance(F.col("embedding"), 8, 8), 6).alias("focus"))


@query("""
WITH p AS (SELECT vec_id, (generate_subscripts(embedding, 1) - 1) // 8 AS y, unnest(embedding)::DOUBLE AS v FROM embeddings),
s AS (SELECT vec_id, y, sum(v) AS s FROM p GROUP BY ALL) SELECT vec_id, round(var_pop(s), 6) AS score FROM s GROUP BY 1""")
def row_profile_variance(spark: SparkSession, sf: str) -> DataFrame:
    px = raster.pixels(table(spark, sf, "embeddings"), "vec_id", "embedding", 8)
    return raster.profile_variance(px, "vec_id").withColumn("score", F.round("score", 6))


@query(f"""
WITH p AS (SELECT vec_id, {GRAY}::INT AS t FROM (SELECT vec_id, unnest(embedding) v FROM embeddings)),
h AS (SELECT vec_id, t, count(*) n FROM p GROUP BY ALL),
s AS (SELECT vec_id, t, (sum(n) OVER u)::DOUBLE n0, (sum(n * t) OVER u)::DOUBLE s0, (sum(n) OVER a)::DOUBLE n1, (sum(n * t) OVER a)::DOUBLE s1 FROM h
 WINDOW u AS (PARTITION BY vec_id ORDER BY t), a AS (PARTITION BY vec_id)),
c AS (SELECT vec_id, t, round(n0 * (n1 - n0) * (s0 / n0 - (s1 - s0) / (n1 - n0)) * (s0 / n0 - (s1 - s0) / (n1 - n0)) / (n1 * n1), 6) score FROM s WHERE n0 < n1),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, t) rn FROM c)
SELECT vec_id, t AS threshold, score FROM r WHERE rn = 1""")
def otsu_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return raster.otsu(_gray(spark, sf).select("vec_id", F.explode("g").alias("v")), "vec_id")


@query("""
WITH m AS (SELECT l_returnflag, l_quantity / 50 a, (l_quantity / 50) * (l_quantity / 50) b, l_discount y FROM lineitem),
s AS (SELECT l_returnflag, sum(a * a) aa, sum(a * b) ab, sum(b * b) bb, sum(a * y) ay, sum(b * y) byy FROM m GROUP BY 1)
SELECT l_returnflag, round((ay * bb - byy * ab) / (aa * bb - ab * ab), 5) AS k1, round((byy * aa - ay * ab) / (aa * bb - ab * ab), 5) AS k2 FROM s""")
def radial_fit(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("l_quantity") / 50
    out = stats.least_squares(table(spark, sf, "lineitem"), ["l_returnflag"], a, a * a, F.col("l_discount"), ("k1", "k2"))
    return out.select("l_returnflag", F.round("k1", 5).alias("k1"), F.round("k2", 5).alias("k2"))


@query("""
WITH m AS (SELECT vec_id, median(v::DOUBLE) med FROM (SELECT vec_id, unnest(embedding) v FROM embeddings) GROUP BY 1)
SELECT vec_id, round(med, 6) AS med, round((SELECT median(med) FROM m) - med, 6) AS shift FROM m""")
def book_normalize(spark: SparkSession, sf: str) -> DataFrame:
    out = raster.normalized(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return out.select("vec_id", F.round("med", 6).alias("med"), F.round("shift", 6).alias("shift"))


@query("""SELECT o_orderkey, CASE WHEN v >= 2 AND h >= 2 THEN 1.0 WHEN v >= 2 AND h = 1 THEN 0.9 WHEN v >= 2 THEN 0.8 WHEN v + h = 1 THEN 0.3 ELSE 0.0 END
::DOUBLE AS confidence FROM (SELECT o_orderkey, o_orderkey % 4 AS v, (o_orderkey // 4) % 3 AS h FROM orders)""")
def border_confidence(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", stats.border_confidence(k % 4, F.floor(k / 4) % 3).alias("confidence"))


@query("""SELECT user_id, round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 4)::DOUBLE AS percent FROM events
GROUP BY 1 HAVING 100 * count(*) FILTER (event_type = 'error') > 20 * count(*)""")
def fallback_review(spark: SparkSession, sf: str) -> DataFrame:
    """Stages in which over a fifth of the pages fell back."""
    return tables.in_review(table(spark, sf, "events"), ["user_id"], F.col("event_type") == "error")


@query("""SELECT p_partkey, part FROM (SELECT p_partkey, CASE WHEN p_size > 25 THEN ['left', 'right'] ELSE ['whole'] END AS parts FROM part), unnest(parts) t(part)""")
def spread_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.explode(tables.spread_parts(F.col("p_size") > 25)).alias("part"))


@query("""SELECT o_custkey, o_orderkey, n AS printed, row_number() OVER (PARTITION BY o_custkey ORDER BY n, o_orderkey)::INT AS place,
count(*) OVER (PARTITION BY o_custkey, n) > 1 AS duplicate FROM (SELECT o_custkey, o_orderkey, o_orderkey % 7 AS n FROM orders)""")
def printed_page_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 7).alias("printed"))
    return tables.printed_order(rows, "o_custkey", "printed", "o_orderkey")


@query("""WITH s AS (SELECT DISTINCT user_id % 2 AS branch, event_id % 16 AS n FROM events)
SELECT branch, max(n) AS n, printf('%02d_stage', max(n)) AS stage FROM s WHERE n < 14 GROUP BY 1""")
def latest_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Highest stage below 14 that each branch has."""
    name = F.concat(F.lpad((F.col("event_id") % 16).cast("string"), 2, "0"), F.lit("_stage"))
    rows = table(spark, sf, "events").select((F.col("user_id") % 2).alias("branch"), name.alias("stage"))
    return tables.latest_stage(rows, "branch", 14).select("branch", F.col("number").cast("long").alias("n"), "stage")


@query("""WITH c AS (SELECT * FROM (VALUES ('STEEL', 0.01), ('BRASS', 0.02), ('TIN', 0.03)) v(name, k1))
SELECT p_partkey, coalesce(k1, 0.0)::DOUBLE AS k1 FROM part LEFT JOIN c ON contains(p_type, name)""")
def lens_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficient by substring match with a table of three rows, nought where nothing matches."""
    lenses = spark.createDataFrame([("STEEL", 0.01), ("BRASS", 0.02), ("TIN", 0.03)], "name string, k1 double")
    return tables.by_substring(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", lenses, "name", "k1", 0.0).drop("p_type")


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 'osd' END, CASE WHEN o_orderkey % 3 = 0 THEN 'title' END,
CASE WHEN o_orderkey % 2 = 0 THEN 'spine' END, 'none') AS method FROM orders""")
def polarity_cascade(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    tries = [(name, k % n == 0) for n, name in ((5, "osd"), (3, "title"), (2, "spine"))]
    return table(spark, sf, "orders").select("o_orderkey", tables.first_answer(tries, "none").alias("method"))


@query("""SELECT label, greatest(20, round(0.5 * median(m), 4))::DOUBLE AS sat_min, greatest(40, round(0.5 * median(x), 4))::DOUBLE AS val_min FROM (
SELECT label, list_avg(list_transform(embedding, lambda v: (v::DOUBLE + 0.5) * 255)) AS m, list_max(list_transform(embedding, lambda v: (v::DOUBLE + 0.5) * 255)) AS x
FROM embeddings) GROUP BY 1""")
def ink_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds at half the medians, with floors."""
    v = F.transform("embedding", lambda x: (x.cast("double") + 0.5) * 255)
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
    rows = table(spark, sf, "embeddings").select("label", mean.alias("m"), F.array_max(v).alias("x"))
    return rows.groupBy("label").agg(stats.half_median(F.col("m"), 20).alias("sat_min"), stats.half_median(F.col("x"), 40).alias("val_min"))


@query("""SELECT s.o_orderstatus AS stage, e.event_type AS kind, count(e.event_id) AS n FROM (SELECT DISTINCT o_orderstatus FROM orders) s
CROSS JOIN (SELECT DISTINCT event_type FROM events) t LEFT JOIN events e ON e.event_type = t.event_type AND e.event_id % 3 = CASE s.o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END
GROUP BY ALL""")
def stage_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by stage and kind; the stage of an event follows from its id, so one aggregation fills the matrix."""
    stage = F.element_at(F.array(F.lit("O"), F.lit("F"), F.lit("P")), (F.col("event_id") % 3 + 1).cast("int"))
    return tables.counted(table(spark, sf, "events").select(stage.alias("stage"), F.col("event_type").alias("kind")), ["stage", "kind"])