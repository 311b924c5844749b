"""Ordered and joined rows over ``conversations``, ``events`` and ``embeddings``."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators import graphs, joins, sequences
from textloom.operators import vectors as vectors_nearest
from textloom.plans.base import query
from textloom.sources.tables import table
from textloom.streaming import events as stream


def _turns(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "conversations")


@query("band_neighbours", """
SELECT a.conv_id, a.turn AS anchor, b.turn, b.role FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn BETWEEN a.turn - 2 AND a.turn + 2 WHERE length(a.text) < 120
""", "J11 J12 W02 W15 W18")
def band_neighbours(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    return joins.band(turns.select("conv_id", "turn", "role"), turns.filter(F.length("text") < 120), ["conv_id"], "turn", 2).select("conv_id", "anchor", "turn", "role")


@query("neighbour_window", """
SELECT conv_id, turn, string_agg(role, '|' ORDER BY turn) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS roles FROM conversations
""", "W02")
def neighbour_window(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-1, 1)
    return _turns(spark, sf_dir).select("conv_id", "turn", F.array_join(F.collect_list("role").over(w), "|").alias("roles"))


CLEAN = """
WITH s AS (SELECT conv_id, turn, CAST(turn * 10 - CASE WHEN turn % 4 = 3 THEN 25 ELSE 0 END AS DOUBLE) AS start, length(text) > 20 AS ok FROM conversations),
h AS (SELECT *, max(CASE WHEN ok THEN start END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM s),
r AS (SELECT *, CASE WHEN NOT ok THEN 'invalid' WHEN start < high THEN 'backwards' END AS reason FROM h)
SELECT conv_id, turn, reason, CASE WHEN reason IS NULL THEN row_number() OVER k - 1 END AS clean_index, CASE WHEN reason IS NULL THEN lead(start) OVER k - start END AS duration FROM r WINDOW k AS (PARTITION BY conv_id, reason IS NULL ORDER BY turn)
"""


@query("clean_segments", CLEAN, "W01 W22 F26 SRC12 V06")
def clean_segments(spark, sf_dir):
    start = (F.col("turn") * 10 - F.when(F.col("turn") % 4 == 3, 25).otherwise(0)).cast("double")
    rows = _turns(spark, sf_dir).select("conv_id", "turn", start.alias("start"), (F.length("text") > 20).alias("ok"))
    return sequences.clean_segments(rows, "conv_id", "turn", "start", F.col("ok")).select("conv_id", "turn", "reason", "clean_index", "duration")


@query("islands_ranges", """
WITH s AS (SELECT conv_id, turn, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations WHERE role <> 'assistant' OR length(text) % 3 = 0)
SELECT conv_id, min(turn) AS lo, max(turn) AS hi, count(*) AS n FROM s GROUP BY conv_id, g
""", "W10 W12")
def islands_ranges(spark, sf_dir):
    rows = _turns(spark, sf_dir).filter("role <> 'assistant' OR length(text) % 3 = 0").select("conv_id", "turn")
    return sequences.islands(rows, ["conv_id"], "turn")


@query("coverage_blocks", """
WITH s AS (SELECT conv_id, turn, CASE WHEN length(text) < 60 THEN 'short' WHEN role = 'user' THEN 'covered' ELSE 'excluded' END AS state FROM conversations),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, state ORDER BY turn) AS g FROM s),
b AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, state, g ORDER BY turn) - 1) // 3 AS block FROM i)
SELECT conv_id, state, min(turn) AS lo, max(turn) AS hi, count(*) AS n FROM b GROUP BY conv_id, state, g, block
""", "W11")
def coverage_blocks(spark, sf_dir):
    state = F.when(F.length("text") < 60, "short").when(F.col("role") == "user", "covered").otherwise("excluded")
    rows = _turns(spark, sf_dir).select("conv_id", "turn", state.alias("state"))
    g = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - F.row_number().over(Window.partitionBy("conv_id", "state").orderBy("turn"))
    rows = rows.withColumn("g", g).withColumn("block", F.floor((F.row_number().over(Window.partitionBy("conv_id", "state", "g").orderBy("turn")) - 1) / 3))
    return rows.groupBy("conv_id", "state", "g", "block").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count(F.lit(1)).alias("n")).drop("g", "block")


@query("sliding_scan", """
SELECT conv_id, w AS "window", count(*) AS n, sum(length(text)) AS chars FROM (SELECT *, unnest(range(greatest(0, CAST(ceil((turn - 3) / 2.0) AS BIGINT)), turn // 2 + 1)) AS w FROM conversations) GROUP BY conv_id, w
""", "W16")
def sliding_scan(spark, sf_dir):
    rows = sequences.sliding(_turns(spark, sf_dir).select("conv_id", "turn", F.length("text").alias("chars")), "turn", 4, 2)
    return rows.groupBy("conv_id", "window").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


@query("tumbling_units", """
SELECT conv_id, turn // 3 AS unit, string_agg(left(text, 10), ' ' ORDER BY turn) AS text, max(turn) AS last_turn FROM conversations GROUP BY 1, 2
""", "W05 W06")
def tumbling_units(spark, sf_dir):
    rows = _turns(spark, sf_dir).select("conv_id", F.floor(F.col("turn") / 3).alias("unit"), "turn", F.left("text", F.lit(10)).alias("t"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "t")))
    return rows.groupBy("conv_id", "unit").agg(F.array_join(ordered.getField("t"), " ").alias("text"), F.max("turn").alias("last_turn"))


@query("greedy_chunks", """
WITH RECURSIVE n AS (SELECT conv_id, turn, length(text) AS len, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
r AS (SELECT conv_id, turn, i, 0 AS chunk, len + 80 AS used FROM n WHERE i = 1
      UNION ALL SELECT n.conv_id, n.turn, n.i, CASE WHEN r.used + n.len + 80 > 600 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.used + n.len + 80 > 600 THEN n.len + 80 ELSE r.used + n.len + 80 END FROM r JOIN n ON n.conv_id = r.conv_id AND n.i = r.i + 1)
SELECT conv_id, turn, CAST(chunk AS INTEGER) AS chunk FROM r
""", "W03 W07")
def greedy_chunks(spark, sf_dir):
    rows = _turns(spark, sf_dir).select("conv_id", "turn", F.length("text").alias("len"))
    return sequences.greedy_chunks(rows, "conv_id", "turn", "len", 600, 80).select("conv_id", "turn", "chunk")


@query("ledger_disposition", """
WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 7 = 0 THEN 'manual' WHEN role = 'assistant' THEN 'captured' WHEN contains(text, '?') THEN 'question' WHEN length(text) < 50 THEN 'low_signal' ELSE 'unreviewed' END AS disposition FROM conversations)
SELECT conv_id, disposition, count(*) AS n, min(turn) AS first_turn, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY conv_id), 6) AS share FROM c GROUP BY 1, 2
""", "L01 L09 G10")
def ledger_disposition(spark, sf_dir):
    kind = F.when(F.col("turn") % 7 == 0, "manual").when(F.col("role") == "assistant", "captured").when(F.contains("text", F.lit("?")), "question").when(F.length("text") < 50, "low_signal").otherwise("unreviewed")
    grouped = _turns(spark, sf_dir).select("conv_id", "turn", kind.alias("disposition")).groupBy("conv_id", "disposition").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("first_turn"))
    return grouped.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("conv_id")), 6))


@query("snapshot_diff", """
WITH b AS (SELECT conv_id, turn, role, length(text) AS len FROM conversations WHERE turn % 5 <> 4), a AS (SELECT conv_id, turn, CASE WHEN conv_id % 10 = 0 THEN 'edited' ELSE role END AS role, length(text) + CASE WHEN conv_id % 4 = 0 THEN 1 ELSE 0 END AS len FROM conversations WHERE turn % 5 <> 3)
SELECT coalesce(b.conv_id, a.conv_id) AS conv_id, coalesce(b.turn, a.turn) AS turn, CASE WHEN b.conv_id IS NULL THEN 'added' WHEN a.conv_id IS NULL THEN 'removed' ELSE 'changed' END AS status, CASE WHEN b.conv_id IS NULL OR a.conv_id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN b.role IS DISTINCT FROM a.role THEN 'role' END, CASE WHEN b.len IS DISTINCT FROM a.len THEN 'len' END) END AS changed
FROM b FULL JOIN a ON a.conv_id = b.conv_id AND a.turn = b.turn WHERE b.conv_id IS NULL OR a.conv_id IS NULL OR b.role IS DISTINCT FROM a.role OR b.len IS DISTINCT FROM a.len
""", "J18 J23 T05")
def snapshot_diff(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    before = turns.filter("turn % 5 <> 4").select("conv_id", "turn", "role", F.length("text").alias("len"))
    edited = F.when(F.col("conv_id") % 10 == 0, "edited").otherwise(F.col("role"))
    after = turns.filter("turn % 5 <> 3").select("conv_id", "turn", edited.alias("role"), (F.length("text") + F.when(F.col("conv_id") % 4 == 0, 1).otherwise(0)).alias("len"))
    return joins.snapshot_diff(before, after, ["conv_id", "turn"], ["role", "len"])


@query("catalog_upsert", """
WITH n AS (SELECT o_custkey AS c_custkey, round(max(o_totalprice), 2) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM (SELECT * REPLACE (CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS o_custkey) FROM orders) GROUP BY 1), o AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM customer)
SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment, CASE WHEN o.c_custkey IS NULL THEN 'inserted' WHEN n.c_custkey IS NULL THEN 'kept' ELSE 'updated' END AS origin FROM o FULL JOIN n ON o.c_custkey = n.c_custkey
""", "J19 T06")
def catalog_upsert(spark, sf_dir):
    known = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey") + 1_000_000).otherwise(F.col("o_custkey"))
    new = table(spark, sf_dir, "orders").groupBy(known.alias("c_custkey")).agg(F.round(F.max("o_totalprice"), 2).alias("c_acctbal")).withColumn("c_mktsegment", F.lit(None).cast("string"))
    return joins.upsert(table(spark, sf_dir, "customer"), new, "c_custkey", ["c_acctbal", "c_mktsegment"])


@query("asof_chapter", """
WITH c AS (SELECT DISTINCT user_id, ts, event_id AS chapter FROM events WHERE event_type = 'purchase')
SELECT e.event_id, e.user_id, c.chapter FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(chapter) AS chapter FROM c GROUP BY 1, 2) c ON e.user_id = c.user_id AND e.ts >= c.ts
""", "J08")
def asof_chapter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    marks = events.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("chapter"))
    return joins.asof(events.select("event_id", "user_id", "ts"), marks, ["user_id"], "ts", "chapter").select("event_id", "user_id", "chapter")


@query("interval_owner", """
WITH u AS (SELECT user_id, min(epoch(ts)) AS t0, CAST(floor(max(epoch(ts)) - min(epoch(ts))) AS BIGINT) AS d FROM events GROUP BY 1), w AS (SELECT user_id, t0, unnest(range(greatest(CAST(ceil(d / 86400.0) AS BIGINT) - 1, 0) + 1)) AS k, d FROM u)
SELECT w.user_id, w.k AS "window", count(*) AS n FROM w JOIN events e ON e.user_id = w.user_id AND floor(epoch(e.ts) - t0) >= k * 86400 AND floor(epoch(e.ts) - t0) < least((k + 1) * 86400, d) GROUP BY 1, 2
""", "J09 W08")
def interval_owner(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").cast("double").alias("t"))
    users = events.groupBy("user_id").agg(F.min("t").alias("t0"), F.floor(F.max("t") - F.min("t")).alias("d"))
    windows = sequences.hopping(users.select("user_id", "d"), "d", 86400, 60)
    points = events.join(users.select("user_id", "t0"), "user_id").withColumn("at", F.floor(F.col("t") - F.col("t0")))
    return joins.interval_owner(points, windows, ["user_id"], F.col("at"), "start", "end", 86400.0).groupBy("user_id", "window").agg(F.count(F.lit(1)).alias("n"))


@query("sessions_gap", """
WITH l AS (SELECT user_id, epoch(ts) AS t, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events), s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS session FROM l)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, round(max(t) - min(t), 3) AS seconds FROM s GROUP BY 1, 2
""", "W14 W19 T09")
def sessions_gap(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").cast("double").alias("t"))
    return sequences.sessions(events, ["user_id"], "t", 21600).groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("t") - F.min("t"), 3).alias("seconds"))


@query("dedupe_max_duration", """
SELECT user_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, min(event_id) AS event_id, max(value) AS value, count(*) - 1 AS dropped FROM events GROUP BY 1, 2, 3
""", "W21 S10 T07")
def dedupe_max_duration(spark, sf_dir):
    grouped = table(spark, sf_dir, "events").groupBy("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"))
    return grouped.agg(F.min("event_id").alias("event_id"), F.max("value").alias("value"), (F.count(F.lit(1)) - 1).alias("dropped"))


@query("props_json", """
SELECT event_type, CAST(props->>'k' AS BIGINT) % 10 AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2
""")
def props_json(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long") % 10)
    return events.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


STREAM = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2
"""


@query("stream_window_counts", STREAM, "T09")
def stream_window_counts(spark, sf_dir):
    return stream.finished(stream.window_counts(stream.stream(spark, sf_dir)))


@query("stream_once", "SELECT event_id, user_id, event_type FROM events", "T07 S10 SNK05")
def stream_once(spark, sf_dir):
    return stream.finished(stream.once(stream.stream(spark, sf_dir), ["event_id"]).select("event_id", "user_id", "event_type"), "append")


EDGES = "SELECT DISTINCT o_custkey AS child, o_custkey // 3 AS parent FROM orders WHERE o_custkey > 0"


@query("relation_descendants", f"""
WITH RECURSIVE e AS ({EDGES}), r AS (SELECT parent AS ancestor, child AS node, 1 AS depth FROM e UNION ALL SELECT r.ancestor, e.child, r.depth + 1 FROM r JOIN e ON e.parent = r.node WHERE r.depth < 20)
SELECT ancestor, node, min(depth) AS depth FROM r GROUP BY 1, 2
""", "L11")
def relation_descendants(spark, sf_dir):
    edges = table(spark, sf_dir, "orders").filter("o_custkey > 0").select(F.col("o_custkey").alias("child"), F.floor(F.col("o_custkey") / 3).alias("parent")).distinct()
    return graphs.descendants(edges)


@query("relation_defects", """
WITH e AS (SELECT o_orderkey AS child, 1 AS parent FROM orders UNION ALL SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN -o_custkey - 1 ELSE o_custkey // 400 END AS parent FROM orders), n AS (SELECT c_custkey FROM customer)
SELECT DISTINCT child, 'dangling_parent' AS defect FROM e WHERE parent NOT IN (SELECT c_custkey FROM n) UNION ALL SELECT child, 'several_parents' FROM (SELECT DISTINCT * FROM e) GROUP BY child HAVING count(*) > 1
""", "L09")
def relation_defects(spark, sf_dir):
    parent = F.when(F.col("o_custkey") % 10 == 0, -F.col("o_custkey") - 1).otherwise(F.floor(F.col("o_custkey") / 400))
    orders = table(spark, sf_dir, "orders")
    edges = orders.select(F.col("o_orderkey").alias("child"), parent.alias("parent")).unionByName(orders.select("o_orderkey", F.lit(1).cast("long")).toDF("child", "parent"))
    return graphs.relation_defects(edges, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node")))


@query("pricing_summary", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ROLLUP (l_returnflag, l_linestatus)
""", "G02 G09")
def pricing_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.rollup("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("nation_revenue", """
SELECT n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, rank() OVER (PARTITION BY r_name ORDER BY round(sum(l_extendedprice * (1 - l_discount)), 2) DESC) AS place
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name
""", "J01 G04 K07")
def nation_revenue(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    grouped = rows.groupBy("n_name", "r_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    return grouped.withColumn("place", F.rank().over(Window.partitionBy("r_name").orderBy(F.desc("revenue"))))


@query("vector_neighbours", """
WITH q AS (SELECT vec_id AS q, embedding AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT q.q, v.vec_id, round(CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS DOUBLE), 5) AS dot FROM q, embeddings v WHERE v.vec_id <> q.q)
SELECT q, vec_id, dot FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dot DESC, vec_id) AS rn FROM s) WHERE rn <= 5
""", "K01")
def vector_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    wanted = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("e"))
    return vectors_nearest.nearest(vectors, wanted, "vec_id", "embedding", 5)


UNIT_ROWS = """
n AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) AS len, CAST(turn * 10 AS DOUBLE) AS start, CASE WHEN turn % 7 = 6 THEN 2.0 ELSE 9.0 END AS dur,
  length(text) % 3 = 0 AS opens, CASE WHEN length(text) % 2 = 0 THEN 1 ELSE 2 END AS topics, CASE WHEN role = 'system' THEN 1 ELSE 0 END AS roles FROM conversations)
"""


@query("semantic_units", f"""
WITH RECURSIVE {UNIT_ROWS},
r AS (SELECT conv_id, turn, i, 1 AS unit, 1 AS rows, len AS used, topics, roles, start + dur AS done FROM n WHERE i = 1
      UNION ALL SELECT conv_id, turn, i, CASE WHEN new THEN unit + 1 ELSE unit END, CASE WHEN new THEN 1 ELSE rows + 1 END, CASE WHEN new THEN len ELSE used + len END,
        CASE WHEN new THEN t ELSE topics | t END, CASE WHEN new THEN o ELSE roles | o END, done
      FROM (SELECT n.conv_id, n.turn, n.i, r.unit, r.rows, r.used, n.len, r.topics, r.roles, n.topics AS t, n.roles AS o, n.start + n.dur AS done,
        r.rows >= 6 OR r.used + n.len > 900 OR n.start - r.done > 6 OR (n.roles > 0 AND n.roles <> r.roles) OR (r.rows >= 2 AND n.opens AND (r.topics & n.topics) = 0 AND (r.roles & n.roles) = 0) AS new
        FROM r JOIN n ON n.conv_id = r.conv_id AND n.i = r.i + 1)),
u AS (SELECT conv_id, unit, min(turn) AS lo, max(turn) AS hi, count(*) AS n_rows FROM r GROUP BY ALL)
SELECT conv_id, CAST(unit AS BIGINT) AS unit, lo, hi, n_rows, lag(lo) OVER (PARTITION BY conv_id ORDER BY unit) AS before, lead(lo) OVER (PARTITION BY conv_id ORDER BY unit) AS after FROM u
""", "W09")
def semantic_units(spark, sf_dir):
    return _linked_units(_unit_rows(_turns(spark, sf_dir)))


def _unit_rows(turns):
    n = F.length("text")
    return turns.select(
        "conv_id", "turn", n.alias("len"), (F.col("turn") * 10).cast("double").alias("start"), F.when(F.col("turn") % 7 == 6, 2.0).otherwise(9.0).alias("dur"),
        (n % 3 == 0).alias("opens"), F.when(n % 2 == 0, 1).otherwise(2).alias("topics"), (F.col("role") == "system").cast("int").alias("roles"),
    )


def _linked_units(rows):
    found = sequences.units(rows, "conv_id", "turn", start="start", duration="dur", chars="len", opens="opens", topics="topics", roles="roles")
    spans = found.groupBy("conv_id", "unit").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy("conv_id").orderBy("unit")
    return spans.withColumns({"before": F.lag("lo").over(w), "after": F.lead("lo").over(w)})


@query("units_refresh", """
WITH c AS (SELECT conv_id, max(turn) AS top, count(*) AS n FROM conversations GROUP BY 1) SELECT conv_id, top < 4 AS reused, n AS n_rows FROM c
""", "T04")
def units_refresh(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    none = _linked_units(_unit_rows(turns.limit(0))).withColumns({"stamp": F.lit(""), "version": F.lit(""), "reused": F.lit(False)})
    first = sequences.refreshed(none, _unit_rows(turns.filter("turn < 4")), "conv_id", "1", _linked_units)
    return sequences.refreshed(first, _unit_rows(turns), "conv_id", "1", _linked_units).groupBy("conv_id", "reused").agg(F.sum("n_rows").alias("n_rows"))
