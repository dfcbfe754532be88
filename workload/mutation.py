"""Cleaning, upserts, deletes, changes, streams and monitoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from perkline import fixed_values as fixed
from perkline.functions.decoding import connect_decimal, unscaled_integer
from perkline.operators.checks import key_measures
from perkline.operators.cleaning import correct_values, missing_to_null, rename_headers
from perkline.operators.comparing import volumes
from perkline.operators.merging import (
    delete_published,
    merge_published,
    merged,
    with_keys,
    without_keys,
)
from perkline.operators.profiling import rows_left
from perkline.operators.reconciling import bucket_digests, differing_buckets, key_differences
from perkline.operators.rules import commute_rules
from perkline.plans import commute, incremental, monitoring
from perkline.session import shared_dir
from perkline.sources.streams import read_stream
from perkline.sources.tables import Layout, publish, published_snapshot, read_published, read_table
from perkline.streaming import changes as cdc
from perkline.streaming.notifications import notifications, notify_late, notify_stream
from perkline.streaming.recompute import recompute_on_change, version_stream
from workload import business, roles
from workload.registry import query
from workload.roles import BENEFITS

LONG = T.LongType()


# --- Cleaning -----------------------------------------------------------------------


@query(
    "standardised_profiles",
    (),
    """
SELECT employee_id, CASE WHEN trim(s) IN ('', 'NaN') THEN NULL WHEN s = 'Runing' THEN 'Running' ELSE s END AS sport_type
FROM (SELECT user_id AS employee_id,
             CASE event_type WHEN 'click' THEN 'Runing' WHEN 'error' THEN ' ' WHEN 'view' THEN 'NaN' ELSE event_type END AS s
      FROM events)""",
)
def _(spark, sf_dir):
    kind = F.col("event_type")
    raw = roles.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ID salarié"),
        F.when(kind == "click", "Runing")
        .when(kind == "error", " ")
        .when(kind == "view", "NaN")
        .otherwise(kind)
        .alias("Pratique d'un sport"),
    )
    named = rename_headers(raw, fixed.SPORT_HEADERS)
    return missing_to_null(correct_values(named, "sport_type", fixed.SPORT_CORRECTIONS), "sport_type")


# --- Upserts and deletes ----------------------------------------------------------------

# Orders already landed, and a delivery that repeats some of them with new values.
_ORDERS = """
WITH target AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')),
source AS (SELECT o_orderkey, o_custkey, 'D' AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
                  o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'P')),
merged AS (
  SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
  UNION ALL SELECT * FROM source)
"""


def _orders(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    source = orders.filter(F.col("o_orderstatus").isin("O", "P")).withColumns(
        {"o_orderstatus": F.lit("D"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    return orders.filter(F.col("o_orderstatus").isin("F", "P")), source


@query("merge_upsert", (), _ORDERS + "SELECT * FROM merged")
def _(spark, sf_dir):
    target, source = _orders(spark, sf_dir)
    return merged(target, source, ["o_orderkey"])


@query("merge_published_table", (), _ORDERS + "SELECT * FROM merged")
def _(spark, sf_dir):
    # On a stored table, twice: the second run must change nothing.
    target, source = _orders(spark, sf_dir)
    path = shared_dir(spark, "orders")
    publish(target, path)
    merge_published(spark, path, source, ["o_orderkey"])
    merge_published(spark, path, source, ["o_orderkey"])
    return read_published(spark, path)


@query("bucketed_upsert", (), _ORDERS + "SELECT * FROM merged")
def _(spark, sf_dir):
    # On a table laid out by key: only the buckets of the delivery are rewritten, twice.
    target, source = _orders(spark, sf_dir)
    path = shared_dir(spark, "orders")
    publish(target, path, layout=Layout(("o_orderkey",), 16))
    merge_published(spark, path, source, ["o_orderkey"])
    merge_published(spark, path, source, ["o_orderkey"])
    return read_published(spark, path)


@query(
    "schema_change",
    (),
    """
SELECT 1 AS version, o_orderkey, CAST(o_custkey AS DECIMAL(20,0)) AS o_custkey, o_totalprice, NULL AS note FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 2, o_orderkey, CAST(o_custkey AS DECIMAL(20,0)), o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(spark, sf_dir):
    # A column is widened, one dropped and one added; readers see the first version in today's columns.
    orders = roles.table(spark, sf_dir, "orders")
    path = shared_dir(spark, "orders")
    first = orders.filter("o_orderstatus = 'F'")
    publish(first.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("float").alias("price"), "o_totalprice"), path)
    second = orders.filter("o_orderstatus <> 'F'").select(
        "o_orderkey",
        F.col("o_custkey").cast("decimal(20,0)").alias("o_custkey"),
        "o_totalprice",
        F.col("o_orderpriority").alias("note"),
    )
    publish(second, path)
    now = published_snapshot(spark, path)
    old = read_published(spark, path, version=1, schema=now.schema).withColumn("version", F.lit(1))
    return old.unionByName(now.read(spark).withColumn("version", F.lit(2)))


@query(
    "merge_check",
    (),
    """
WITH target AS (SELECT l_orderkey AS k FROM lineitem WHERE l_linenumber <= 2),
source AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O'),
merged AS (SELECT k FROM target WHERE k NOT IN (SELECT k FROM source) UNION ALL SELECT k FROM source),
groups AS (SELECT k, count(*) AS n FROM merged GROUP BY k)
SELECT CAST(sum(n) AS BIGINT) AS total, count(k) AS distinct_non_null, count(*) AS distinct_keys,
       count(*) FILTER (n > 1) AS repeated_keys, CAST(sum(n) AS BIGINT) - count(k) AS surplus_rows,
       CAST(sum(n) AS BIGINT) - count(*) AS later_rows
FROM groups""",
)
def _(spark, sf_dir):
    # The target already repeats keys; those that the source replaces are single afterwards.
    lines = roles.table(spark, sf_dir, "lineitem").filter("l_linenumber <= 2")
    orders = roles.table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    target, source = lines.select(F.col("l_orderkey").alias("k")), orders.select(F.col("o_orderkey").alias("k"))
    return key_measures(merged(target, source, ["k"]), ["k"])


@query(
    "partial_upsert",
    ("rules", "commute_requests", "commute_answers", "commute_validation", "commute_checked"),
    """
, target AS (SELECT *, 'first check' AS note FROM commute_validation WHERE distance_km < 20)
SELECT employee_id, coalesce(s.distance_km, t.distance_km) AS distance_km,
       coalesce(s.threshold_km, t.threshold_km) AS threshold_km,
       coalesce(s.is_sport_commute, t.is_sport_commute) AS is_sport_commute,
       coalesce(s.is_valid, t.is_valid) AS is_valid,
       coalesce(s.validation_reason, t.validation_reason) AS validation_reason, t.note
FROM target t FULL JOIN commute_checked s USING (employee_id)""",
)
def _(spark, sf_dir):
    rules = commute_rules(spark, roles.RULES)
    first = commute.validated(roles.commute_requests(spark, sf_dir), rules)
    target = first.filter("distance_km < 20").withColumn("note", F.lit("first check"))
    again = commute.validated(roles.commute_answers(spark, sf_dir), rules)
    return merged(target, again, ["employee_id"], commute.UPDATED_COLUMNS)


@query(
    "composite_upsert",
    ("activities",),
    """
, target AS (SELECT * EXCLUDE (activity_id) FROM activities WHERE start_datetime < TIMESTAMP '2024-01-20 00:00:00'),
source AS (SELECT employee_id, start_datetime, sport_type, CAST(distance_meters + 1 AS DECIMAL(10,2)) AS distance_meters,
                  end_datetime + INTERVAL 1 MINUTE AS end_datetime, CAST(NULL AS VARCHAR) AS comment
           FROM activities WHERE start_datetime >= TIMESTAMP '2024-01-10 00:00:00')
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.employee_id = t.employee_id AND s.start_datetime = t.start_datetime AND s.sport_type = t.sport_type)
UNION ALL SELECT * FROM source""",
)
def _(spark, sf_dir):
    rows = roles.activities(spark, sf_dir).drop("activity_id")
    source = rows.filter("start_datetime >= timestamp_ntz'2024-01-10 00:00:00'").withColumns(
        {
            "distance_meters": (F.col("distance_meters") + 1).cast("decimal(10,2)"),
            "end_datetime": F.timestamp_add("MINUTE", F.lit(1), F.col("end_datetime")),
            "comment": F.lit(None).cast("string"),
        }
    )
    target = rows.filter("start_datetime < timestamp_ntz'2024-01-20 00:00:00'")
    return merged(
        target,
        source,
        ["employee_id", "start_datetime", "sport_type"],
        ["distance_meters", "end_datetime", "comment"],
    )


@query(
    "delete_keys",
    (),
    "SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def _(spark, sf_dir):
    doomed = roles.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    orders = roles.table(spark, sf_dir, "orders")
    return without_keys(orders, doomed.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])


@query(
    "bucketed_delete",
    (),
    "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45)",
)
def _(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 45")
    path = shared_dir(spark, "orders")
    publish(roles.table(spark, sf_dir, "orders"), path, layout=Layout(("o_orderkey",), 32))
    delete_published(spark, path, lines.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])
    return read_published(spark, path)


@query(
    "deleted_rows",
    (),
    "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ORDER BY o_orderkey",
)
def _(spark, sf_dir):
    doomed = roles.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    orders = roles.table(spark, sf_dir, "orders")
    keys = doomed.select(F.col("c_custkey").alias("o_custkey"))
    return with_keys(orders, keys, ["o_custkey"]).orderBy("o_orderkey")


@query(
    "cleanup_report",
    (),
    """
WITH gone AS (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000 OR o_orderkey = (SELECT max(o_orderkey) FROM orders))
SELECT (SELECT count(*) FROM orders) AS rows_before, count(*) AS rows_after, max(o_orderkey) AS last_key
FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)""",
)
def _(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey").alias("o_orderkey"))
    doomed = orders.filter("o_totalprice > 400000").select("o_orderkey").union(last).distinct()
    path = shared_dir(spark, "cleanup")
    publish(orders, path)
    before = read_published(spark, path).agg(F.count(F.lit(1)).alias("rows_before"))
    delete_published(spark, path, doomed, ["o_orderkey"])
    left = rows_left(read_published(spark, path), "o_orderkey").withColumnRenamed("last_key", "last")
    # Two single rows side by side: the maximum takes the side that has the value.
    both = before.unionByName(left, allowMissingColumns=True)
    return both.agg(
        F.max("rows_before").alias("rows_before"), F.max("rows_after").alias("rows_after"), F.max("last").alias("last_key")
    )


# --- Changes ---------------------------------------------------------------------------


@query("cdc_decode", ("changes", "created"), "SELECT * FROM created")
def _(spark, sf_dir):
    return cdc.created_activities(roles.messages(spark, sf_dir), id_type=LONG)


@query(
    "cdc_decode_seconds",
    ("changes", "created"),
    """
SELECT * REPLACE (date_trunc('second', start_datetime) AS start_datetime,
                  date_trunc('second', end_datetime) AS end_datetime) FROM created""",
)
def _(spark, sf_dir):
    return cdc.created_activities(roles.messages(spark, sf_dir), whole_seconds=True, id_type=LONG)


@query(
    "cdc_operations",
    ("changes",),
    """
SELECT CASE WHEN NOT broken THEN operation END AS operation, count(*) AS messages,
       count(*) FILTER (NOT broken) AS with_key
FROM changes GROUP BY 1""",
)
def _(spark, sf_dir):
    parsed = cdc.parse_envelopes(roles.messages(spark, sf_dir), id_type=LONG)
    return parsed.groupBy("operation").agg(
        F.count(F.lit(1)).alias("messages"), F.count("activity_id").alias("with_key")
    )


@query(
    "cdc_dead_letters",
    ("changes",),
    """
SELECT activity_id AS "offset", CASE WHEN operation = 'u' AND seconds < 300 THEN 'no value' WHEN broken THEN 'no JSON' WHEN operation = 'r' AND seconds < 300 THEN 'no payload'
            WHEN operation = 'd' AND seconds < 300 THEN 'unknown operation' ELSE 'no key' END AS reason
FROM changes WHERE broken OR (seconds < 300 AND operation <> 'c') OR (operation = 'c' AND sport_type = 'purchase' AND seconds < 300)""",
)
def _(spark, sf_dir):
    # Short activities arrive as tombstones, without payload, without key or with an operation nobody knows.
    op, short = roles.operation(F.col("event_type")), F.col("value") < 5
    events = roles.table(spark, sf_dir, "events")
    kinds = events.select(F.col("event_id").alias("offset"), op.alias("op"), "event_type", short.alias("short"))
    sent = roles.envelopes(events).join(kinds, "offset")
    text = F.col("value").cast("string")
    value = (
        F.when(F.col("short") & (F.col("op") == "u"), None)
        .when(F.col("short") & (F.col("op") == "r"), '{"schema": {}}')
        .when(F.col("short") & (F.col("op") == "d"), F.replace(text, F.lit('"op":"d"'), F.lit('"op":"x"')))
        .when(F.col("short") & (F.col("event_type") == "purchase"), F.replace(text, F.lit("activity_id"), F.lit("row_id")))
        .otherwise(text)
    )
    found = cdc.dead_letters(sent.withColumn("value", value.cast("binary")), ["offset"], id_type=LONG)
    return found.select("offset", "reason")


# Every user is one row here, and all its events are changes to that row.
_USER_HISTORY = """
WITH history AS (
  SELECT user_id AS activity_id, ts, event_type, value, event_id,
         CASE event_type WHEN 'signup' THEN 'r' WHEN 'error' THEN 'd' WHEN 'view' THEN 'u' ELSE 'c' END AS operation
  FROM events),
last AS (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY event_id DESC) = 1)
"""


@query(
    "latest_change",
    (),
    _USER_HISTORY + "SELECT activity_id, event_type, value, event_id, operation FROM last",
)
def _(spark, sf_dir):
    events = roles.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("activity_id"),
        "event_type",
        "value",
        "event_id",
        roles.operation(F.col("event_type")).alias("operation"),
    )
    return cdc.latest_per_key(events, "activity_id", ["event_id"])


@query(
    "cdc_apply",
    (),
    _USER_HISTORY
    + """
SELECT c_custkey AS activity_id, c_mktsegment AS event_type, c_acctbal AS value FROM customer
WHERE c_custkey NOT IN (SELECT activity_id FROM last)
UNION ALL SELECT activity_id, event_type, value FROM last WHERE operation <> 'd'""",
)
def _(spark, sf_dir):
    existing = roles.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("activity_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    history = roles.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("activity_id"),
        "event_type",
        "value",
        "event_id",
        roles.operation(F.col("event_type")).alias("operation"),
    )
    return cdc.applied(existing, history, order=["event_id"])


@query(
    "decimal_decode",
    (),
    """
SELECT o_orderkey, CAST(round(o_totalprice * 100 * (CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END)) AS BIGINT) AS unscaled,
       CAST(CAST(round(o_totalprice * 100 * (CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END)) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS amount
FROM orders""",
)
def _(spark, sf_dir):
    # Prices as exact cents, negative for finished orders, sent and read back.
    sign = F.when(F.col("o_orderstatus") == "F", -1).otherwise(1)
    cents = F.round(F.col("o_totalprice") * 100 * sign).cast("long")
    encoded = roles.encoded_decimal(cents)
    return roles.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        unscaled_integer(encoded).alias("unscaled"),
        connect_decimal(encoded).alias("amount"),
    )


_MESSAGES = """
, spoken AS (
  SELECT c.*, first_name, last_name, seconds // 60 AS minutes,
         CAST(distance_meters * 100 AS BIGINT) AS cents
  FROM changes c JOIN employees e ON c.employee_id = e.employee_id
  WHERE operation = 'c' AND NOT broken),
texts AS (
  SELECT *,
    CASE WHEN minutes // 60 = 0 THEN (minutes % 60) || ' min'
         WHEN minutes % 60 = 0 THEN (minutes // 60) || ' h'
         ELSE (minutes // 60) || ' h ' || (minutes % 60) || ' min' END AS duration_text,
    -- hundredths of a kilometre, ties to the even one
    cents // 1000 + CASE WHEN cents % 1000 > 500 OR (cents % 1000 = 500 AND (cents // 1000) % 2 = 1) THEN 1 ELSE 0 END AS h
  FROM spoken),
notes AS (
  SELECT *, CASE distance_state WHEN 'invalid' THEN 'Distance invalide'
                 WHEN 'present' THEN (h // 100) || '.' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') || ' km' END AS distance_text
  FROM texts)
SELECT activity_id, employee_id, first_name, last_name, sport_type,
       strftime(start_datetime, '%d/%m/%Y %H:%M:%S') AS start_text,
       strftime(end_datetime, '%d/%m/%Y %H:%M:%S') AS end_text, duration_text, distance_text,
       'Bravo ' || first_name || ' ' || last_name || ' ! Tu viens de terminer une activité ' || sport_type
         || CASE WHEN distance_text IS NOT NULL THEN ' de ' || distance_text ELSE '' END
         || ' en ' || duration_text || ' ! 🔥🏅'
         || CASE WHEN comment <> '' THEN chr(10) || '💬 ' || comment ELSE '' END AS message
FROM notes"""


@query("notifications", ("changes", "employees"), _MESSAGES)
def _(spark, sf_dir):
    return notifications(
        roles.messages(spark, sf_dir), roles.employees(spark, sf_dir), id_type=LONG
    )


# --- Streams: the same results from running queries ----------------------------------------


def _event_stream(spark, sf_dir):
    # A pattern, so that the table may be one file or a folder of files.
    return read_stream(spark, "parquet", f"{sf_dir}/events.parque[t]", roles.SCHEMAS["events"])


@query("stream_ingest", ("changes", "created"), "SELECT * FROM created")
def _(spark, sf_dir):
    path = shared_dir(spark, "ingested")
    started = cdc.ingest(
        roles.envelopes(_event_stream(spark, sf_dir)),
        path,
        shared_dir(spark, "ingest-progress"),
        once=True,
        id_type=LONG,
    )
    started.awaitTermination()
    return read_table(spark, path)


@query("stream_notifications", ("changes", "employees"), _MESSAGES)
def _(spark, sf_dir):
    path = shared_dir(spark, "notified")
    notify_stream(
        roles.envelopes(_event_stream(spark, sf_dir)),
        lambda session: roles.employees(session, sf_dir),
        path,
        shared_dir(spark, "not-notified"),
        shared_dir(spark, "notify-progress"),
        once=True,
        id_type=LONG,
    ).awaitTermination()
    return read_table(spark, path).drop("query", "batch_id")


@query("stream_notifications_once", ("changes", "employees"), _MESSAGES)
def _(spark, sf_dir):
    # The topic delivers every creation twice, and is read again from its start by a second query.
    path = shared_dir(spark, "notified")
    for _ in range(2):
        twice = roles.envelopes(_event_stream(spark, sf_dir)).union(roles.envelopes(_event_stream(spark, sf_dir)))
        notify_stream(
            twice,
            lambda session: roles.employees(session, sf_dir),
            path,
            f"{path}-unknown",
            shared_dir(spark, "notify-progress"),
            once=True,
            id_type=LONG,
        ).awaitTermination()
    return read_table(spark, path).drop("query", "batch_id")


@query("late_notifications", ("changes", "employees"), _MESSAGES)
def _(spark, sf_dir):
    # Part of the people are published only after their activities arrived; they get their messages then.
    path = shared_dir(spark, "notified")
    notify_stream(
        roles.envelopes(_event_stream(spark, sf_dir)),
        lambda session: roles.employees(session, sf_dir).filter("gross_salary > 4000"),
        path,
        f"{path}-unknown",
        shared_dir(spark, "notify-progress"),
        once=True,
        id_type=LONG,
    ).awaitTermination()
    for _ in range(2):
        notify_late(spark, roles.employees(spark, sf_dir), path, f"{path}-unknown")
    return read_table(spark, path).drop("query", "batch_id")


@query(
    "stream_apply",
    ("changes", "created", "activities"),
    """
, kept AS (SELECT * FROM activities WHERE activity_id NOT IN (SELECT activity_id FROM changes WHERE NOT broken))
SELECT * FROM kept
UNION ALL
SELECT activity_id, employee_id, start_datetime, sport_type, distance_meters, end_datetime, comment
FROM changes WHERE NOT broken AND operation <> 'd'""",
)
def _(spark, sf_dir):
    # The table holds every activity; the topic then updates, re-creates or deletes them.
    path = shared_dir(spark, "applied")
    publish(roles.activities(spark, sf_dir), path, layout=Layout(("activity_id",), 8))
    cdc.apply_stream(
        roles.envelopes(_event_stream(spark, sf_dir)),
        path,
        shared_dir(spark, "apply-progress"),
        operations=(fixed.OP_CREATE, fixed.OP_UPDATE, fixed.OP_SNAPSHOT, fixed.OP_DELETE),
        once=True,
        id_type=LONG,
    ).awaitTermination()
    return read_published(spark, path)


@query("recompute_on_change", BENEFITS, "SELECT * FROM benefits")
def _(spark, sf_dir):
    table, results = shared_dir(spark, "activities"), shared_dir(spark, "benefits")
    progress = shared_dir(spark, "recompute-progress")
    activities = roles.activities(spark, sf_dir)
    cdc.start_table(spark, table, activities)

    def recompute(session):
        publish(
            business.plan.employee_benefits(
                roles.employees(session, sf_dir),
                commute.validated(
                    roles.commute_requests(session, sf_dir), commute_rules(session, roles.RULES)
                ),
                read_published(session, table),
                roles.AS_OF,
            ),
            results,
        )

    def run():
        versions = version_stream(spark, table)
        recompute_on_change(
            versions, recompute, progress, adopt_current=True, once=True
        ).awaitTermination()

    run()  # adopts the empty version and computes nothing
    publish(activities, table)
    run()
    return read_published(spark, results)


@query("benefits_incremental", BENEFITS, "SELECT * FROM benefits")
def _(spark, sf_dir):
    # From an earlier state of all inputs and an earlier day to the present one, by what differs.
    at = {name: shared_dir(spark, name) for name in ("employees", "commute", "activities", "days", "results")}
    staff, rules = roles.employees(spark, sf_dir), commute_rules(spark, roles.RULES)
    checked = commute.validated(roles.commute_requests(spark, sf_dir), rules)
    acts = roles.activities(spark, sf_dir)
    day = F.lit("2024-01-25").cast("timestamp_ntz")
    before = acts.filter(F.col("start_datetime") < day).withColumns(
        {
            "distance_meters": F.when(F.col("sport_type") == "click", F.col("distance_meters") + 1)
            .otherwise(F.col("distance_meters"))
            .cast("decimal(10,2)"),
        }
    )
    gone = before.filter("sport_type = 'signup'").withColumn("activity_id", -F.col("activity_id"))
    lower = F.when(F.col("business_unit").isNull(), F.lit(0)).otherwise(F.col("gross_salary") - 1)
    versions = {
        "employees": (staff.withColumn("gross_salary", lower.cast("decimal(10,2)")), staff, "employee_id"),
        "commute": (checked.filter("distance_km < 10"), checked, "employee_id"),
        "activities": (before.unionByName(gone), acts, "activity_id"),
    }
    update = lambda as_of: incremental.update_benefits(spark, *at.values(), as_of, buckets=16)
    for name, (first, _, key) in versions.items():
        publish(first, at[name], layout=Layout((key,), 16))
    update(dt.date(2025, 1, 10))
    for name, (_, now, key) in versions.items():
        merge_published(spark, at[name], now, [key])
    delete_published(spark, at["activities"], gone, ["activity_id"])
    update(roles.AS_OF)
    return incremental.read_benefits(spark, at["results"])


# --- Agreement and monitoring ---------------------------------------------------------------


@query(
    "reconcile_keys",
    ("changes", "created", "activities"),
    """
, target AS (SELECT * FROM created UNION ALL SELECT * REPLACE (-activity_id AS activity_id) FROM created WHERE sport_type = 'purchase'
             UNION ALL SELECT * FROM created WHERE distance_meters < 300)
, pairs AS (
  SELECT coalesce(s.activity_id, t.activity_id) AS activity_id, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
         s.own IS NOT DISTINCT FROM t.own AS same
  FROM (SELECT activity_id, count(*) AS n, list_sort(list(activities)) AS own FROM activities GROUP BY activity_id) s
  FULL JOIN (SELECT activity_id, count(*) AS n, list_sort(list(target)) AS own FROM target GROUP BY activity_id) t ON s.activity_id = t.activity_id)
SELECT activity_id, CASE WHEN target_rows = 0 THEN 'missing' WHEN source_rows = 0 THEN 'extra' ELSE 'changed' END AS difference, source_rows, target_rows
FROM pairs WHERE NOT same""",
)
def _(spark, sf_dir):
    # What arrived lacks some activities and fields, has some twice, and some that the source never had.
    created = cdc.created_activities(roles.messages(spark, sf_dir), id_type=LONG)
    invented = created.filter("sport_type = 'purchase'").withColumn("activity_id", -F.col("activity_id"))
    target = created.unionByName(invented).unionByName(created.filter("distance_meters < 300"))
    return key_differences(roles.activities(spark, sf_dir), target, ["activity_id"])


@query(
    "reconcile_buckets",
    ("changes", "created", "activities"),
    """
, kinds AS (SELECT DISTINCT sport_type FROM activities)
SELECT sport_type, (SELECT count(*) FROM activities a WHERE a.sport_type = k.sport_type) AS source_rows,
       (SELECT count(*) FROM created c WHERE c.sport_type = k.sport_type) AS target_rows
FROM kinds k""",
)
def _(spark, sf_dir):
    # Digests are sums, so those of small buckets add up to those of large ones: here by kind of sport.
    sides = roles.activities(spark, sf_dir), cdc.created_activities(roles.messages(spark, sf_dir), id_type=LONG)
    source, target = (bucket_digests(side, ["activity_id"], side.columns, by=["sport_type"]) for side in sides)
    found = differing_buckets(source, target, ["sport_type"])
    return found.groupBy("sport_type").agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))


@query(
    "reconcile_volumes",
    ("changes", "created", "activities"),
    """
, v AS (SELECT (SELECT count(*) FROM activities) AS source_rows, (SELECT count(*) FROM created) AS target_rows)
SELECT source_rows, target_rows, source_rows - target_rows AS difference,
       CASE WHEN source_rows = target_rows THEN 'OK' ELSE 'WARNING' END AS status FROM v""",
)
def _(spark, sf_dir):
    ingested = cdc.created_activities(roles.messages(spark, sf_dir), id_type=LONG)
    return volumes(roles.activities(spark, sf_dir), ingested)


_METRICS = ("recorded", *BENEFITS)
_METRIC_ROWS = """
, metrics AS (
  SELECT 'duplicate_activity_id' AS metric_name,
         (SELECT count(*) FROM recorded) - (SELECT count(*) FROM (SELECT DISTINCT activity_id FROM recorded)) AS metric_value
  UNION ALL SELECT 'null_activity_id', count(*) FILTER (activity_id IS NULL) FROM recorded
  UNION ALL SELECT 'null_employee_id_activities', count(*) FILTER (employee_id IS NULL) FROM recorded
  UNION ALL SELECT 'inconsistent_dates', count(*) FILTER (end_datetime < start_datetime) FROM recorded
  UNION ALL SELECT 'negative_distances', count(*) FILTER (distance_meters < 0) FROM recorded
  UNION ALL SELECT 'duplicate_benefit_employee_id', count(*) - count(DISTINCT employee_id) FROM benefits
  UNION ALL SELECT 'null_benefit_employee_id', count(*) FILTER (employee_id IS NULL) FROM benefits)
"""


def _metrics(spark, sf_dir):
    return monitoring.quality_metrics(
        roles.recorded(spark, sf_dir), business.benefits(spark, sf_dir)
    )


@query(
    "monitor_metrics",
    _METRICS,
    _METRIC_ROWS + "SELECT metric_name, metric_value, TIMESTAMP '2025-01-24 08:00:00' AS checked_at FROM metrics",
)
def _(spark, sf_dir):
    return monitoring.metric_history(_metrics(spark, sf_dir), dt.datetime(2025, 1, 24, 8))


@query(
    "overall_status",
    _METRICS,
    _METRIC_ROWS
    + """
SELECT CASE WHEN (SELECT count(*) FROM recorded) = (SELECT count(*) FROM activities) THEN 'OK' ELSE 'WARNING' END AS volume_status,
       CASE WHEN max(metric_value) > 0 THEN 'ERROR' ELSE 'OK' END AS quality_status,
       CASE WHEN max(metric_value) > 0 THEN 'ERROR'
            WHEN (SELECT count(*) FROM recorded) <> (SELECT count(*) FROM activities) THEN 'WARNING' ELSE 'OK' END AS overall
FROM metrics""",
)
def _(spark, sf_dir):
    volume = volumes(roles.activities(spark, sf_dir), roles.recorded(spark, sf_dir))
    return monitoring.overall_status(volume, _metrics(spark, sf_dir))


@query(
    "status_without_faults",
    ("changes", "created", *BENEFITS),
    """
, volume AS (SELECT CASE WHEN (SELECT count(*) FROM activities) = (SELECT count(*) FROM created) THEN 'OK' ELSE 'WARNING' END AS status),
quality AS (
  SELECT CASE WHEN (SELECT count(*) - count(DISTINCT activity_id) + count(*) FILTER (employee_id IS NULL)
                           + count(*) FILTER (end_datetime < start_datetime) + count(*) FILTER (distance_meters < 0)
                    FROM activities) + (SELECT count(*) - count(DISTINCT employee_id) FROM benefits) > 0
              THEN 'ERROR' ELSE 'OK' END AS status)
SELECT v.status AS volume_status, q.status AS quality_status, CASE WHEN q.status = 'ERROR' THEN 'ERROR' ELSE v.status END AS overall
FROM volume v, quality q""",
)
def _(spark, sf_dir):
    # No faults, but fewer rows arrived than the source has.
    good = roles.activities(spark, sf_dir)
    arrived = cdc.created_activities(roles.messages(spark, sf_dir), id_type=LONG)
    metrics = monitoring.quality_metrics(good, business.benefits(spark, sf_dir))
    return monitoring.overall_status(volumes(good, arrived), metrics)
