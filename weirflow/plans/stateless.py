"""Sources, projections, routing, splitting and combining."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.scalars import by_id, is_even, is_odd, parse_int
from weirflow.functions.times import ntz_micros
from weirflow.operators import combine, partition, project, route
from weirflow.plans.registry import query
from weirflow.plans.views import SENSOR_SQL, of_kind, sensor, table
from weirflow.sinks.files import with_hour_bucket
from weirflow.sources.records import DROP, QUARANTINE, parse_records

PARTITIONS = 64
COPIES = 3
ALERT_ABOVE = 10


@query(
    "text_scan_wordcount",
    """WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
    words AS (
      SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                         ELSE string_split(rtrim(line, ' '), ' ') END) AS word
      FROM lines
    )
    SELECT word, count(*) AS n FROM words GROUP BY word""",
)
def text_scan_wordcount(spark, sf_dir):
    texts = partition.spread(table(spark, sf_dir, "documents").select("text"))
    return project.word_count(project.split_lines(texts, "text"))


def _reading_lines(spark, sf_dir):
    """Readings as comma-separated lines; those of kind ``error`` carry no number."""
    events = sensor(spark, sf_dir)
    reading = F.when(F.col("kind") == "error", F.col("kind")).otherwise(F.col("vc").cast("string"))
    seconds = F.floor(ntz_micros(F.col("ts")) / 1_000_000)
    return events.select(F.concat_ws(",", F.col("id").cast("string"), seconds.cast("string"), reading).alias("value"))


_LINE_SQL = f"""WITH {SENSOR_SQL}, lines AS (
  SELECT id || ',' || (epoch_us(ts) // 1000000) || ',' ||
         CASE WHEN kind = 'error' THEN kind ELSE CAST(vc AS VARCHAR) END AS line FROM sensor
), parsed AS (
  SELECT line, split_part(line, ',', 1) AS id, TRY_CAST(split_part(line, ',', 2) AS BIGINT) AS ts,
         TRY_CAST(split_part(line, ',', 3) AS INTEGER) AS vc FROM lines
)"""


@query("parse_sensor_lines", f"{_LINE_SQL} SELECT id, ts, vc FROM parsed WHERE ts IS NOT NULL AND vc IS NOT NULL")
def parse_sensor_lines(spark, sf_dir):
    return parse_records(_reading_lines(spark, sf_dir), policy=DROP)


@query(
    "parse_sensor_quarantine",
    f"{_LINE_SQL} SELECT id, ts, vc, CASE WHEN ts IS NULL OR vc IS NULL THEN line END AS bad_line FROM parsed",
)
def parse_sensor_quarantine(spark, sf_dir):
    return parse_records(_reading_lines(spark, sf_dir), policy=QUARANTINE)


@query("bucket_by_hour", "SELECT strftime(ts, '%Y-%m-%d %H') AS bucket, count(*) AS n FROM events GROUP BY 1")
def bucket_by_hour(spark, sf_dir):
    bucketed = with_hour_bucket(sensor(spark, sf_dir), F.col("ts"))
    return bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("map_id", "SELECT user_id AS id FROM events")
def map_id(spark, sf_dir):
    return project.map_columns(sensor(spark, sf_dir), id=F.col("id"))


_PLUS_ONE = f"WITH {SENSOR_SQL} SELECT seq, vc + 1 AS plus_one FROM sensor"


@query("map_plus_one", _PLUS_ONE)
def map_plus_one(spark, sf_dir):
    return project.map_columns(sensor(spark, sf_dir), seq=F.col("seq"), plus_one=F.col("vc") + 1)


@query("map_with_lifecycle", _PLUS_ONE)
def map_with_lifecycle(spark, sf_dir):
    """The same map with a resource per task (here just the task's number)."""
    return project.map_with_lifecycle(
        sensor(spark, sf_dir).select("seq", "vc"),
        open_task=lambda number: {"task": number},
        apply=lambda resource, rows: rows.assign(plus_one=rows["vc"] + 1)[["seq", "plus_one"]],
        close_task=lambda resource: resource.clear(),
        schema="seq bigint, plus_one int",
    )


@query(
    "flatmap_conditional",
    f"""WITH {SENSOR_SQL}
    SELECT seq, CAST(vc AS VARCHAR) AS value FROM sensor WHERE kind = 'click'
    UNION ALL SELECT seq, CAST(vc AS VARCHAR) FROM sensor WHERE kind = 'view'
    UNION ALL SELECT seq, CAST(epoch_us(ts) // 1000000 AS VARCHAR) FROM sensor WHERE kind = 'view'""",
)
def flatmap_conditional(spark, sf_dir):
    seconds = F.floor(ntz_micros(F.col("ts")) / 1_000_000)
    values = project.branches(
        (F.col("kind") == "click", [F.col("vc")]), (F.col("kind") == "view", [F.col("vc"), seconds])
    )
    return project.flat_map(sensor(spark, sf_dir), values, "value", carry=["seq"])


@query("filter_equals", f"WITH {SENSOR_SQL} SELECT * FROM sensor WHERE kind = 'click'")
def filter_equals(spark, sf_dir):
    return project.keep(sensor(spark, sf_dir), F.col("kind") == "click")


@query("filter_param", "SELECT event_type AS id, event_id AS seq FROM events WHERE event_type = 'purchase'")
def filter_param(spark, sf_dir):
    typed = sensor(spark, sf_dir).select(F.col("kind").alias("id"), "seq")
    return project.keep(typed, by_id("purchase"))


@query("filter_parsed_even", f"WITH {SENSOR_SQL} SELECT CAST(vc AS VARCHAR) AS value FROM sensor WHERE vc % 2 = 0")
def filter_parsed_even(spark, sf_dir):
    texts = sensor(spark, sf_dir).select(F.col("vc").cast("string").alias("value"))
    return project.keep(texts, is_even(parse_int(F.col("value"))))


@query(
    "cast_parse",
    r"SELECT event_id AS seq, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events",
)
def cast_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    digits = F.regexp_extract("props", r"(\d+)", 1)
    return events.select(F.col("event_id").alias("seq"), parse_int(digits).alias("k"))


@query("key_rows", "SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1")
def key_rows(spark, sf_dir):
    return sensor(spark, sf_dir).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "custom_partition",
    f"SELECT CAST(user_id % {PARTITIONS} AS INTEGER) AS partition, count(*) AS n FROM events GROUP BY 1",
)
def custom_partition(spark, sf_dir):
    """Rows placed by ``id mod n``; the partition number is read back from the running task."""
    routed = partition.route_by_rule(sensor(spark, sf_dir).select("id"), PARTITIONS, F.col("id"))
    return routed.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("replicate", f"SELECT event_id AS seq, CAST(range AS INTEGER) AS copy FROM events, range({COPIES})")
def replicate(spark, sf_dir):
    return partition.replicate(sensor(spark, sf_dir).select("seq"), COPIES)


@query(
    "split_even_odd",
    f"""WITH {SENSOR_SQL} SELECT 'even' AS output, seq, vc FROM sensor WHERE vc % 2 = 0
    UNION ALL SELECT 'odd', seq, vc FROM sensor WHERE vc % 2 = 1""",
)
def split_even_odd(spark, sf_dir):
    parts = route.split(
        sensor(spark, sf_dir).select("seq", "vc"), even=is_even(F.col("vc")), odd=is_odd(F.col("vc"))
    )
    labelled = [df.select(F.lit(name).alias("output"), "seq", "vc") for name, df in parts.items()]
    return combine.union_all(*labelled)


@query(
    "route_by_tag",
    f"""WITH {SENSOR_SQL} SELECT seq, vc, CASE kind WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE 'main' END AS tag
    FROM sensor""",
)
def route_by_tag(spark, sf_dir):
    tags = {"clicks": F.col("kind") == "click", "views": F.col("kind") == "view"}
    return route.route(sensor(spark, sf_dir), tags).select("seq", "vc", "tag")


@query(
    "alert_side_output",
    f"""WITH {SENSOR_SQL} SELECT 'main' AS output, seq, vc, CAST(NULL AS VARCHAR) AS message FROM sensor
    UNION ALL SELECT 'warn', seq, vc, 'Current Vc=' || vc || ' ,is greater than {ALERT_ABOVE}' FROM sensor
    WHERE vc > {ALERT_ABOVE}""",
)
def alert_side_output(spark, sf_dir):
    condition, message = route.above("vc", ALERT_ABOVE)
    main, warnings = route.with_alerts(sensor(spark, sf_dir).select("seq", "vc"), condition, message)
    return combine.union_all(
        main.select(F.lit("main").alias("output"), "seq", "vc", F.lit(None).cast("string").alias("message")),
        warnings.select(F.lit("warn").alias("output"), "seq", "vc", "message"),
    )


@query(
    "union_all_streams",
    f"""WITH {SENSOR_SQL} SELECT vc AS v FROM sensor WHERE kind = 'click'
    UNION ALL SELECT vc FROM sensor WHERE kind = 'purchase'
    UNION ALL SELECT CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) FROM events""",
)
def union_all_streams(spark, sf_dir):
    """Two integer inputs and a third one parsed from text."""
    readings = sensor(spark, sf_dir)
    texts = table(spark, sf_dir, "events").select(F.regexp_extract("props", r"(\d+)", 1).alias("text"))
    return combine.union_all(
        of_kind(readings, "click").select(F.col("vc").alias("v")),
        of_kind(readings, "purchase").select(F.col("vc").alias("v")),
        texts.select(parse_int(F.col("text")).alias("v")),
    )


@query(
    "connect_map",
    f"""WITH {SENSOR_SQL} SELECT 'left' AS src, CAST(vc AS VARCHAR) AS value FROM sensor
    UNION ALL SELECT 'right', o_orderpriority FROM orders""",
)
def connect_map(spark, sf_dir):
    return combine.connect_map(
        sensor(spark, sf_dir),
        table(spark, sf_dir, "orders"),
        {"value": F.col("vc").cast("string")},
        {"value": F.col("o_orderpriority")},
    )
