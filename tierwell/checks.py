"""Check queries: each operator over whole test tables, with the same result as plain SQL.

``QUERIES`` maps a name to a function of (session, table folder); ``ORACLES`` maps the same name
to SQL over views of the tables. The fact of the reports is ``lineitem`` (shipped parts), with
suppliers as departments and parts as jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tierwell.entities import DETECT, Entity
from tierwell.functions import formats, records, times
from tierwell.operators import counts, merge, numbering
from tierwell.operators.counts import Dimension
from tierwell.plans import loads, numbers, reports, statements
from tierwell.session import new_shared_path, staged
from tierwell.sources import appends, catalogue, compaction, csvs, layers

YEAR = 1997

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(oracle: str | None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def suppliers(spark: SparkSession, folder: str) -> Dimension:
    return Dimension(table(spark, folder, "supplier"), "s_suppkey", "s_name")


def parts(spark: SparkSession, folder: str) -> Dimension:
    return Dimension(table(spark, folder, "part"), "p_partkey", "p_brand")


SHIPPED = {"ts": "l_shipdate", "department_id": "l_suppkey", "year": YEAR}

# --- reports -------------------------------------------------------------------------------------


def _quarters(ts: str) -> str:
    return ", ".join(
        f"COUNT(*) FILTER (WHERE quarter({ts}) = {q}) AS \"Q{q}\"" for q in (1, 2, 3, 4)
    )


# What the reports are to say, put as counts per pair of ids that get their labels afterwards. A
# pair without a label of either kind is kept apart from one labelled UNKNOWN.
QUARTERLY_SQL = f"""
    WITH shipped AS (SELECT *, %s AS shipped_at FROM lineitem),
         pairs AS (
             SELECT l_suppkey, l_partkey, {_quarters("shipped_at")} FROM shipped
             WHERE %s GROUP BY ALL),
         labelled AS (
             SELECT (SELECT s_name FROM supplier WHERE s_suppkey = l_suppkey) AS department,
                    (SELECT p_brand FROM part WHERE p_partkey = l_partkey) AS job,
                    "Q1", "Q2", "Q3", "Q4"
             FROM pairs)
    SELECT COALESCE(department, 'UNKNOWN') AS "DEPARTMENT", COALESCE(job, 'UNKNOWN') AS "JOB",
           SUM("Q1")::BIGINT AS "Q1", SUM("Q2")::BIGINT AS "Q2",
           SUM("Q3")::BIGINT AS "Q3", SUM("Q4")::BIGINT AS "Q4"
    FROM labelled GROUP BY department, job
"""
WHOLE_YEAR = ("l_shipdate", "shipped_at >= '1997-01-01' AND shipped_at < '1998-01-01'")
# Midnights are moved by an hour for each line, so that Dec 31 has times behind its first instant.
LITERAL_YEAR = (
    "l_shipdate + to_hours(l_linenumber::INT - 1)",
    "shipped_at >= '1997-01-01' AND shipped_at <= '1997-12-31'",
)

COUNTS_SQL = """
    SELECT s_suppkey AS "ID", s_name AS "DEPARTMENT", shipped AS "HIRED"
    FROM (SELECT l_suppkey, COUNT(l_orderkey) AS shipped FROM lineitem
          WHERE date_trunc('year', l_shipdate) = DATE '1997-01-01' GROUP BY l_suppkey)
    JOIN supplier ON s_suppkey = l_suppkey
"""
# The mean ranges over the departments that have any.
COMPARED_SQL = f"""
    SELECT "ID", "DEPARTMENT", "HIRED"
    FROM (SELECT *, AVG("HIRED") OVER () AS average FROM ({COUNTS_SQL}))
    WHERE "HIRED" > average OR %s
"""
ABOVE, ALL = "FALSE", "TRUE"


@check(QUARTERLY_SQL % WHOLE_YEAR)
def quarterly_counts(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "lineitem")
    return counts.quarterly_counts(
        fact, suppliers(spark, folder), parts(spark, folder), job_id="l_partkey", **SHIPPED
    )


@check(QUARTERLY_SQL % LITERAL_YEAR)
def quarterly_counts_literal(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "lineitem")
    hours = F.make_dt_interval(hours=(F.col("l_linenumber") - 1).cast("int"))
    fact = fact.withColumn("l_shipdate", F.col("l_shipdate") + hours)
    return counts.quarterly_counts_literal(
        fact, suppliers(spark, folder), parts(spark, folder), job_id="l_partkey", **SHIPPED
    )


@check(
    f"""
    WITH active AS (SELECT DISTINCT user_id, event_type FROM events),
         flags AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)
    SELECT COALESCE(event_type, 'UNKNOWN') AS "DEPARTMENT",
           COALESCE(l_returnflag, 'UNKNOWN') AS "JOB",
           {_quarters("o_orderdate")}
    FROM orders
    LEFT JOIN flags ON o_orderkey = l_orderkey
    LEFT JOIN active ON o_custkey = user_id
    WHERE year(o_orderdate) = 1997
    GROUP BY event_type, l_returnflag
    """
)
def quarterly_counts_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Most customers have no events and some orders no items; ids repeat in both dimensions."""
    active = table(spark, folder, "events").select("user_id", "event_type").distinct()
    flags = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag").distinct()
    return counts.quarterly_counts(
        table(spark, folder, "orders"),
        Dimension(active, "user_id", "event_type"),
        Dimension(flags, "l_orderkey", "l_returnflag"),
        ts="o_orderdate",
        department_id="o_custkey",
        job_id="o_orderkey",
        year=YEAR,
    )


@check(COUNTS_SQL)
def yearly_counts(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "lineitem")
    return counts.yearly_counts(fact, suppliers(spark, folder), row_id="l_orderkey", **SHIPPED)


@check(
    """
    SELECT c_custkey AS "ID", c_name AS "DEPARTMENT",
           COUNT(event_id) FILTER (WHERE year(ts) = 2024) AS "HIRED"
    FROM customer LEFT JOIN events ON c_custkey = user_id
    GROUP BY c_custkey, c_name
    """
)
def yearly_counts_with_empty_groups(spark: SparkSession, folder: str) -> DataFrame:
    return counts.yearly_counts(
        table(spark, folder, "events"),
        Dimension(table(spark, folder, "customer"), "c_custkey", "c_name"),
        ts="ts",
        department_id="user_id",
        row_id="event_id",
        year=2024,
        include_empty_groups=True,
    )


@check(COMPARED_SQL % ABOVE)
def groups_above_mean(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "lineitem")
    return counts.groups_above_mean(fact, suppliers(spark, folder), row_id="l_orderkey", **SHIPPED)


@check(COMPARED_SQL % ALL)
def groups_above_mean_literal(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "lineitem")
    return counts.groups_above_mean_literal(
        fact, suppliers(spark, folder), row_id="l_orderkey", **SHIPPED
    )


@check(
    'SELECT AVG("HIRED") AS mean_of_counts FROM '
    '(SELECT COUNT(*) AS "HIRED" FROM orders GROUP BY o_custkey)'
)
def global_mean(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return counts.mean_of_counts(orders.groupBy("o_custkey").agg(F.count("*").alias("HIRED")))


# --- filters, labels, counts ---------------------------------------------------------------------


@check(
    """
    SELECT event_type, COUNT(*) AS n FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-04' GROUP BY event_type
    """
)
def date_window(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    inside = events.filter(times.in_window(events, "ts", "2024-01-01", "2024-01-04"))
    return inside.groupBy("event_type").agg(F.count("*").alias("n"))


@check(
    """
    SELECT event_type, COUNT(*) AS n FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-03' GROUP BY event_type
    """
)
def date_window_literal(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    inside = events.filter(times.between_dates(events, "ts", "2024-01-01", "2024-01-03"))
    return inside.groupBy("event_type").agg(F.count("*").alias("n"))


@check(
    """
    SELECT COALESCE(CAST(quality AS VARCHAR), 'UNKNOWN') AS label, COUNT(*) AS n
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
    """
)
def label_default(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id")
    labels = table(spark, folder, "labels")
    label = counts.label_or_default(F.col("quality").cast("string"))
    joined = documents.join(labels, "doc_id", "left")
    return joined.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


@check("SELECT COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(*) AS n FROM lineitem")
def distinct_count(spark: SparkSession, folder: str) -> DataFrame:
    per_supplier = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n")
    )
    return per_supplier.agg(F.count("l_suppkey").alias("suppliers"), F.sum("n").alias("n"))


# --- merge ---------------------------------------------------------------------------------------

LOADED_BEFORE = "1998-01-01"


def _orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All orders with their status in lower case as the source, the older ones as the target."""
    orders = table(spark, folder, "orders")
    known = orders.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    columns = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"]
    source = orders.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return known.select(columns), source.select(columns)


ORDERS_SQL = """
    WITH target AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders
                    WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         source AS (SELECT o_orderkey, o_custkey, o_orderpriority,
                           lower(o_orderstatus) AS o_orderstatus FROM orders)
"""


@check(
    ORDERS_SQL
    + """
    SELECT * FROM target UNION ALL SELECT * FROM source s
    WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
    """
)
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _orders(spark, folder)
    return merge.insert_if_absent(source, target, ["o_orderkey"])


NULLED_SQL = (
    ORDERS_SQL
    + """
    , t AS (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END AS k, * FROM target),
      s AS (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END AS k, * FROM source)
    SELECT * FROM t UNION ALL SELECT * FROM s
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k)
    """
)


def _nulled(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    key = F.when(~urgent, F.col("o_orderkey"))
    return tuple(df.withColumn("k", key) for df in _orders(spark, folder))


@check(NULLED_SQL)
def insert_if_absent_null_keys_insert(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _nulled(spark, folder)
    return merge.insert_if_absent(source, target, ["k"], null_keys="insert")


@check(NULLED_SQL + " AND s.k IS NOT NULL")
def insert_if_absent_null_keys_reject(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _nulled(spark, folder)
    return merge.insert_if_absent(source, target, ["k"], null_keys="reject")


@check(
    ORDERS_SQL
    + """
    , two AS (SELECT *, 2 AS load FROM source
               UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, 'first', 1 FROM orders)
    SELECT * FROM target UNION ALL
    SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY load) AS place
        FROM two b
        WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = b.o_orderkey)
    ) WHERE place = 1
    """
)
def insert_if_absent_first(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _orders(spark, folder)
    first = source.withColumn("o_orderstatus", F.lit("first"))
    both = source.withColumn("load", F.lit(2)).unionByName(first.withColumn("load", F.lit(1)))
    return merge.insert_if_absent(
        both, target, ["o_orderkey"], source_duplicates="first", order_by=["load"]
    )


@check(
    """
    SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY l_returnflag
            ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS place
        FROM lineitem) WHERE place = 1
    """
)
def first_value_of_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Three keys over the whole table: each holds about a third of the rows."""
    columns = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    rows = table(spark, folder, "lineitem").select("l_returnflag", *columns)
    return merge.first_per_key(rows, ["l_returnflag"], columns)


# --- numbering and batches -----------------------------------------------------------------------


@check("SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey DESC) AS row_number FROM orders")
def row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "orders").select("o_orderkey")
    return numbering.number_rows(keys, [F.desc("o_orderkey")])


@check(
    """
    SELECT (place - 1) // 1000 AS batch_id, COUNT(*) AS records,
           COUNT(DISTINCT l_returnflag) AS flags
    FROM (SELECT l_returnflag, ROW_NUMBER() OVER (ORDER BY l_returnflag) AS place FROM lineitem)
    GROUP BY 1
    """
)
def batches_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered by a column of three values, so that each value spans many batches."""
    flags = table(spark, folder, "lineitem").select("l_returnflag")
    batched = numbering.assign_batches(numbering.number_rows(flags, ["l_returnflag"]), 1000)
    per_flag = batched.groupBy("batch_id", "l_returnflag").agg(F.count("*").alias("n"))
    return per_flag.groupBy("batch_id").agg(
        F.sum("n").alias("records"), F.count("l_returnflag").alias("flags")
    )


ARRIVAL_SQL = """
    SELECT (place - 1) // 1000 AS batch_id, COUNT(*) AS records
    FROM (SELECT ROW_NUMBER() OVER () AS place FROM lineitem) GROUP BY 1
"""


@check(ARRIVAL_SQL)
def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Any rows, numbered through a staged table."""
    keys = table(spark, folder, "lineitem").select("l_orderkey")
    return numbering.batch_counts(numbering.assign_batches(numbering.number_rows(keys), 1000))


@check(ARRIVAL_SQL)
def batch_counts_of_table(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table, numbered where it is."""
    numbered = numbering.number_table_rows(table(spark, folder, "lineitem"))
    return numbering.batch_counts(numbering.assign_batches(numbered, 1000))


@check("SELECT CAST(ceil(COUNT(*) / 1000) AS BIGINT) AS batches FROM lineitem")
def batch_total(spark: SparkSession, folder: str) -> DataFrame:
    return numbering.number_of_batches(table(spark, folder, "lineitem"), 1000)


@check(
    """
    SELECT COUNT(*) AS records, COUNT(DISTINCT o_orderkey) AS orders, TRUE AS within_cap
    FROM orders
    """
)
def batched_append(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "batched")
    layers.append_in_batches(table(spark, folder, "orders"), path, 1000)
    per_file = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n"), F.count("o_orderkey").alias("orders"))
    )
    return per_file.agg(
        F.sum("n").alias("records"),
        F.sum("orders").alias("orders"),
        (F.max("n") <= 1000).alias("within_cap"),
    )


# --- CSV, timestamps, JSON -----------------------------------------------------------------------

ORDER_CSV = StructType(
    [
        StructField("o_orderkey", LongType(), True),
        StructField("label", StringType(), True),
        StructField("o_custkey", LongType(), True),
    ]
)


@check(
    """
    SELECT o_orderkey, o_orderpriority || ', ' || o_orderstatus AS label, o_custkey FROM orders
    """
)
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "csv")
    label = F.concat_ws(", ", "o_orderpriority", "o_orderstatus").alias("label")
    table(spark, folder, "orders").select("o_orderkey", label, "o_custkey").write.csv(path)
    return csvs.read_csv(spark, path, ORDER_CSV)


def _spoiled_lines(orders: DataFrame) -> DataFrame:
    """Orders as CSV lines, some of them spoiled by their priority."""
    priority = F.col("o_orderpriority")
    key = F.when(priority == "1-URGENT", F.concat(F.lit("x"), "o_orderkey")).otherwise(
        F.col("o_orderkey").cast("string")
    )
    rest = (
        F.when(priority == "5-LOW", F.col("o_orderstatus"))
        .when(priority == "2-HIGH", F.concat_ws(",", "o_orderstatus", "o_custkey", F.lit("more")))
        .otherwise(F.concat_ws(",", "o_orderstatus", "o_custkey"))
    )
    return orders.select(F.concat_ws(",", key, rest).alias("value"))


SPOILED_SQL = """
    SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END AS o_orderkey,
           o_orderstatus AS label,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey,
           CASE o_orderpriority
               WHEN '1-URGENT' THEN 'x' || o_orderkey || ',' || o_orderstatus || ',' || o_custkey
               WHEN '2-HIGH' THEN o_orderkey || ',' || o_orderstatus || ',' || o_custkey || ',more'
               WHEN '5-LOW' THEN o_orderkey || ',' || o_orderstatus
           END AS corrupt_record
    FROM orders
"""


@check(SPOILED_SQL)
def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "csv")
    _spoiled_lines(table(spark, folder, "orders")).write.text(path)
    return csvs.read_csv(spark, path, ORDER_CSV, corrupt_column=csvs.CORRUPT)


@check(SPOILED_SQL)
def csv_parse(spark: SparkSession, folder: str) -> DataFrame:
    lines = _spoiled_lines(table(spark, folder, "orders"))
    record = csvs.parse_csv_column("value", ORDER_CSV, corrupt_column=csvs.CORRUPT)
    return lines.select(record.alias("record")).select("record.*")


@check(
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS ordered
    FROM orders
    """
)
def parse_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    priority, date = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(priority == "1-URGENT", F.date_format(date, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(priority == "5-LOW", F.lit("not a time"))
        .otherwise(F.date_format(date, "yyyy-MM-dd HH:mm:ss.SSS"))
    )
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", times.parse_timestamp(text).alias("ordered"))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("SEGMENT")
    customer = table(spark, folder, "customer")
    return customer.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("NAME"), segment)


@check(
    """
    SELECT CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN to_json({'ID': c_custkey, 'NAME': c_name})
                ELSE to_json({'ID': c_custkey, 'NAME': c_name, 'SEGMENT': c_mktsegment})
                END AS VARCHAR) AS json
    FROM customer
    """
)
def json_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.json_records(_segments(spark, folder))


@check(
    """
    SELECT CAST(to_json({'ID': c_custkey, 'NAME': c_name,
                         'SEGMENT': NULLIF(c_mktsegment, 'BUILDING')}) AS VARCHAR) AS json
    FROM customer
    """
)
def json_records_keep_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return records.json_records(_segments(spark, folder), keep_nulls=True)


@check(
    "SELECT CAST(to_json({'ID': \"ID\", 'DEPARTMENT': \"DEPARTMENT\", 'HIRED': \"HIRED\"}) "
    f"AS VARCHAR) AS json FROM ({COMPARED_SQL % ABOVE})"
)
def report_as_json(spark: SparkSession, folder: str) -> DataFrame:
    return records.json_records(groups_above_mean(spark, folder))


# --- loads and the whole pipeline ----------------------------------------------------------------

# The same three tables with long ids; an item's key has two columns.
ITEM = Entity(
    "hired_employee",
    StructType(
        [
            StructField("ID", LongType(), True),
            StructField("LINE", IntegerType(), True),
            StructField("DATETIME", StringType(), True),
            StructField("DEPARTMENT_ID", LongType(), True),
            StructField("JOB_ID", LongType(), True),
        ]
    ),
    keys=("ID", "LINE"),
    timestamps=("DATETIME",),
    year_of="DATETIME",
)
SUPPLIER = Entity(
    "department",
    StructType(
        [StructField("ID", LongType(), True), StructField("DEPARTMENT", StringType(), True)]
    ),
)
PART = Entity(
    "job",
    StructType([StructField("ID", LongType(), True), StructField("JOB", StringType(), True)]),
)
TABLES = {e.name: e for e in (ITEM, SUPPLIER, PART)}


def _item_time() -> Column:
    return F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _csv_sources(
    spark: SparkSession, folder: str, base: str, spoil_times: bool
) -> dict[str, str]:
    """Items, suppliers and parts as headerless CSV files."""
    time = _item_time()
    if spoil_times:
        time = F.when(F.col("l_tax") == 0.08, F.lit("not a time")).otherwise(time)
    paths = {name: f"{base}/source/{name}.csv" for name in TABLES}
    table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", time, "l_suppkey", "l_partkey"
    ).write.csv(paths["hired_employee"])
    table(spark, folder, "supplier").select("s_suppkey", "s_name").write.csv(paths["department"])
    table(spark, folder, "part").select("p_partkey", "p_brand").write.csv(paths["job"])
    return paths


@check(
    """
    WITH facts AS (
        SELECT 'hired_employee' AS entity, COUNT(*) AS rows_read,
               COUNT(*) FILTER (WHERE l_tax = 0.08) AS rows_quarantined,
               COUNT(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE l_tax <> 0.08) AS fresh
        FROM lineitem
        UNION ALL SELECT 'department', COUNT(*), 0, COUNT(DISTINCT s_suppkey) FROM supplier
        UNION ALL SELECT 'job', COUNT(*), 0, COUNT(DISTINCT p_partkey) FROM part
    )
    SELECT attempt, entity, 'OK' AS status, rows_read, rows_quarantined, rows_read AS rows_raw,
           TRUE AS batches_bounded,
           CASE attempt WHEN 'second' THEN 0 ELSE fresh END AS rows_trusted
    FROM facts, (VALUES ('first'), ('repeated'), ('second')) attempts(attempt)
    """
)
def load_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """A load, the same load run again, and a second load of the same files."""
    base = new_shared_path(spark, "layers")
    sources = _csv_sources(spark, folder, base, spoil_times=True)
    outcomes = None
    for attempt, load_id in (("first", "a"), ("repeated", "a"), ("second", "b")):
        for name, entity in TABLES.items():
            outcome = loads.load_entity(
                spark,
                entity,
                sources[name],
                base,
                load_id=load_id,
                max_records=10_000,
                on_error="raise",
            ).withColumn("attempt", F.lit(attempt))
            outcomes = outcome if outcomes is None else outcomes.unionByName(outcome)
    return outcomes.select(
        (F.col("batches") * 10_000 >= F.col("rows_raw")).alias("batches_bounded"),
        "attempt",
        "entity",
        "status",
        "rows_read",
        "rows_quarantined",
        "rows_raw",
        "rows_trusted",
    )


def _loaded(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    base = new_shared_path(spark, "layers")
    sources = _csv_sources(spark, folder, base, spoil_times=False)
    return loads.run_pipeline(
        spark,
        sources,
        base,
        year=YEAR,
        entities=TABLES,
        source_duplicates="keep",
        on_error="raise",
    )


@check(QUARTERLY_SQL % WHOLE_YEAR)
def loaded_quarterly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder)["hires_by_quarter"]


@check(COMPARED_SQL % ABOVE)
def loaded_groups_above_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder)["departments_above_mean"]


def _lines_of(spark: SparkSession, folder: str, base: str, returned: bool) -> str:
    """The returned items, or the others, as a CSV file in order of date and supplier."""
    chosen = (F.col("l_returnflag") == "R") == returned
    path = f"{base}/source/{'returned' if returned else 'others'}.csv"
    time = _item_time()
    table(spark, folder, "lineitem").filter(chosen).select(
        "l_orderkey", "l_linenumber", time, "l_suppkey", "l_partkey"
    ).write.csv(path)
    return path


@check(
    """
    SELECT step, COUNT(*) FILTER (WHERE wanted) AS rows,
           COUNT(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE wanted) AS keys
    FROM (SELECT step, l_orderkey, l_linenumber,
                 step IN ('whole', 'rerun') OR (step = 'failed rerun' AND l_returnflag = 'R') AS wanted
          FROM lineitem, (VALUES ('stopped'), ('whole'), ('rerun'), ('failed rerun')) steps(step))
    GROUP BY step
    """
)
def reloaded_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What reports can see after a load that stopped, a merge of all loads, and reruns of both.

    ids descend, so order by id isn't order of arrival."""
    base = new_shared_path(spark, "layers")
    returned, others = (_lines_of(spark, folder, base, r) for r in (True, False))
    keep = {"source_duplicates": "keep", "on_error": "raise"}

    def seen(step):
        rows = layers.read_layer(spark, base, layers.TRUSTED, ITEM.name, ITEM.trusted_table_schema)
        return staged(
            rows.agg(F.count("*").alias("rows"), F.count_distinct("ID", "LINE").alias("keys")).select(
                F.lit(step).alias("step"), "*"
            )
        )

    loads.write_raw(spark, ITEM, returned, base, "z")  # stops before the merge
    steps = [seen("stopped")]
    loads.load_entity(spark, ITEM, others, base, load_id="y", whole_raw=True, **keep)
    steps.append(seen("whole"))
    loads.load_entity(spark, ITEM, others, base, load_id="y", whole_raw=True, **keep)
    loads.load_entity(spark, ITEM, returned, base, load_id="z", **keep)
    steps.append(seen("rerun"))
    bad = f"{base}/source/bad.csv"
    spark.range(1).selectExpr("'x,y,z,u,v' AS value").write.text(bad)
    outcome = loads.load_entity(spark, ITEM, bad, base, load_id="y", whole_raw=True, mode="FAILFAST")
    raw = layers.read_layer(spark, base, layers.RAW, ITEM.name, ITEM.raw_table_schema, "z")
    failed = raw.agg(F.count("*").alias("rows"), F.count_distinct("ID", "LINE").alias("keys"))
    if outcome.first().status == "ERROR":
        steps.append(failed.select(F.lit("failed rerun").alias("step"), "*"))
    made = steps[0]
    for step in steps[1:]:
        made = made.unionByName(step)
    return made


@check(
    """
    SELECT l_orderkey AS "ID", l_linenumber AS "LINE", bool_or(l_returnflag = 'R') AS returned
    FROM lineitem GROUP BY l_orderkey, l_linenumber
    """
)
def first_of_all_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Of keys in both loads the row of the earlier load enters, although its id is the larger."""
    base = new_shared_path(spark, "layers")
    for load_id, returned in (("z", True), ("b", False)):
        path = _lines_of(spark, folder, base, returned)
        loads.write_raw(spark, ITEM, path, base, load_id)
    loads.merge_into_trusted(spark, ITEM, base, "b", whole_raw=True)
    rows = layers.read_layer(spark, base, layers.TRUSTED, ITEM.name, ITEM.trusted_table_schema)
    items = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    marks = items.select(
        F.col("l_orderkey").alias("ID"),
        F.col("l_linenumber").alias("LINE"),
        F.col("l_suppkey").alias("DEPARTMENT_ID"),
        F.col("l_partkey").alias("JOB_ID"),
        F.lit(True).alias("returned"),
    ).distinct()
    return rows.join(marks, ["ID", "LINE", "DEPARTMENT_ID", "JOB_ID"], "left").select(
        "ID", "LINE", F.coalesce("returned", F.lit(False)).alias("returned")
    )


@check(
    """
    SELECT DISTINCT ON (l_orderkey, l_linenumber)
           l_orderkey AS "ID", l_linenumber AS "LINE", l_shipdate AS "DATETIME",
           l_suppkey AS "DEPARTMENT_ID", l_partkey AS "JOB_ID"
    FROM lineitem WHERE l_tax <> 0.08
    ORDER BY l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_partkey
    """
)
def trusted_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What enters under the default policies: of a key's rows the first in the file that is no bad
    one. The file is in order of date, supplier and part."""
    base = new_shared_path(spark, "layers")
    path = f"{base}/source/items.csv"
    time = F.when(F.col("l_tax") == 0.08, F.lit("not a time")).otherwise(_item_time())
    table(spark, folder, "lineitem").orderBy("l_shipdate", "l_suppkey", "l_partkey").select(
        "l_orderkey", "l_linenumber", time, "l_suppkey", "l_partkey"
    ).write.csv(path)
    loads.load_entity(spark, ITEM, path, base, on_error="raise")
    rows = layers.read_layer(spark, base, layers.TRUSTED, ITEM.name, ITEM.trusted_table_schema)
    return rows.select("ID", "LINE", "DATETIME", "DEPARTMENT_ID", "JOB_ID")


@check(
    """
    SELECT CASE l_tax WHEN 0.08 THEN 'malformed' WHEN 0.07 THEN 'bad timestamp'
           ELSE 'null key' END AS reject_reason,
           COUNT(*) AS rows, SUM(l_suppkey)::BIGINT AS suppliers
    FROM lineitem WHERE l_tax IN (0.06, 0.07, 0.08) GROUP BY ALL
    """
)
def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that a load sets aside, by reason."""
    base = new_shared_path(spark, "layers")
    path, tax = f"{base}/source/items.csv", F.col("l_tax")
    table(spark, folder, "lineitem").select(
        F.when(tax != 0.06, F.col("l_orderkey")),
        F.when(tax == 0.08, F.lit("x")).otherwise(F.col("l_linenumber").cast("string")),
        F.when(tax == 0.07, F.lit("not a time")).otherwise(_item_time()),
        "l_suppkey",
        "l_partkey",
    ).write.csv(path)
    loads.load_entity(spark, ITEM, path, base, on_error="raise")
    return loads.quarantine(spark, base, ITEM).groupBy("reject_reason").agg(
        F.count("*").alias("rows"), F.sum("DEPARTMENT_ID").alias("suppliers")
    )


@check(
    """
    SELECT entity, status, rows_read, rows_trusted, report
    FROM (SELECT 'hired_employee' AS entity, 'OK' AS status, COUNT(*) AS rows_read,
                 COUNT(DISTINCT (l_orderkey, l_linenumber)) AS rows_trusted FROM lineitem
          UNION ALL VALUES ('department', 'MISSING', 0, 0), ('job', 'EMPTY', 0, 0)),
         (SELECT CASE WHEN bool_or(year(l_shipdate) = 1900) THEN 'OK' ELSE 'EMPTY' END AS report
          FROM lineitem)
    """
)
def load_status(spark: SparkSession, folder: str) -> DataFrame:
    """Loads of a source with rows, of none and of an empty one; a report of a year without rows."""
    base = new_shared_path(spark, "layers")
    sources = _csv_sources(spark, folder, base, spoil_times=False)
    sources["department"] = f"{base}/source/none.csv"
    sources["job"] = f"{base}/source/blank.csv"
    table(spark, folder, "part").filter("p_partkey is null").select("p_partkey").write.csv(
        sources["job"]
    )
    outcomes = loads.run_pipeline(spark, sources, base, entities=TABLES)["outcomes"]
    report = reports.hires_by_quarter(spark, base, year=1900, entities=TABLES)
    return outcomes.select(
        "entity",
        "status",
        "rows_read",
        "rows_trusted",
        F.lit(reports.report_status(report)).alias("report"),
    )


@check(QUARTERLY_SQL % WHOLE_YEAR)
def raw_layer_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report over rows that were loaded but not merged."""
    base = new_shared_path(spark, "layers")
    for name, path in _csv_sources(spark, folder, base, spoil_times=False).items():
        loads.write_raw(spark, TABLES[name], path, base, "a")
    return reports.hires_by_quarter(spark, base, year=YEAR, layer="raw", entities=TABLES)


@check(
    f"""
    SELECT COALESCE(c_name, 'UNKNOWN') AS "DEPARTMENT", COALESCE(r_name, 'UNKNOWN') AS "JOB",
           {_quarters("o_orderdate")}
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN region ON r_regionkey = substr(o_orderpriority, 1, 1)::INT
    WHERE year(o_orderdate) = 1997 GROUP BY c_name, r_name
    """
)
def fixed_entities_report(spark: SparkSession, folder: str) -> DataFrame:
    """The three entities as they are: orders as hires, customers as departments, regions as jobs
    (the fifth priority has none)."""
    base = new_shared_path(spark, "layers")
    sources = {n: f"{base}/source/{n}.csv" for n in ("hired_employee", "department", "job")}
    table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "o_custkey",
        F.substring("o_orderpriority", 1, 1),
    ).write.csv(sources["hired_employee"])
    table(spark, folder, "customer").select("c_custkey", "c_name").write.csv(sources["department"])
    table(spark, folder, "region").select("r_regionkey", "r_name").write.csv(sources["job"])
    return loads.run_pipeline(spark, sources, base, year=YEAR, on_error="raise")["hires_by_quarter"]


@check(
    """
    SELECT c_nationkey AS nation, COUNT(*) AS customers FROM customer GROUP BY c_nationkey
    """
)
def statement_on_views(spark: SparkSession, folder: str) -> DataFrame:
    """A statement of one's own on the views of a layer."""
    base = new_shared_path(spark, "layers")
    path = f"{base}/source/customers.csv"
    table(spark, folder, "customer").select("c_custkey", "c_nationkey").write.csv(path)
    loads.load_entity(spark, SUPPLIER, path, base, on_error="raise")
    (view,) = reports.create_views(spark, base, entities={"department": SUPPLIER})
    return spark.sql(
        f"SELECT CAST(DEPARTMENT AS BIGINT) AS nation, COUNT(*) AS customers FROM {view} GROUP BY 1"
    )


# --- formats found from the data -----------------------------------------------------------------


@check("SELECT o_orderkey, o_orderdate AS ordered FROM orders")
def detected_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """All order dates in four formats; those with a day above 12 decide how the others are read."""
    priority, date = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(priority == "1-URGENT", F.date_format(date, "M/d/yyyy"))
        .when(priority == "2-HIGH", F.date_format(date, "dd.MM.yyyy HH:mm:ss"))
        .when(priority == "3-MEDIUM", F.unix_timestamp(date).cast("string"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(date, "EEE, dd MMM yyyy HH:mm:ss"))
        .otherwise(F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    found = formats.detect(orders, "text")
    return orders.select("o_orderkey", formats.read_detected("text", found).alias("ordered"))


DETECTED_ITEM = replace(ITEM, formats=(("DATETIME", DETECT),))


@check(
    """
    WITH loads AS (
        SELECT 'low' AS load_id, 'AMBIGUOUS' AS status, COUNT(*) AS rows_read, 0 AS rows_trusted
        FROM lineitem WHERE day(l_shipdate) <= 12
        UNION ALL
        SELECT 'high', 'OK', COUNT(*), COUNT(DISTINCT (l_orderkey, l_linenumber))
        FROM lineitem WHERE day(l_shipdate) > 12),
    again AS (
        SELECT 'low again' AS load_id, 'OK' AS status, COUNT(*) AS rows_read,
               COUNT(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE (l_orderkey, l_linenumber) NOT IN (
                   SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE day(l_shipdate) > 12)) AS rows_trusted
        FROM lineitem WHERE day(l_shipdate) <= 12),
    total AS (
        SELECT SUM(day(first_shipped))::BIGINT AS days FROM (
            SELECT coalesce(min(l_shipdate) FILTER (WHERE day(l_shipdate) > 12),
                            min(l_shipdate)) AS first_shipped
            FROM lineitem GROUP BY l_orderkey, l_linenumber))
    SELECT load_id, status, rows_read, rows_trusted, days
    FROM (SELECT * FROM loads UNION ALL SELECT * FROM again), total
    """
)
def detected_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Items of days up to 12 alone leave the order of day and month open; after a load of the others it
    is known, and the same file enters."""
    base = new_shared_path(spark, "layers")
    items = table(spark, folder, "lineitem").orderBy("l_shipdate")
    time = F.date_format("l_shipdate", "d/M/yyyy")
    outcomes = []
    for load_id, of_load in (("low", "low"), ("high", "high"), ("low again", "low_again")):
        path = f"{base}/source/{load_id.split()[0]}.csv"
        if load_id != "low again":
            days = F.dayofmonth("l_shipdate") <= 12
            items.filter(days if load_id == "low" else ~days).select(
                "l_orderkey", "l_linenumber", time, "l_suppkey", "l_partkey"
            ).write.csv(path)
        outcome = loads.load_entity(spark, DETECTED_ITEM, path, base, load_id=of_load, on_error="raise")
        outcomes.append(outcome.withColumn("load_id", F.lit(load_id)))
    rows = layers.read_layer(spark, base, layers.TRUSTED, ITEM.name, ITEM.trusted_table_schema)
    days = rows.agg(F.sum(F.dayofmonth("DATETIME")).alias("days"))
    made = reduce(DataFrame.unionByName, outcomes).crossJoin(F.broadcast(days))
    return made.select("load_id", "status", "rows_read", "rows_trusted", "days")


# --- statements that write, tables laid out by key -----------------------------------------------


INSERT_ABSENT = """
    INSERT INTO TRUSTED.DEPARTMENT (ID, DEPARTMENT)
    SELECT r.ID, r.DEPARTMENT FROM RAW.DEPARTMENT AS r
    WHERE r.reject_reason IS NULL
      AND NOT EXISTS (SELECT 1 FROM TRUSTED.DEPARTMENT AS t WHERE t.ID = r.ID)
"""


@check(
    """
    SELECT step, COUNT(*) FILTER (WHERE there) AS orders,
           COUNT(*) FILTER (WHERE there AND label = 'old') AS old,
           coalesce(SUM(o_orderkey) FILTER (WHERE there), 0)::BIGINT AS keys
    FROM (SELECT step, o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'old' ELSE 'new' END AS label,
                 step = 'second' OR (step IN ('first', 'failed') AND o_orderdate < TIMESTAMP '1998-01-01') AS there
          FROM orders, (VALUES ('first'), ('failed'), ('second')) steps(step))
    GROUP BY step
    """
)
def statement_insert(spark: SparkSession, folder: str) -> DataFrame:
    """Older orders by a statement, then all orders: once by a statement that fails on its way, then by the
    same statement as at first. What readers see after each."""
    base = new_shared_path(spark, "layers")
    entities = {"department": SUPPLIER}
    orders = table(spark, folder, "orders")
    old = orders.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))

    def seen(step: str) -> DataFrame:
        rows = layers.read_layer(spark, base, layers.TRUSTED, SUPPLIER.name, SUPPLIER.trusted_table_schema)
        return staged(
            rows.agg(
                F.count("*").alias("orders"),
                F.count_if(F.col("DEPARTMENT") == "old").alias("old"),
                F.coalesce(F.sum("ID"), F.lit(0)).alias("keys"),
            ).select(F.lit(step).alias("step"), "*")
        )

    def received(load_id: str, rows: DataFrame, label: str) -> None:
        path = f"{base}/source/{load_id}.csv"
        rows.select("o_orderkey", F.lit(label)).write.csv(path)
        loads.write_raw(spark, SUPPLIER, path, base, load_id)

    received("old", old, "old")
    statements.run_statement(spark, base, INSERT_ABSENT, entities=entities)
    steps = [seen("first")]
    received("all", orders, "new")
    # No label is a number.
    failing = INSERT_ABSENT.replace("r.DEPARTMENT FROM", "CAST(r.DEPARTMENT || r.ID AS BIGINT) FROM")
    try:
        statements.run_statement(spark, base, failing, entities=entities)
    except Exception as error:
        if "CAST_INVALID_INPUT" in str(error):
            steps.append(seen("failed"))
    statements.run_statement(spark, base, INSERT_ABSENT, entities=entities)
    steps.append(seen("second"))
    return reduce(DataFrame.unionByName, steps)


@check(
    """
    SELECT o_orderkey AS "ID",
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderstatus
                ELSE lower(o_orderstatus) END AS "DEPARTMENT"
    FROM orders
    """
)
def insert_if_absent_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads into a table laid out by key: older orders, then all of them changed; the second once more."""
    base = new_shared_path(spark, "layers")
    entity = replace(SUPPLIER, buckets=8)
    target, source = _orders(spark, folder)
    for load_id, rows in (("a", target), ("b", source), ("b", None)):
        path = f"{base}/source/{load_id}.csv"
        if rows is not None:
            rows.select("o_orderkey", "o_orderstatus").write.csv(path)
        loads.load_entity(spark, entity, path, base, load_id=load_id, on_error="raise")
    with catalogue.registered(spark, base, layers.TRUSTED, entity) as name:
        return staged(spark.table(name).select("ID", "DEPARTMENT"))


# --- append that goes on, reports from kept counts -----------------------------------------------


@check(
    """
    SELECT o_orderkey, o_custkey, o_orderpriority,
           CAST(ceil(n / (10 * (n // 100))) AS INT) AS ranges
    FROM orders, (SELECT COUNT(*) AS n FROM orders)
    """
)
def resumed_append(spark: SparkSession, folder: str) -> DataFrame:
    """All orders, of which a first run commits three ranges and stops; the next writes the others."""
    path, orders = new_shared_path(spark, "resumed"), table(spark, folder, "orders")
    batch = max(1, orders.count() // 100)
    options = {"batch_rows": batch, "batches_per_commit": 10}
    first = appends.append_resumably(orders, path, commits=3, **options)
    rest = appends.append_resumably(orders, path, **options)
    last = appends.append_resumably(orders, path, **options)
    ranges = first.unionByName(rest).unionByName(last).select("first_row", "last_row").distinct()
    rows = appends.read_appended(spark, path, orders.schema)
    return rows.select("o_orderkey", "o_custkey", "o_orderpriority").crossJoin(
        F.broadcast(ranges.agg(F.count("*").cast("int").alias("ranges")))
    )


COUNTED_ITEM = replace(ITEM, counted_by=("DEPARTMENT_ID", "JOB_ID"))


def _counted_loads(spark: SparkSession, folder: str) -> str:
    """Items in three loads, of which one first brought those of another, and dimensions."""
    base = new_shared_path(spark, "layers")
    sources = _csv_sources(spark, folder, base, spoil_times=False)
    items = table(spark, folder, "lineitem")
    for k in range(3):
        items.filter(F.col("l_orderkey") % 3 == k).select(
            "l_orderkey", "l_linenumber", _item_time(), "l_suppkey", "l_partkey"
        ).write.csv(f"{base}/source/{k}.csv")
    keep = {"source_duplicates": "keep", "on_error": "raise"}
    for load_id, k in (("a", 0), ("b", 2), ("b", 1), ("c", 2)):
        loads.load_entity(spark, COUNTED_ITEM, f"{base}/source/{k}.csv", base, load_id=load_id, **keep)
    for entity in (SUPPLIER, PART):
        loads.load_entity(spark, entity, sources[entity.name], base, **keep)
    return base


@check(QUARTERLY_SQL % WHOLE_YEAR)
def incremental_quarterly_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The report from counts kept with three loads, one of them run again with other rows."""
    base = _counted_loads(spark, folder)
    entities = {**TABLES, "hired_employee": COUNTED_ITEM}
    return reports.hires_by_quarter(spark, base, year=YEAR, entities=entities)


@check(COMPARED_SQL % ABOVE)
def incremental_groups_above_mean(spark: SparkSession, folder: str) -> DataFrame:
    base = _counted_loads(spark, folder)
    entities = {**TABLES, "hired_employee": COUNTED_ITEM}
    return reports.departments_above_mean(spark, base, year=YEAR, entities=entities)


# --- order that outlives the sink ----------------------------------------------------------------


@check(
    f"""
    SELECT ROW_NUMBER() OVER (ORDER BY "HIRED" DESC, "ID") AS place, rank, "ID", "HIRED"
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY "HIRED" DESC, "ID") AS rank FROM ({COMPARED_SQL % ALL}))
    """
)
def ordered_report(spark: SparkSession, folder: str) -> DataFrame:
    """A report as written: the place of each row is that in the files, in order of their names."""
    path = new_shared_path(spark, "ordered")
    report = groups_above_mean_literal(spark, folder)
    records.write_ordered(report, path, [F.desc("HIRED"), "ID"], format="parquet")
    placed = numbering.number_table_rows(spark.read.parquet(path), "place")
    return placed.select("place", "rank", "ID", "HIRED")


@check(
    """
    SELECT ROW_NUMBER() OVER (ORDER BY l_shipdate, l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS rank,
           l_shipdate, l_suppkey FROM lineitem
    """
)
def ordered_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a whole table, written by all tasks; ranks by file and place are those in the rows."""
    path = new_shared_path(spark, "ordered")
    columns = ["l_shipdate", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    records.write_ordered(table(spark, folder, "lineitem").select(columns), path, columns, "own", "parquet")
    placed = numbering.number_table_rows(spark.read.parquet(path), "rank")
    return placed.filter("rank = own").select("rank", "l_shipdate", "l_suppkey")


# --- packed layers, numbers over loads -----------------------------------------------------------

# Rows that meet in one task where the check of the numbers compares them.
ROWS_A_TASK = 1 << 18


def _third(spark: SparkSession, folder: str, base: str, k: int) -> str:
    """A third of the items, by order, as a CSV file in order of date and key."""
    path = f"{base}/source/{k}.csv"
    items = table(spark, folder, "lineitem").filter(F.col("l_orderkey") % 3 == k)
    items.orderBy("l_shipdate", "l_orderkey", "l_linenumber").select(
        "l_orderkey", "l_linenumber", _item_time(), "l_suppkey", "l_partkey"
    ).write.csv(path)
    return path


@check(
    """
    SELECT l_orderkey AS "ID", l_linenumber AS "LINE", l_shipdate AS "DATETIME",
           l_suppkey AS "DEPARTMENT_ID", l_partkey AS "JOB_ID", TRUE AS fewer
    FROM lineitem
    """
)
def compacted_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads of small files, packed before the last of them is run again, and packed again."""
    base = new_shared_path(spark, "layers")
    paths = [_third(spark, folder, base, k) for k in range(3)]
    keep = {"source_duplicates": "keep", "on_error": "raise"}
    before = 0

    def rows() -> DataFrame:
        return layers.read_layer(spark, base, layers.TRUSTED, ITEM.name, ITEM.trusted_table_schema)

    for k, path in enumerate(paths):
        loads.load_entity(spark, ITEM, path, base, load_id=f"l{k}", **keep)
        before += len(rows().inputFiles())
    compaction.compact(spark, base, layers.TRUSTED, ITEM)
    loads.load_entity(spark, ITEM, paths[2], base, load_id="l2", **keep)
    compaction.compact(spark, base, layers.TRUSTED, ITEM)
    layers.drop_unpublished(spark, base, layers.TRUSTED, ITEM.name)
    fewer = F.lit(len(rows().inputFiles()) < before)
    return rows().select(*ITEM.schema.names, fewer.alias("fewer"))


@check(
    """
    WITH counted AS (SELECT l_orderkey % 3 AS k, COUNT(*) AS n FROM lineitem GROUP BY 1)
    SELECT 'l' || k AS load_id, SUM(n) OVER (ORDER BY k)::BIGINT - n + 1 AS first_number,
           SUM(n) OVER (ORDER BY k)::BIGINT AS last_number, n AS numbers, n AS rows, 0 AS out_of_order
    FROM counted
    """
)
def numbers_across_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads, of which the first is run again last: numbers dense over all, in order of arrival."""
    base = new_shared_path(spark, "layers")
    paths = [_third(spark, folder, base, k) for k in range(3)]
    for k in (0, 1, 2, 0):
        loads.write_raw(spark, ITEM, paths[k], base, f"l{k}")
    return _numbers_of_loads(numbers.number_loads(spark, base, ITEM), sum(numbers.load_rows(spark, base, ITEM).values()))


def _numbers_of_loads(rows: DataFrame, n: int) -> DataFrame:
    """Range, numbers and rows of each load, and how often a row is before the one before it in its file.

    Rows meet by stretches of numbers, a bounded number of them in a task however large a file is; of a file's
    stretches the last row of one is compared with the first of the next. Numbers are counted as bits of their stretch."""
    number, tasks = F.col("row_number"), -(-n // ROWS_A_TASK)
    stretches = rows.select("load_id", "source_file", "DATETIME", number, F.bitmap_bucket_number(number).alias("stretch"))
    stretches = stretches.repartition(max(1, tasks), "load_id", "stretch")
    in_stretch = Window.partitionBy("load_id", "stretch", "source_file").orderBy("row_number")
    back = (F.col("DATETIME") < F.lag("DATETIME").over(in_stretch)).cast("int")
    parts = stretches.withColumn("back", back).groupBy("load_id", "stretch", "source_file").agg(
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.count("*").alias("rows"),
        F.sum("back").alias("back"),
        F.min_by("DATETIME", number).alias("first"),
        F.max_by("DATETIME", number).alias("last"),
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"),
    )
    per_file = Window.partitionBy("load_id", "source_file").orderBy("stretch")
    between = (F.col("first") < F.lag("last").over(per_file)).cast("int")
    met = parts.withColumn("between", between).groupBy("load_id", "stretch").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("rows").alias("rows"),
        (F.coalesce(F.sum("back"), F.lit(0)) + F.coalesce(F.sum("between"), F.lit(0))).alias("back"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("numbers"),
    )
    return met.groupBy("load_id").agg(
        F.min("low").alias("first_number"),
        F.max("high").alias("last_number"),
        F.sum("numbers").alias("numbers"),
        F.sum("rows").alias("rows"),
        F.sum("back").cast("int").alias("out_of_order"),
    )
