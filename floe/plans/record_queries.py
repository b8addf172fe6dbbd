"""Queries over orders / lineitem / customer / events: profit summaries, URL
templates, validated parsing, JSON envelopes and nested defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from floe.functions import json as J
from floe.functions.parse import parse_delimited, parse_lines, parse_numbers, parse_prices, parse_sales, parse_ticks
from floe.functions.time import instant_to_ntz, ntz_micros, ntz_seconds
from floe.functions.urls import fill_template
from floe.operators.envelopes import first_pages, pack_envelopes
from floe.operators.aggregates import sum_of
from floe.operators.profit import keyed_profit
from floe.operators.windows import windowed
from floe.plans.registry import query
from floe.schemas import CLICKS, MATCH, MATCH_TREE, fill_defaults
from floe.session import scratch_path
from floe.sources.delimited import read_points
from floe.sources.tables import read_table
from floe.sources.text import read_lines, read_whole_files
from floe.streaming.sinks import tuple_text, write_delimited, write_text

# ---- per-month profit ---------------------------------------------------------


@query(
    "month_profit",
    headline=True,
    oracle="""
    SELECT monthname(o_orderdate) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS profit,
           count(*) AS n,
           arg_min(o_orderpriority, o_orderkey) AS first_priority,
           CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS DOUBLE) / count(*) AS avg_profit
    FROM orders GROUP BY 1
    """,
)
def q_month_profit(spark, sf_dir):
    orders = read_table(
        spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    )
    out = keyed_profit(
        orders,
        key=F.date_format("o_orderdate", "MMMM"),
        amount=F.col("o_totalprice"),
        carry=F.col("o_orderpriority"),
        carry_order=F.col("o_orderkey"),
    )
    return out.select(
        F.col("key").alias("month"), "profit", "n", F.col("carried").alias("first_priority"), "avg_profit"
    )


@query(
    "month_profit_two_carried",
    oracle="""
    SELECT monthname(o_orderdate) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS profit,
           arg_min(o_orderpriority, o_orderkey) AS first_priority, arg_min(o_orderstatus, o_orderkey) AS first_status
    FROM orders GROUP BY 1
    """,
)
def q_month_profit_two_carried(spark, sf_dir):
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"]
    out = keyed_profit(
        read_table(spark, sf_dir, "orders", columns),
        key=F.date_format("o_orderdate", "MMMM"),
        amount=F.col("o_totalprice"),
        carry=F.struct("o_orderpriority", "o_orderstatus"),
        carry_order=F.col("o_orderkey"),
    )
    return out.select(
        F.col("key").alias("month"),
        "profit",
        F.col("carried.o_orderpriority").alias("first_priority"),
        F.col("carried.o_orderstatus").alias("first_status"),
    )


# ---- URL templates ------------------------------------------------------------------

# Placeholder names and the default time zone of the requests.
DEFAULT_TIME_ZONE = "Europe/Rome"
MATCH_BY_ID_TEMPLATE = "https://api.example.org/fixtures?id=${id}&timezone=${timezone}"
MATCHES_BY_DATE_TEMPLATE = "https://api.example.org/fixtures?date=${date}&timezone=${timezone}"


@query(
    "url_template",
    oracle=f"""
    SELECT o_orderkey,
           replace(replace('{MATCH_BY_ID_TEMPLATE}', '${{id}}', CAST(o_orderkey AS VARCHAR)),
                   '${{timezone}}', '{DEFAULT_TIME_ZONE}') AS url_by_id,
           replace(replace('{MATCHES_BY_DATE_TEMPLATE}', '${{date}}', strftime(o_orderdate, '%Y-%m-%d')),
                   '${{timezone}}', '{DEFAULT_TIME_ZONE}') AS url_by_date
    FROM orders
    """,
)
def q_url_template(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    tz = F.lit(DEFAULT_TIME_ZONE)
    return orders.select(
        "o_orderkey",
        fill_template(MATCH_BY_ID_TEMPLATE, {"id": F.col("o_orderkey"), "timezone": tz}).alias("url_by_id"),
        fill_template(
            MATCHES_BY_DATE_TEMPLATE,
            {"date": F.date_format("o_orderdate", "yyyy-MM-dd"), "timezone": tz},
        ).alias("url_by_date"),
    )


# ---- validated parsing with quarantine -------------------------------------------
# events rendered as click lines "user,item,category,behavior,seconds"; every
# 100th event carries a non-number and every 100th (offset 50) loses a field.


def _click_lines(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"], spread_rows=True)
    r = F.pmod("event_id", F.lit(100))
    seconds = ntz_seconds(F.col("ts")).cast("string")
    item = F.get_json_object("props", "$.k")
    category = F.pmod("user_id", F.lit(10)).cast("string")
    head = [F.col("user_id").cast("string"), item, category, F.col("event_type")]
    line = (
        F.when(r == 0, F.concat_ws(",", *head, F.lit("n/a")))
        .when(r == 50, F.concat_ws(",", *head))
        .otherwise(F.concat_ws(",", *head, seconds))
    )
    return ev.select("event_id", line.alias("value"))


_CLICK_LINE_SQL = """
    SELECT event_id,
           CASE WHEN event_id % 100 = 0 THEN concat_ws(',', user_id, json_extract_string(props, '$.k'), user_id % 10, event_type, 'n/a')
                WHEN event_id % 100 = 50 THEN concat_ws(',', user_id, json_extract_string(props, '$.k'), user_id % 10, event_type)
                ELSE concat_ws(',', user_id, json_extract_string(props, '$.k'), user_id % 10, event_type,
                               CAST(floor(epoch(ts)) AS BIGINT)) END AS value,
           event_id % 100 AS r, user_id, props, event_type, ts
    FROM events
"""


@query(
    "parse_clicks",
    oracle=f"""
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CAST(user_id % 10 AS INTEGER) AS category_id, event_type AS behavior,
           CAST(floor(epoch(ts)) AS BIGINT) AS ts_seconds
    FROM ({_CLICK_LINE_SQL}) WHERE r NOT IN (0, 50)
    """,
)
def q_parse_clicks(spark, sf_dir):
    return parse_delimited(_click_lines(spark, sf_dir), CLICKS, keep=("event_id",)).valid


@query(
    "parse_quarantine",
    oracle=f"""
    SELECT event_id, value, CASE WHEN r = 50 THEN 'wrong_arity' ELSE 'bad_value' END AS reason
    FROM ({_CLICK_LINE_SQL}) WHERE r IN (0, 50)
    """,
)
def q_parse_quarantine(spark, sf_dir):
    return parse_delimited(_click_lines(spark, sf_dir), CLICKS, keep=("event_id",)).quarantine


# ---- line parsers ---------------------------------------------------------------
# events and orders rendered as the text lines of the tick, price, number and
# sales jobs; every 100th line has a broken number, every 100th (offset 50)
# loses its last field.


def _lines(df, key: str, fields: list, number: int):
    """``key, value``: fields joined by commas, field ``number`` spoilt or the last one lost on some lines."""
    r = F.pmod(F.col(key), F.lit(100))
    spoilt = [F.lit("n/a") if i == number else f for i, f in enumerate(fields)]
    line = F.when(r == 0, F.concat_ws(",", *spoilt)).when(r == 50, F.concat_ws(",", *fields[:-1]))
    return df.select(key, line.otherwise(F.concat_ws(",", *fields)).alias("value"))


def _event_lines(spark, sf_dir, *fields):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    ms = F.floor(ntz_micros(F.col("ts")) / 1000).cast("string")
    named = {"ms": ms, "user": F.col("user_id").cast("string"), "price": F.col("value").cast("string"), "k": F.get_json_object("props", "$.k")}
    return _lines(ev, "event_id", [named[f] for f in fields], fields.index("ms"))


def _number_rows(spark, sf_dir):
    return parse_lines(_event_lines(spark, sf_dir, "ms", "k"), parse_numbers, 2, keep=("event_id",))


_MS_SQL = "make_timestamp((epoch_us(ts) // 1000) * 1000)"


@query(
    "parse_ticks",
    oracle=f"SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, {_MS_SQL} AS ts, value AS price FROM events WHERE event_id % 100 NOT IN (0, 50)",
)
def q_parse_ticks(spark, sf_dir):
    rows = parse_lines(_event_lines(spark, sf_dir, "user", "ms", "price"), parse_ticks, 3, keep=("event_id",)).valid
    return rows.withColumn("ts", instant_to_ntz(F.col("ts")))


@query(
    "parse_prices",
    oracle=f"SELECT event_id, {_MS_SQL} AS ts, value AS price FROM events WHERE event_id % 100 NOT IN (0, 50)",
)
def q_parse_prices(spark, sf_dir):
    rows = parse_lines(_event_lines(spark, sf_dir, "ms", "price"), parse_prices, 2, keep=("event_id",)).valid
    return rows.select("event_id", instant_to_ntz(F.col("ts")).alias("ts"), "price")


@query(
    "parse_numbers",
    oracle=f"SELECT event_id, {_MS_SQL} AS ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS number FROM events WHERE event_id % 100 NOT IN (0, 50)",
)
def q_parse_numbers(spark, sf_dir):
    rows = _number_rows(spark, sf_dir).valid
    return rows.withColumn("ts", instant_to_ntz(F.col("ts")))


@query(
    "parse_numbers_quarantine",
    oracle="""
    SELECT event_id, CASE WHEN event_id % 100 = 50 THEN 'wrong_arity' ELSE 'bad_value' END AS reason
    FROM events WHERE event_id % 100 IN (0, 50)
    """,
)
def q_parse_numbers_quarantine(spark, sf_dir):
    return _number_rows(spark, sf_dir).quarantine.select("event_id", "reason")


@query(
    "sum_from_lines",
    oracle=f"""
    SELECT time_bucket(INTERVAL '4 hours', ts, TIMESTAMP '1970-01-01') AS window_start,
           CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total
    FROM events WHERE event_id % 100 NOT IN (0, 50) GROUP BY 1
    """,
)
def q_sum_from_lines(spark, sf_dir):
    """A window sum over parsed text lines."""
    rows = _number_rows(spark, sf_dir).valid
    sums = windowed(rows, "ts", "4 hours", [sum_of(F.col("number").cast("bigint"), "total")])
    return sums.select(instant_to_ntz(F.col("window_start")).alias("window_start"), "total")


@query(
    "parse_sales",
    oracle="""
    SELECT o_orderkey, monthname(o_orderdate) AS month, o_orderpriority AS category, o_orderstatus AS product,
           CAST(floor(o_totalprice) AS INTEGER) AS profit, 1 AS n
    FROM orders WHERE o_orderkey % 100 NOT IN (0, 50)
    """,
)
def q_parse_sales(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"])
    day, month = F.date_format("o_orderdate", "dd-MM-yyyy"), F.date_format("o_orderdate", "MMMM")
    profit = F.floor("o_totalprice").cast("string")
    lines = _lines(orders, "o_orderkey", [day, month, F.col("o_orderpriority"), F.col("o_orderstatus"), profit], 4)
    return parse_lines(lines, parse_sales, 5, keep=("o_orderkey",)).valid


# ---- text files, written and read back ----------------------------------------


@query(
    "tuple_text_files",
    oracle="""
    SELECT '(' || c_custkey || ',' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') || ',' || c_nationkey || ')' AS value FROM customer
    """,
)
def q_tuple_text_files(spark, sf_dir):
    """Records as text lines through the text sink and the line source, some with a null field."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    cust = cust.withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    path = scratch_path(spark, "tuple-text")
    write_text(cust, tuple_text("c_custkey", "c_mktsegment", "c_nationkey"), path)
    return read_lines(spark, path)


@query("delimited_files", oracle="SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem")
def q_delimited_files(spark, sf_dir):
    """Points as space-separated lines through the delimited sink and the typed file source."""
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    path = scratch_path(spark, "points")
    write_delimited(li.select((F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y")), path)
    return read_points(spark, path)


# ---- JSON envelopes -------------------------------------------------------------
# lineitem packed per order as {"response":[...]} pages of four line numbers,
# elements sorted by fields within a page.

_LINES_PER_PAGE = 4

_LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _line_struct_type():
    from pyspark.sql import types as T

    return T.StructType(
        [
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_suppkey", T.LongType()),
            T.StructField("l_quantity", T.DoubleType()),
        ]
    )


def _envelopes(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", *_LINE_FIELDS])
    page = F.floor((F.col("l_linenumber") - 1) / _LINES_PER_PAGE).cast("int")
    return pack_envelopes(li, "l_orderkey", _LINE_FIELDS, page)


_ORDERED_LINES_SQL = f"""
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, page
                                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS pos,
           min(page) OVER (PARTITION BY l_orderkey) AS first_page
    FROM (SELECT *, CAST(floor((l_linenumber - 1) / {_LINES_PER_PAGE}) AS INTEGER) AS page FROM lineitem)
"""


@query(
    "envelope_explode",
    headline=True,
    oracle=f"SELECT l_orderkey, page, CAST(pos AS INTEGER) AS pos, l_linenumber AS line, l_partkey AS partkey, l_quantity AS quantity FROM ({_ORDERED_LINES_SQL})",
)
def q_envelope_explode(spark, sf_dir):
    rows = J.explode_envelope(_envelopes(spark, sf_dir), "value", _line_struct_type(), keep=["l_orderkey", "page"])
    return rows.select(
        "l_orderkey",
        "page",
        "pos",
        F.col("item.l_linenumber").alias("line"),
        F.col("item.l_partkey").alias("partkey"),
        F.col("item.l_quantity").alias("quantity"),
    )


@query(
    "envelope_first",
    oracle=f"SELECT l_orderkey, l_linenumber AS line, l_partkey AS partkey, l_quantity AS quantity FROM ({_ORDERED_LINES_SQL}) WHERE page = first_page AND pos = 0",
)
def q_envelope_first(spark, sf_dir):
    rows = J.first_of_envelope(first_pages(_envelopes(spark, sf_dir), "l_orderkey"), "value", _line_struct_type(), keep=["l_orderkey"])
    return rows.select(
        "l_orderkey",
        F.col("item.l_linenumber").alias("line"),
        F.col("item.l_partkey").alias("partkey"),
        F.col("item.l_quantity").alias("quantity"),
    )


# Some documents are cut off, some hold a text where a number is declared.


@query(
    "envelope_quarantine",
    oracle=f"""
    SELECT l_orderkey, CAST(floor((l_linenumber - 1) / {_LINES_PER_PAGE}) AS INTEGER) AS page,
           CAST(count(*) AS BIGINT) AS n_lines, l_orderkey % 10 IN (3, 7) AS bad
    FROM lineitem GROUP BY ALL
    """,
)
def q_envelope_quarantine(spark, sf_dir):
    """Every document with its verdict; the lines of a bad one are counted from its text."""
    docs, last = _envelopes(spark, sf_dir), F.pmod("l_orderkey", F.lit(10))
    broken = (
        F.when(last == 3, F.expr("left(value, length(value) - 2)"))
        .when(last == 7, F.replace("value", F.lit('"l_partkey":'), F.lit('"l_partkey":"x","y":')))
        .otherwise(F.col("value"))
    )
    parsed = J.parse_envelopes(docs.withColumn("value", broken), "value", _line_struct_type(), keep=["l_orderkey", "page"])
    lines = F.when(F.col("bad"), F.regexp_count("value", F.lit('"l_linenumber"'))).otherwise(F.size("items"))
    return parsed.select("l_orderkey", "page", lines.cast("bigint").alias("n_lines"), "bad")


# ---- JSON round trip ------------------------------------------------------------

_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("json_roundtrip", oracle=f"SELECT {', '.join(_CUSTOMER_COLS)} FROM customer")
def q_json_roundtrip(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", _CUSTOMER_COLS)
    schema = cust.schema
    text = cust.select(J.render(F.struct(*_CUSTOMER_COLS)).alias("value"))
    return text.select(J.parse(F.col("value"), schema).alias("r")).select("r.*")


# ---- nested record with declared defaults ------------------------------------
# events rendered as partial match records: some leaves present, some
# explicitly null, some absent, plus an undeclared field.

_FIXTURE_ID_MOD = 1000000007


def _match_text(spark, sf_dir, *keep):
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value", *keep], spread_rows=True)
    et = F.col("event_type")
    fid = F.pmod("event_id", F.lit(_FIXTURE_ID_MOD)).cast("string")
    referee = (
        F.when(et.isin("view", "click"), F.concat(F.lit(',"referee":"ref-'), F.col("user_id").cast("string"), F.lit('"')))
        .when(et == "error", F.lit(',"referee":null'))
        .otherwise(F.lit(""))
    )
    status = F.when(
        et != "signup",
        F.concat(F.lit(',"status":{"elapsed":'), F.floor("value").cast("string"), F.lit("}")),
    ).otherwise(F.lit(""))
    winner = (
        F.when(F.col("value") > 250, F.lit('"teams":{"home":{"winner":true}},'))
        .when(et == "error", F.lit('"teams":{"home":{"winner":null}},'))
        .otherwise(F.lit(""))
    )
    goals = F.when(
        et == "purchase",
        F.concat(F.lit(',"goals":{"home":'), F.pmod("user_id", F.lit(5)).cast("string"), F.lit("}")),
    ).otherwise(F.lit(""))
    text = F.concat(
        F.lit("{"), winner, F.lit('"fixture":{"id":'), fid, referee, status, F.lit("}"), goals, F.lit(',"zzz":1}')
    )
    return ev.select("event_id", text.alias("value"), *keep)


@query(
    "nested_defaults",
    oracle=f"""
    SELECT event_id,
           CAST(event_id % {_FIXTURE_ID_MOD} AS INTEGER) AS id,
           CASE WHEN event_type IN ('view', 'click') THEN concat('ref-', user_id) ELSE 'unknown' END AS referee,
           CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS INTEGER) ELSE -1 END AS elapsed,
           'unknown' AS status_long,
           CASE WHEN event_type = 'purchase' THEN CAST(user_id % 5 AS INTEGER) ELSE 0 END AS home_goals,
           0 AS away_goals,
           CASE WHEN value > 250 THEN true ELSE false END AS home_winner,
           0 AS home_team_id,
           -1 AS venue_id,
           'unknown' AS league_name,
           0 AS halftime_home
    FROM events
    """,
)
def q_nested_defaults(spark, sf_dir):
    parsed = J.parse_once(_match_text(spark, sf_dir), "value", MATCH, "raw", keep=["event_id"])
    m = fill_defaults(F.col("raw"), MATCH_TREE).alias("m")
    return parsed.select("event_id", m).select(
        "event_id",
        F.col("m.fixture.id").alias("id"),
        F.col("m.fixture.referee").alias("referee"),
        F.col("m.fixture.status.elapsed").alias("elapsed"),
        F.col("m.fixture.status.long").alias("status_long"),
        F.col("m.goals.home").alias("home_goals"),
        F.col("m.goals.away").alias("away_goals"),
        F.col("m.teams.home.winner").alias("home_winner"),
        F.col("m.teams.home.id").alias("home_team_id"),
        F.col("m.fixture.venue.id").alias("venue_id"),
        F.col("m.league.name").alias("league_name"),
        F.col("m.score.halftime.home").alias("halftime_home"),
    )


# ---- match envelopes by date, strict records -----------------------------------

MATCH_DATE = "2024-01-15"
_MATCHES_PER_PAGE = 16


@query(
    "match_by_date",
    oracle=f"""
    SELECT CAST(event_id % {_FIXTURE_ID_MOD} AS INTEGER) AS id, strftime(ts, '%Y-%m-%d') AS match_date,
           CASE WHEN event_type IN ('view', 'click') THEN concat('ref-', user_id) ELSE 'unknown' END AS referee,
           CASE WHEN event_type = 'purchase' THEN CAST(user_id % 5 AS INTEGER) ELSE 0 END AS home_goals,
           value > 250 AS home_winner, 'unknown' AS league_name
    FROM events WHERE CAST(ts AS DATE) = DATE '{MATCH_DATE}'
    """,
)
def q_match_by_date(spark, sf_dir):
    """Full match records of one day out of ``{"response": [...]}`` pages."""
    texts = _match_text(spark, sf_dir, "ts")
    day = F.concat(F.lit('"fixture":{"date":"'), F.col("ts").cast("date").cast("string"), F.lit('",'))
    dated = texts.select("event_id", F.replace("value", F.lit('"fixture":{'), day).alias("value"))
    page = F.floor(F.col("event_id") / _MATCHES_PER_PAGE).alias("page")
    pages = dated.groupBy(page).agg(F.sort_array(F.collect_list("value")).alias("values"))
    docs = pages.select("page", F.concat(F.lit('{"response":['), F.array_join("values", ","), F.lit("]}")).alias("value"))
    parsed = J.parse_envelopes(docs, "value", MATCH).where(~F.col("bad"))
    m = parsed.select(F.explode("items").alias("raw")).where(F.col("raw.fixture.date") == MATCH_DATE)
    return m.select(fill_defaults(F.col("raw"), MATCH_TREE).alias("m")).select(
        F.col("m.fixture.id").alias("id"),
        F.col("m.fixture.date").alias("match_date"),
        F.col("m.fixture.referee").alias("referee"),
        F.col("m.goals.home").alias("home_goals"),
        F.col("m.teams.home.winner").alias("home_winner"),
        F.col("m.league.name").alias("league_name"),
    )


@query(
    "json_strict",
    oracle="""
    SELECT event_id,
           CASE event_type WHEN 'view' THEN '' WHEN 'error' THEN 'fixture.status.bogus'
                           WHEN 'click' THEN 'fixture.bogus,zzz' WHEN 'purchase' THEN 'zzz' END AS undeclared,
           event_type = 'view' AS accepted
    FROM events
    """,
)
def q_json_strict(spark, sf_dir):
    """Strict records: undeclared fields at any level reject, and so does text that is not JSON."""
    texts, et = _match_text(spark, sf_dir, "event_type"), F.col("event_type")
    clean = F.replace("value", F.lit(',"zzz":1'), F.lit(""))
    text = (
        F.when(et == "view", clean)
        .when(et == "error", F.replace(clean, F.lit('"status":{'), F.lit('"status":{"bogus":{"a":1},')))
        .when(et == "click", F.replace("value", F.lit('"fixture":{'), F.lit('"fixture":{"bogus":null,')))
        .when(et == "signup", F.expr("left(value, length(value) - 1)"))
        .otherwise(F.col("value"))
    )
    paths = texts.select("event_id", J.undeclared_paths(text, MATCH_TREE).alias("paths"))
    return paths.select(
        "event_id",
        F.array_join("paths", ",").alias("undeclared"),
        F.coalesce(F.size("paths") == 0, F.lit(False)).alias("accepted"),
    )


# ---- envelope files -------------------------------------------------------------------
# A file per 512 order keys; some are cut off, some hold no array, some a text where a number is declared.

_ORDERS_PER_FILE = 512
_FILE_LEAVES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_quantity": "double"}
_FILE_REASON_SQL = "CASE file % 9 WHEN 2 THEN 'not_json' WHEN 4 THEN 'no_response' WHEN 6 THEN 'bad_leaf' END"


def _envelope_folder(spark, sf_dir):
    """The documents as files, one folder per file number."""
    li = read_table(spark, sf_dir, "lineitem", list(_FILE_LEAVES))
    numbered = li.withColumn("file", F.floor(F.col("l_orderkey") / _ORDERS_PER_FILE))
    docs = pack_envelopes(numbered, "file", list(_FILE_LEAVES), F.lit(0)).drop("page")
    kind = F.pmod("file", F.lit(9))
    spoilt = (
        F.when(kind == 2, F.expr("left(value, length(value) - 2)"))
        .when(kind == 4, F.replace("value", F.lit('{"response":'), F.lit('{"result":')))
        .when(kind == 6, F.regexp_replace("value", r'"l_quantity":[0-9.]+\}\]\}$', '"l_quantity":"7"}]}'))
        .otherwise(F.col("value"))
    )
    path = scratch_path(spark, "envelope-files")
    docs.withColumn("value", spoilt).repartition("file").write.partitionBy("file").text(path)
    return read_whole_files(spark, path)


@query(
    "envelope_files",
    oracle=f"""
    SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) - 1 AS INTEGER) AS pos,
           l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_partkey, l_quantity
    FROM (SELECT *, CAST(l_orderkey // {_ORDERS_PER_FILE} AS INTEGER) AS file FROM lineitem)
    WHERE {_FILE_REASON_SQL} IS NULL
    """,
)
def q_envelope_files(spark, sf_dir):
    """Elements of the sound envelope files, written, spoilt in part and read back."""
    return J.envelope_files(_envelope_folder(spark, sf_dir), _FILE_LEAVES, keep=("file",))[0]


@query(
    "envelope_files_quarantine",
    oracle=f"""
    SELECT DISTINCT file, {_FILE_REASON_SQL} AS reason
    FROM (SELECT CAST(l_orderkey // {_ORDERS_PER_FILE} AS INTEGER) AS file FROM lineitem) WHERE {_FILE_REASON_SQL} IS NOT NULL
    """,
)
def q_envelope_files_quarantine(spark, sf_dir):
    return J.envelope_files(_envelope_folder(spark, sf_dir), _FILE_LEAVES, keep=("file",))[1]
