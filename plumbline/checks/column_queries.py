"""Projection, text, category and calendar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.registry import query, quoted, table
from plumbline.columns import col
from plumbline.functions import calendar as cal
from plumbline.functions import categories as cat
from plumbline.functions import convert, text
from plumbline.operators import stats

ACC = st.select("accidents")


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_case(value: str, mapping: dict[str, str]) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in mapping.items()) + " END"


@query("project_reorder", "p_type:s p_partkey:i p_size:i", "SELECT p_type, p_partkey, p_size FROM part")
def project_reorder(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_brand", "p_retailprice").select("p_type", "p_partkey", "p_size")


@query(
    "rename_cols",
    "customer_id:i customer_name:s segment:s balance:f",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, c_acctbal AS balance FROM customer",
)
def rename_cols(spark, sf):
    names = {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment", "c_acctbal": "balance"}
    return table(spark, sf, "customer").withColumnsRenamed(names)


@query(
    "rename_snake",
    "supplier_key:i supplier_name:s nation_key:i account_bal:f",
    "SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_nationkey AS nation_key, s_acctbal AS account_bal FROM supplier",
)
def rename_snake(spark, sf):
    return text.rename_snake(table(spark, sf, "supplier").toDF("supplierKey", "SupplierName", "nationKey", "accountBal"))


@query("flatten_struct", "p_partkey:i brand:s size:i", "SELECT p_partkey, p_brand AS brand, p_size AS size FROM part")
def flatten_struct(spark, sf):
    part = table(spark, sf, "part")
    nested = part.select("p_partkey", F.struct(col("p_brand").alias("brand"), col("p_size").alias("size")).alias("detail"))
    return convert.flatten_struct(nested, "detail")


CASTABLE = """SELECT p_partkey, CASE WHEN p_size > 35 THEN CONCAT(CAST(p_size AS STRING), ' cm') ELSE CAST(p_size AS STRING) END AS size_text,
  CASE WHEN p_size < 10 THEN p_name ELSE CAST(p_retailprice AS STRING) END AS price_text FROM part"""


@query(
    "safe_cast",
    "p_partkey:i size_text:i price_text:f",
    f"""SELECT p_partkey, TRY_CAST(size_text AS INTEGER) AS size_text, TRY_CAST(price_text AS DOUBLE) AS price_text
    FROM ({CASTABLE})""",
)
def safe_cast(spark, sf):
    part = table(spark, sf, "part")
    size, price = col("p_size").cast("string"), col("p_retailprice").cast("string")
    raw = part.select(
        "p_partkey",
        F.when(col("p_size") > 35, F.concat(size, F.lit(" cm"))).otherwise(size).alias("size_text"),
        F.when(col("p_size") < 10, col("p_name")).otherwise(price).alias("price_text"),
    )
    return convert.safe_cast(raw, {"size_text": "int", "price_text": "double"})


@query(
    "unit_scale",
    "l_orderkey:i l_linenumber:i l_quantity:f l_extendedprice:f",
    "SELECT l_orderkey, l_linenumber, l_quantity / 10.0 AS l_quantity, l_extendedprice / 10.0 AS l_extendedprice FROM lineitem",
)
def unit_scale(spark, sf):
    return convert.scale_columns(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "absent"], 10.0)


@query(
    "null_tokens",
    "o_orderkey:i o_orderstatus:s o_orderpriority:s",
    """SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW', 'P') THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders""",
)
def null_tokens(spark, sf):
    return text.nullify_tokens(table(spark, sf, "orders"), ["4-NOT SPECIFIED", "5-LOW", "P"])


@query(
    "normalize_text",
    "doc_id:i text:s source:s stripped:s",
    rf"""SELECT doc_id, NULLIF(regexp_replace(trim(lower(text)), '\s+', '_', 'g'), '') AS text,
    NULLIF(regexp_replace(trim(lower(source)), '\s+', '_', 'g'), 'src3') AS source,
    trim(stripped, '{text.WHITE_SPACE}') AS stripped FROM (SELECT *, CONCAT('  ', text, chr(9)) AS stripped FROM documents)""",
)
def normalize_text(spark, sf):
    padded = F.concat(F.lit("  "), col("text"), F.lit("\t"))
    documents = table(spark, sf, "documents").select("doc_id", "text", "source", padded.alias("stripped"))
    done = text.normalize_text(documents, ["text", "source"], lower=True, tokens=["", "src3"])
    return text.strip_all(done)


@query(
    "recode_case",
    "o_orderkey:i o_orderstatus:s",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'O' THEN 'open'
    ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def recode_case(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.withColumn("o_orderstatus", cat.recode(col("o_orderstatus"), {"F": "finished", "O": "open"}))


@query(
    "recode_map",
    "dr_no:s vict_descent:s descent:s",
    f"SELECT dr_no, vict_descent, {sql_case('vict_descent', cat.DESCENT_NAMES)} AS descent FROM {ACC}",
)
def recode_map(spark, sf):
    rows = st.frame(spark, sf, "accidents")
    return rows.withColumn("descent", cat.lookup(col("vict_descent"), cat.DESCENT_NAMES))


@query(
    "split_codes",
    "dr_no:s codes:a digits:a n:i",
    rf"""SELECT dr_no, CASE WHEN mocodes IS NULL THEN [] ELSE regexp_split_to_array(mocodes, '\s+') END AS codes,
    CASE WHEN mocodes IS NULL THEN [] ELSE regexp_extract_all(mocodes, '\d+') END AS digits,
    CASE WHEN mocodes IS NULL THEN 0 ELSE len(regexp_split_to_array(mocodes, '\s+')) END AS n FROM {ACC}""",
)
def split_codes(spark, sf):
    rows = st.frame(spark, sf, "accidents")
    codes = cat.split_codes(col("mocodes"))
    return rows.select("dr_no", codes.alias("codes"), cat.digit_runs(col("mocodes")).alias("digits"), F.size(codes).alias("n"))


def sql_code_groups(source: str, key: str = "dr_no") -> str:
    """Codes as rows with a position: independent of the array functions under test."""
    labels = ", ".join(
        f"COALESCE(FIRST({sql_case('code', g)} ORDER BY position) "
        f"FILTER (code IN ({', '.join(sql_text(c) for c in g)})), 'unknown') AS {quoted(n)}"
        for n, g in cat.MO_CODE_GROUPS.items()
    )
    return f"""SELECT {key}, {labels} FROM (
      SELECT {key}, unnest(codes) AS code, generate_subscripts(codes, 1) AS position FROM (
        SELECT {key}, CASE WHEN mocodes IS NULL THEN [''] ELSE regexp_extract_all(mocodes, '\\d+') END AS codes
        FROM {source})) GROUP BY {key}"""


@query("mocode_features", "dr_no:s " + " ".join(f"{g}:s" for g in cat.MO_CODE_GROUPS), sql_code_groups(ACC))
def mocode_features(spark, sf):
    rows = st.frame(spark, sf, "accidents").withColumn("codes", cat.digit_runs(col("mocodes")))
    return rows.withColumns(cat.code_group_columns(col("codes")))


CLOCK = "CONCAT(SUBSTRING(time_occ, 1, 2), ':', SUBSTRING(time_occ, 3, 2))"


@query(
    "time_parse",
    "dr_no:s clock:s occurred:t compact:d iso:d offset_time:t",
    f"""SELECT dr_no, {CLOCK} AS clock,
    try_strptime(CONCAT(strftime(date_occ, '%Y-%m-%d'), ' ', {CLOCK}), '%Y-%m-%d %H:%M') AS occurred,
    CASE WHEN vict_sex = 'M' THEN NULL ELSE date_occ END AS compact,
    CASE WHEN vict_sex = 'F' THEN NULL ELSE date_rptd END AS iso,
    CASE WHEN try_strptime({CLOCK}, '%H:%M') IS NULL THEN NULL ELSE
      try_strptime(CONCAT(strftime(date_occ, '%Y-%m-%d'), ' ', {CLOCK}), '%Y-%m-%d %H:%M') + INTERVAL 8 HOUR END AS offset_time
    FROM {ACC}""",
)
def time_parse(spark, sf):
    rows = st.frame(spark, sf, "accidents")
    clock = convert.clock_text(col("time_occ"))
    compact = F.concat(F.date_format("date_occ", "yyyyMMdd"), F.when(col("vict_sex") == "M", "x").otherwise(""))
    iso = F.when(col("vict_sex") == "F", "unknown").otherwise(col("date_rptd").cast("string"))
    offset = F.concat(F.date_format("date_occ", "yyyy-MM-dd"), F.lit("T"), clock, F.lit(":00-08:00"))
    instant = convert.parse_offset_timestamp(offset)
    return rows.select(
        "dr_no",
        clock.alias("clock"),
        convert.at_clock(col("date_occ"), clock).alias("occurred"),
        convert.parse_date(compact, convert.COMPACT_DATE).alias("compact"),
        convert.parse_date(iso).alias("iso"),
        F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz")).alias("offset_time"),
    )


@query(
    "calendar_features",
    "event_id:i occ_year:i occ_month:i occ_day:i occ_dayofweek:i occ_hour:i occ_minute:i part:s weekend:i month:s weekday:s "
    "week:d delay:i",
    """SELECT event_id, YEAR(ts) AS occ_year, MONTH(ts) AS occ_month, DAY(ts) AS occ_day, ISODOW(ts) - 1 AS occ_dayofweek,
    HOUR(ts) AS occ_hour, MINUTE(ts) AS occ_minute,
    CASE WHEN HOUR(ts) >= 6 AND HOUR(ts) < 12 THEN 'Morning' WHEN HOUR(ts) >= 12 AND HOUR(ts) < 17 THEN 'Afternoon'
      WHEN HOUR(ts) >= 17 AND HOUR(ts) < 20 THEN 'Evening' WHEN HOUR(ts) >= 20 THEN 'Late Evening' ELSE 'Night' END AS part,
    CASE WHEN ISODOW(ts) >= 6 THEN 1 ELSE 0 END AS weekend, MONTHNAME(ts) AS month, DAYNAME(ts) AS weekday,
    CAST(date_trunc('week', CAST(ts AS DATE) - 1) AS DATE) + 7 AS week,
    date_diff('day', CAST(ts AS DATE), CAST(ts + INTERVAL 30 HOUR AS DATE)) AS delay FROM events""",
)
def calendar_features(spark, sf):
    ts = col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        *[c.alias(name) for name, c in cal.date_parts(ts).items()],
        cal.part_of_day(F.hour(ts)).alias("part"),
        cal.is_weekend(ts).alias("weekend"),
        cal.month_name(ts).alias("month"),
        cal.weekday_name(ts).alias("weekday"),
        cal.week_ending_monday(ts).alias("week"),
        cal.delay_days(ts + F.expr("INTERVAL 30 HOUR"), ts).alias("delay"),
    )


@query(
    "bin_numeric",
    "dr_no:s vict_age:i age_group:s",
    f"""SELECT dr_no, vict_age, CASE WHEN vict_age < 0 THEN NULL WHEN vict_age < 17 THEN 'Minor'
    WHEN vict_age < 25 THEN 'Young Adult' WHEN vict_age < 40 THEN 'Adult' WHEN vict_age < 60 THEN 'Middle-Aged'
    ELSE 'Senior' END AS age_group FROM {ACC}""",
)
def bin_numeric(spark, sf):
    rows = st.frame(spark, sf, "accidents")
    return rows.withColumn("age_group", cal.bin_numeric(col("vict_age"), cal.AGE_EDGES, cal.AGE_LABELS))


@query(
    "lump_rare_levels",
    "dr_no:s location:s",
    f"""SELECT dr_no, CASE WHEN location IN (SELECT location FROM {ACC} GROUP BY location HAVING COUNT(*) > 100)
    THEN location ELSE 'secondary_st' END AS location FROM {ACC}""",
)
def lump_rare_levels(spark, sf):
    return stats.lump_rare_levels(st.frame(spark, sf, "accidents"), "location")


@query("value_counts", "location:s n:i", f"SELECT location, COUNT(*) AS n FROM {ACC} GROUP BY 1")
def value_counts(spark, sf):
    return stats.value_counts(st.frame(spark, sf, "accidents"), "location")
