"""Scalar functions, text, logs, data quality and UDFs."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightwell.functions import udfs
from brightwell.functions.bands import age_group, generation, life_stage
from brightwell.functions.dates import age_in_years, date_from_parts, parse_date_any, time_bucket
from brightwell.functions.numbers import mean, n_rows, round_half_up
from brightwell.functions.strings import (
    BLANKS,
    email_domain,
    listed_category,
    standard_category,
    url_host,
    url_origin,
)
from brightwell.operators import logs, quality, text
from brightwell.plans import derived
from brightwell.plans.registry import query, sql_count, sql_mean, sql_percent, sql_round
from brightwell.plans.relational import revenue



@query("fn_string", """
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_type) AS type_lower, CAST(length(p_name) AS INT) AS name_length,
  trim('  ' || p_brand || ' ') AS brand, substring(p_name, 1, 1) AS initial, split_part(p_name, ' ', 1) AS first_word,
  regexp_replace(p_brand, '[^0-9]', '', 'g') AS brand_number, regexp_extract(p_brand, '#([0-9]+)', 1) AS brand_group,
  contains(p_name, 'red') AS is_red, starts_with(p_type, 'SM') AS is_small, regexp_matches(p_brand, '^Brand#[1-9]$') AS one_digit,
  p_brand || '-' || p_type AS label FROM part""")
def fn_string(t):
    name, brand = F.col("p_name"), F.col("p_brand")
    return t.part.select(
        "p_partkey", F.upper(name).alias("name_upper"), F.lower("p_type").alias("type_lower"),
        F.length(name).alias("name_length"), F.trim(F.concat(F.lit("  "), brand, F.lit(" "))).alias("brand"),
        F.substring(name, 1, 1).alias("initial"), F.substring_index(name, " ", 1).alias("first_word"),
        F.regexp_replace(brand, "[^0-9]", "").alias("brand_number"),
        F.regexp_extract(brand, "#([0-9]+)", 1).alias("brand_group"), name.contains("red").alias("is_red"),
        F.col("p_type").startswith("SM").alias("is_small"), brand.rlike("^Brand#[1-9]$").alias("one_digit"),
        F.concat(brand, F.lit("-"), F.col("p_type")).alias("label"))


@query("fn_math", f"""
SELECT p_partkey, {sql_round('p_retailprice * 1.1', 1)} AS rounded, CAST(floor(p_retailprice / 7) AS BIGINT) AS floored,
  CAST(ceil(p_retailprice / 7) AS BIGINT) AS ceiled, CAST(p_size % 7 AS INT) AS modulo, abs(20 - p_size) AS distance,
  {sql_round('sqrt(p_size)', 6)} AS root, CAST(pow(p_size, 2) AS DOUBLE) AS square FROM part""")
def fn_math(t):
    price, size = F.col("p_retailprice"), F.col("p_size")
    return t.part.select(
        "p_partkey", round_half_up(price * 1.1, 1).alias("rounded"), F.floor(price / 7).alias("floored"),
        F.ceil(price / 7).alias("ceiled"), (size % 7).alias("modulo"), F.abs(20 - size).alias("distance"),
        round_half_up(F.sqrt(size), 6).alias("root"), F.pow(size, F.lit(2)).alias("square"))


@query("fn_array", """
SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INT) AS n_words,
  list_contains(string_split(p_name, ' '), 'bolt') AS has_bolt,
  list_contains([p_size, 7, 11], 11) AS has_eleven, w AS word FROM part, unnest(string_split(p_name, ' ')) AS u(w)""")
def fn_array(t):
    parts = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", F.size(parts).alias("n_words"), F.array_contains(parts, "bolt").alias("has_bolt"),
        F.array_contains(F.array("p_size", F.lit(7), F.lit(11)), 11).alias("has_eleven"),
        F.explode(parts).alias("word"))


@query("fn_hash", """
SELECT p_brand, count(*) AS n_rows, count(DISTINCT p_name) AS n_names, count(DISTINCT p_name) AS n_hashes,
  TRUE AS is_stable FROM part GROUP BY p_brand""")
def fn_hash(t):
    """Hashes differ where the values differ and are the same on every evaluation."""
    again = F.xxhash64(F.concat("p_name", F.lit("")), "p_brand") == F.xxhash64("p_name", "p_brand")
    return t.part.groupBy("p_brand").agg(
        n_rows().alias("n_rows"), F.count_distinct("p_name").alias("n_names"),
        F.count_distinct(F.xxhash64("p_name", "p_brand"), F.hash("p_name", "p_brand")).alias("n_hashes"),
        F.bool_and(again).alias("is_stable"))


@query("fn_json", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.k') AS k_tuple,
  event_type AS kind, value AS amount FROM events""")
def fn_json(t):
    both = t.events.select(
        "event_id", "event_type", "value", F.get_json_object("props", "$.k").alias("k_text"),
        F.json_tuple("props", "k").alias("k_tuple"))
    packed = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("value").alias("amount")))
    return both.select("event_id", "k_text", "k_tuple",
                       F.from_json(packed, "kind STRING, amount DOUBLE").alias("v")).select(
        "event_id", "k_text", "k_tuple", "v.*")


@query("fn_date", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(day(o_orderdate) AS INT) AS day, strftime(o_orderdate, '%Y-%m-%d') AS formatted,
  CAST(week(o_orderdate) AS INT) AS week, CAST(dayofweek(o_orderdate) + 1 AS INT) AS weekday,
  CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INT) AS age_days,
  CAST(floor(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') / 365.25) AS INT) AS age_years FROM orders""")
def fn_date(t):
    date, today = F.col("o_orderdate"), F.lit("2002-01-01").cast("date")
    return t.orders.select(
        "o_orderkey", F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"),
        F.date_format(date, "yyyy-MM-dd").alias("formatted"), F.weekofyear(date).alias("week"),
        F.dayofweek(date).alias("weekday"), F.datediff(today, date).alias("age_days"),
        age_in_years(date, today).alias("age_years"))


@query("date_multi_format", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def date_multi_format(t):
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    written = (F.when(key % 7 == 0, "not a date").when(key % 3 == 0, F.date_format(date, "M/d/yyyy"))
               .when(key % 3 == 1, F.date_format(date, "yyyy-MM-dd")).otherwise(F.date_format(date, "dd-MM-yyyy")))
    return t.orders.select("o_orderkey", written.alias("written")).select(
        "o_orderkey", parse_date_any(F.col("written")).alias("parsed"))


@query("fn_timestamp", """
SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) AS INT) AS minute,
  CAST(dayofweek(ts) + 1 AS INT) AS weekday, date_trunc('hour', ts) AS hour_start,
  CAST(floor(epoch(ts)) AS BIGINT) AS unix_seconds,
  CAST(hour(timezone('Asia/Tokyo', timezone('UTC', ts))) AS INT) AS tokyo_hour,
  ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS AS is_recent FROM events""")
def fn_timestamp(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.dayofweek(ts).alias("weekday"),
        F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour_start"),
        F.unix_timestamp(ts).alias("unix_seconds"),
        F.hour(F.from_utc_timestamp(ts, "Asia/Tokyo")).alias("tokyo_hour"),
        (ts >= derived.latest_event(t) - F.expr("INTERVAL 24 HOURS")).alias("is_recent"))


@query("time_bucket_5min", """
SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS bucket, count(*) AS n_events FROM events GROUP BY 1""")
def time_bucket_5min(t):
    return t.events.groupBy(time_bucket(F.col("ts"), "5 minutes").alias("bucket")).agg(n_rows().alias("n_events"))


@query("generation_profile", f"""
WITH p AS (SELECT o_orderkey, CAST(CASE WHEN y < 20 THEN y + 2000 ELSE y + 1900 END AS INT) AS born
  FROM (SELECT o_orderkey, o_custkey % 100 AS y FROM orders)),
d AS (SELECT *, CAST(floor(date_diff('day', make_date(born, 6, 15), DATE '2024-01-01') / 365.25) AS INT) AS age FROM p)
SELECT CASE WHEN born >= 1997 THEN 'Gen Z' WHEN born >= 1981 THEN 'Millennial' WHEN born >= 1965 THEN 'Gen X'
    WHEN born >= 1946 THEN 'Baby Boomer' ELSE 'Silent Generation' END AS generation,
  CASE WHEN age < 18 THEN 'Minor' WHEN age < 30 THEN 'Young Adult' WHEN age < 50 THEN 'Adult'
    WHEN age < 65 THEN 'Middle-aged' ELSE 'Senior' END AS life_stage,
  count(*) AS n_people, {sql_mean('age')} AS avg_age, min(age) AS min_age, max(age) AS max_age FROM d GROUP BY ALL""")
def generation_profile(t):
    short = F.col("o_custkey") % 100
    born = F.when(short < 20, short + 2000).otherwise(short + 1900)
    people = t.orders.select(date_from_parts(born, F.lit(6), F.lit(15)).alias("dob"))
    aged = people.withColumn("age", age_in_years(F.col("dob"), F.lit("2024-01-01").cast("date")))
    return aged.groupBy(generation(F.year("dob")).alias("generation"), life_stage(F.col("age")).alias("life_stage")).agg(
        n_rows().alias("n_people"), mean("age").alias("avg_age"), F.min("age").alias("min_age"), F.max("age").alias("max_age"))


# Text ------------------------------------------------------------------------

_PUNCT = "'!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~'"
_TOKENS = f"""raw AS (SELECT unnest(regexp_split_to_array(text, '{BLANKS}')) AS r FROM documents),
tokens AS (SELECT lower(trim(r, {_PUNCT})) AS word FROM raw
           WHERE regexp_full_match(lower(trim(r, {_PUNCT})), '\\p{{L}}+'))"""


@query("explode_words", """
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def explode_words(t):
    return text.raw_word_count(t.documents, "text")


@query("word_count", f"WITH {_TOKENS} SELECT word, count(*) AS count FROM tokens GROUP BY word")
def word_count(t):
    return text.word_count(t.documents, "text")


@query("words_containing", f"""
WITH {_TOKENS} SELECT word, count(*) AS count FROM tokens WHERE contains(word, 'tion') GROUP BY word""")
def words_containing(t):
    return text.words_containing(t.documents, "text", "tion")


@query("text_stats", f"""
WITH {_TOKENS}, c AS (SELECT word, count(*) AS n, length(word) AS len FROM tokens GROUP BY word)
SELECT CAST(sum(n) AS BIGINT) AS total_words, count(*) AS unique_words, CAST(count(*) AS DOUBLE) / sum(n) AS richness,
  CAST(sum(len * n) AS DOUBLE) / sum(n) AS avg_word_length,
  (SELECT word FROM c ORDER BY len DESC, word LIMIT 1) AS longest_word,
  (SELECT word FROM c ORDER BY len, word LIMIT 1) AS shortest_word FROM c""")
def text_stats(t):
    return text.corpus_statistics(t.documents, "text")


@query("word_length_hist", f"""
WITH {_TOKENS} SELECT CAST(length(word) AS INT) AS word_length, count(*) AS count FROM tokens GROUP BY 1""")
def word_length_hist(t):
    return text.word_lengths(t.documents, "text")


@query("bigrams", f"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT list_filter(regexp_split_to_array(line, '{BLANKS}'), lambda x: x <> '') AS w FROM lines),
p AS (SELECT w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) > 1)
SELECT lower(w[i]) AS first_word, lower(w[i + 1]) AS second_word, count(*) AS count FROM p GROUP BY ALL""")
def bigrams(t):
    return text.bigrams(t.documents, "text")


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1))"


@query("domain_extract", f"""
SELECT page_id, {_HOST} AS host, CASE WHEN page_id % 9 = 0 THEN 'No Email' WHEN page_id % 9 = 1 THEN 'Invalid Email'
  ELSE {_HOST} END AS email_domain FROM pages""")
def domain_extract(t):
    host = url_host(F.col("url"))
    email = (F.when(F.col("page_id") % 9 == 0, F.lit(None)).when(F.col("page_id") % 9 == 1, "nobody")
             .otherwise(F.concat(F.lit("Info@"), F.upper(host), F.lit(" "))))
    return t.pages.select("page_id", host.alias("host"), email_domain(email).alias("email_domain"))


@query("domain_counts", """
SELECT regexp_extract(url, '^([^/]*//[^/]*)', 1) AS origin,
  CASE WHEN contains(url, 'blog') THEN 'Blog' ELSE 'Other Website' END AS site_type, count(*) AS n_pages
FROM pages GROUP BY ALL""")
def domain_counts(t):
    url = F.col("url")
    return t.pages.groupBy(url_origin(url).alias("origin"),
                           logs.marked(url, (("blog", "Blog"),), "Other Website").alias("site_type")).agg(
        n_rows().alias("n_pages"))


_URL = r"^(\w+)://([^/?#]+)(/[^?#]*)?(?:\?([^#]*))?(?:#(.*))?$"


@query("page_url_parts", f"""
SELECT page_id, regexp_extract(url, '{_URL}', 1) AS scheme, regexp_extract(url, '{_URL}', 2) AS host,
  regexp_extract(url, '{_URL}', 3) AS path, regexp_extract(url, '{_URL}', 4) AS query,
  regexp_extract(url, '{_URL}', 5) AS fragment FROM pages""")
def page_url_parts(t):
    names = ("scheme", "host", "path", "query", "fragment")
    return t.pages.select("page_id", *[
        F.regexp_extract("url", _URL, i).alias(name) for i, name in enumerate(names, 1)])


# Logs ------------------------------------------------------------------------

def _logs(t):
    return logs.parse_log(derived.log_lines(t.events))


@query("log_parse_report", f"""
WITH {derived.SQL_LOGS} SELECT count(*) AS total_records, {sql_count('NOT broken')} AS parsed_records,
  {sql_percent(sql_count('NOT broken'), 'count(*)', 2)} AS success_rate, {sql_count('broken')} AS empty_ip,
  {sql_count('broken')} AS empty_date, {sql_count('broken')} AS empty_method, {sql_count('broken')} AS empty_status FROM logs""")
def log_parse_report(t):
    return logs.parse_report(_logs(t))


@query("log_methods", f"""
WITH {derived.SQL_LOGS} SELECT CASE WHEN broken THEN '' ELSE method END AS method, count(*) AS request_count
FROM logs GROUP BY 1""")
def log_methods(t):
    return logs.by_method(_logs(t))


@query("log_status", f"""
WITH {derived.SQL_LOGS} SELECT CASE WHEN broken THEN '' ELSE status END AS status, count(*) AS count,
  CASE WHEN broken THEN 'Unknown' WHEN status[1] = '2' THEN 'Success' WHEN status[1] = '3' THEN 'Redirect'
    WHEN status[1] = '4' THEN 'Client Error' ELSE 'Server Error' END AS status_category FROM logs GROUP BY ALL""")
def log_status(t):
    return logs.by_status(_logs(t))


@query("log_ips", f"""
WITH {derived.SQL_LOGS} SELECT CASE WHEN broken THEN '' ELSE ip END AS ip, count(*) AS request_count FROM logs GROUP BY 1""")
def log_ips(t):
    return logs.by_ip(_logs(t))


@query("log_errors", f"""
WITH {derived.SQL_LOGS} SELECT status, request, count(*) AS error_count FROM good
WHERE CAST(status AS INT) >= 400 GROUP BY ALL""")
def log_errors(t):
    return logs.error_endpoints(_logs(t))


@query("log_referrers", f"""
WITH {derived.SQL_LOGS} SELECT CASE WHEN contains(referrer, 'google') THEN 'Search Engine'
    WHEN contains(referrer, 'facebook') THEN 'Social Media' ELSE 'Other Website' END AS referrer_type,
  regexp_extract(referrer, '^([^/]*//[^/]*)', 1) AS referrer_domain, count(*) AS referral_count
FROM good WHERE referrer <> '-' GROUP BY ALL""")
def log_referrers(t):
    return logs.referrers(_logs(t))


@query("log_browsers", f"""
WITH {derived.SQL_LOGS}, u AS (SELECT CASE WHEN broken THEN '' ELSE user_agent END AS a FROM logs)
SELECT CASE WHEN contains(a, 'Edg') THEN 'Edge' WHEN contains(a, 'Chrome') THEN 'Chrome'
    WHEN contains(a, 'Firefox') THEN 'Firefox' WHEN contains(a, 'Safari') THEN 'Safari'
    WHEN contains(a, 'Mozilla') THEN 'Mozilla' ELSE 'Other' END AS browser, count(*) AS usage_count FROM u GROUP BY 1""")
def log_browsers(t):
    return logs.by_browser(_logs(t))


@query("log_systems", f"""
WITH {derived.SQL_LOGS}, u AS (SELECT CASE WHEN broken THEN '' ELSE user_agent END AS a FROM logs)
SELECT CASE WHEN contains(a, 'Windows') THEN 'Windows' WHEN contains(a, 'Android') THEN 'Android'
    WHEN contains(a, 'iPhone') THEN 'iOS' WHEN contains(a, 'Macintosh') THEN 'MacOS'
    WHEN contains(a, 'Linux') THEN 'Linux' ELSE 'Other' END AS os, count(*) AS count FROM u GROUP BY 1""")
def log_systems(t):
    return logs.by_system(_logs(t))


@query("log_hourly", f"""
WITH {derived.SQL_LOGS} SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS requests FROM good GROUP BY 1""")
def log_hourly(t):
    return logs.hourly_traffic(logs.with_log_time(_logs(t)), "parsed_timestamp")


@query("log_sizes", f"""
WITH {derived.SQL_LOGS} SELECT status, count(*) AS request_count, avg(size_bytes) AS avg_response_size,
  CAST(max(size_bytes) AS BIGINT) AS max_response_size, CAST(sum(size_bytes) AS BIGINT) AS total_bytes
FROM good WHERE size_bytes IS NOT NULL GROUP BY status""")
def log_sizes(t):
    return logs.response_sizes(_logs(t))


@query("log_suspicious", f"""
WITH {derived.SQL_LOGS} SELECT request, status, count(*) AS count FROM good
WHERE contains(request, 'admin') OR contains(request, 'login') OR contains(user_agent, 'bot') GROUP BY ALL""")
def log_suspicious(t):
    return logs.suspicious(_logs(t))


@query("traffic_hourly", "SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS requests FROM events GROUP BY 1")
def traffic_hourly(t):
    return logs.hourly_traffic(t.events, "ts")


@query("traffic_weekday", """
SELECT dayname(ts) AS day_name, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week, count(*) AS requests
FROM events GROUP BY ALL""")
def traffic_weekday(t):
    return logs.weekday_traffic(t.events, "ts")


# Quality ---------------------------------------------------------------------

def _labelled(t):
    return t.documents.join(t.labels, "doc_id", "left")


_LABELLED = "l AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"


@query("dq_profile", f"""
SELECT count(*) AS total_records, {sql_count('l_orderkey IS NULL')} AS null_l_orderkey,
  {sql_count('l_shipdate IS NULL')} AS null_l_shipdate, {sql_count("l_returnflag = 'R'")} AS event_count,
  {sql_percent(sql_count("l_returnflag = 'R'"), 'count(*)', 2)} AS event_rate,
  {sql_count('l_shipdate IS NULL')} AS null_dates, min(l_shipdate) AS min_date, max(l_shipdate) AS max_date FROM lineitem""")
def dq_profile(t):
    return quality.null_profile(t.lineitem, ["l_orderkey", "l_shipdate"], F.col("l_returnflag") == "R", "l_shipdate")


@query("dq_rules", f"""
WITH {_LABELLED} SELECT 'Total Records' AS metric, count(*) AS value FROM l
UNION ALL SELECT 'Null quality', count(*) FROM l WHERE quality IS NULL
UNION ALL SELECT 'Invalid length', count(*) FROM l WHERE n_chars <= 20 OR n_chars > 10000
UNION ALL SELECT 'Length mismatch', count(*) FROM l WHERE n_chars <> length(text)
UNION ALL SELECT 'Toxic and good', count(*) FROM l WHERE quality = 1 AND toxic = 1""")
def dq_rules(t):
    size = F.col("n_chars")
    return quality.rule_violations(_labelled(t), {
        "Null quality": F.col("quality").isNull(), "Invalid length": (size <= 20) | (size > 10000),
        "Length mismatch": size != F.length("text"), "Toxic and good": (F.col("quality") == 1) & (F.col("toxic") == 1)})


@query("dq_completeness", f"""
WITH {_LABELLED}, c AS (SELECT count(*) AS a, count(doc_id) AS n0, count(text) AS n1, count(quality) AS n2 FROM l)
SELECT column_name, a AS total_records, n AS non_null_records, {sql_percent('n', 'a', 2)} AS completeness_pct FROM (
  SELECT 'doc_id' AS column_name, a, n0 AS n FROM c UNION ALL SELECT 'text', a, n1 FROM c
  UNION ALL SELECT 'quality', a, n2 FROM c)""")
def dq_completeness(t):
    return quality.completeness(_labelled(t), ["doc_id", "text", "quality"])


@query("dq_row_score", f"""
WITH {_LABELLED} SELECT doc_id, {sql_round('''((CASE WHEN lang IS NULL OR trim(lang) = '' THEN 0 ELSE 1 END)
  + (CASE WHEN trim(source) = '' THEN 0 ELSE 1 END) + (CASE WHEN quality IS NULL THEN 0 ELSE 1 END))
  * CAST(100 AS DOUBLE) / 3''')} AS completeness_score FROM l""")
def dq_row_score(t):
    return _labelled(t).select("doc_id", quality.row_score(["lang", "source", "quality"]).alias("completeness_score"))


@query("dq_status", f"""
WITH {_LABELLED} SELECT CASE WHEN n_chars < 20 THEN 'Too Short' WHEN quality IS NULL THEN 'Missing Label'
  WHEN toxic = 1 THEN 'Toxic' ELSE 'Valid' END AS validation_status, count(*) AS count FROM l GROUP BY 1""")
def dq_status(t):
    return quality.status_counts(_labelled(t), [
        (F.col("n_chars") < 20, "Too Short"), (F.col("quality").isNull(), "Missing Label"),
        (F.col("toxic") == 1, "Toxic")])


@query("dq_date_status", """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'Invalid' WHEN year(o_orderdate) < 1997 THEN 'Too Old'
  WHEN year(o_orderdate) > 2000 THEN 'Future Date' ELSE 'Valid' END AS validation_status, count(*) AS count
FROM orders GROUP BY 1""")
def dq_date_status(t):
    parsed = date_multi_format(t)
    year = F.year("parsed")
    return quality.status_counts(parsed, [
        (F.col("parsed").isNull(), "Invalid"), (year < 1997, "Too Old"), (year > 2000, "Future Date")])


@query("dq_parse_rate", f"""
SELECT count(*) AS total_records, {sql_count('o_orderkey % 7 <> 0')} AS parsed_records,
  {sql_percent(sql_count('o_orderkey % 7 <> 0'), 'count(*)', 2)} AS success_rate FROM orders""")
def dq_parse_rate(t):
    return quality.parse_rate(date_multi_format(t), F.col("parsed"))


@query("dq_reconcile", "SELECT 'Match' AS outcome, count(DISTINCT l_suppkey) AS groups FROM lineitem")
def dq_reconcile(t):
    price, discount = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    lines = t.lineitem.withColumns({"full_price": price, "given": price * discount, "rev": revenue()})
    return quality.reconcile(lines, ["l_suppkey"], F.sum("rev").cast("decimal(30,4)"),
                             (F.sum("full_price") - F.sum("given")).cast("decimal(30,4)"))


# UDFs ------------------------------------------------------------------------

_SPELLINGS = (" F ", "female", "M", "Male", "man", "woman", "fem", "xx", "", "mal")


def _people(t):
    key = F.col("c_custkey")
    raw = F.when(key % 11 == 0, F.lit(None)).otherwise(derived.pick(_SPELLINGS, key))
    age = F.when(key % 17 == 0, F.lit(None)).otherwise((key % 90).cast("int"))
    return t.customer.select("c_custkey", raw.alias("gender"), age.alias("age"), F.col("c_mktsegment").alias("place"))


_PEOPLE = f"""people AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL
    ELSE {derived.sql_pick(_SPELLINGS, 'c_custkey')} END AS gender,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS INT) END AS age, c_mktsegment AS place FROM customer),
p AS (SELECT *, CASE WHEN regexp_matches(lower(trim(gender)), '^f$|f.m|w.m|female|woman') THEN 'Female'
    WHEN regexp_matches(lower(trim(gender)), '^m$|ma|m.l|male|man') THEN 'Male' ELSE 'Unknown' END AS std FROM people)"""


@query("udf_standardise", f"""
WITH {_PEOPLE} SELECT c_custkey, std AS by_udf, CASE WHEN gender IS NULL THEN 'No Data' ELSE std END AS conditional FROM p""")
def udf_standardise(t):
    people = _people(t).withColumn("by_udf", udfs.standard_category_udf("gender"))
    # The function ran once; the condition reads its result.
    return udfs.apply_where_present(people, "gender", lambda _: F.col("by_udf"), "conditional").select(
        "c_custkey", "by_udf", "conditional")


@query("udf_multi_arg", f"""
WITH {_PEOPLE} SELECT c_custkey, CASE WHEN COALESCE(age, 0) = 0 OR COALESCE(place, '') = '' THEN 'Incomplete Response'
  ELSE std || ' aged ' || age || ' from ' || place END AS profile,
  CASE WHEN COALESCE(age, 0) = 0 OR COALESCE(place, '') = '' THEN 'Incomplete Response'
  ELSE std || ' aged ' || age || ' from ' || place END AS native FROM p""")
def udf_multi_arg(t):
    udfs.register_all(t.spark)
    people = _people(t).withColumn("std", F.expr("standard_category_udf(gender)"))
    return people.select(
        "c_custkey", F.expr("response_summary_udf(age, std, place)").alias("profile"),
        udfs.response_summary(F.col("age"), standard_category(F.col("gender")), F.col("place")).alias("native"))


@query("group_by_expr", f"""
WITH {_PEOPLE} SELECT std AS category, CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN 'Minor'
  WHEN age < 25 THEN 'Young Adult' WHEN age < 35 THEN 'Adult' WHEN age < 50 THEN 'Middle-aged'
  WHEN age < 65 THEN 'Senior' ELSE 'Elderly' END AS age_group, count(*) AS n_people FROM p GROUP BY ALL""")
def group_by_expr(t):
    udfs.register_all(t.spark)
    return t.spark.sql("""
        SELECT standard_category_udf(gender) AS category, age_group_udf(CAST(age AS STRING)) AS age_group,
               COUNT(*) AS n_people
        FROM {people} GROUP BY 1, 2""", people=_people(t))


@query("category_standardise", f"WITH {_PEOPLE} SELECT std AS category, count(*) AS n_people FROM p GROUP BY 1")
def category_standardise(t):
    return _people(t).groupBy(standard_category(F.col("gender")).alias("category")).agg(n_rows().alias("n_people"))


@query("category_exact", f"""
WITH {_PEOPLE} SELECT CASE WHEN lower(trim(gender)) IN ('f', 'female', 'woman') THEN 'Female'
  WHEN lower(trim(gender)) IN ('m', 'male', 'man') THEN 'Male' ELSE 'Unknown' END AS category, count(*) AS n_people
FROM p GROUP BY 1""")
def category_exact(t):
    return _people(t).groupBy(listed_category(F.col("gender")).alias("category")).agg(n_rows().alias("n_people"))


@query("age_bands", """
SELECT CASE WHEN p_size < 18 THEN 'Minor' WHEN p_size < 25 THEN 'Young Adult' WHEN p_size < 35 THEN 'Adult'
  WHEN p_size < 50 THEN 'Middle-aged' WHEN p_size < 65 THEN 'Senior' ELSE 'Elderly' END AS age_group,
  count(*) AS n_parts FROM part GROUP BY 1""")
def age_bands(t):
    return t.part.groupBy(age_group(F.col("p_size").cast("string")).alias("age_group")).agg(n_rows().alias("n_parts"))


@query("quality_grade", f"""
WITH {_PEOPLE}, g AS (SELECT *, (CASE WHEN trim(COALESCE(gender, '')) <> '' THEN 1 ELSE 0 END)
  + (CASE WHEN age > 0 AND age < 120 THEN 1 ELSE 0 END) + (CASE WHEN length(trim(place)) > 1 THEN 1 ELSE 0 END) AS s FROM p)
SELECT CASE s WHEN 3 THEN 'Excellent' WHEN 2 THEN 'Fair' ELSE 'Poor' END AS grade, count(*) AS n_people FROM g GROUP BY 1""")
def quality_grade(t):
    people = _people(t)
    return people.groupBy(udfs.quality_grade(F.col("gender"), F.col("age"), F.col("place")).alias("grade")).agg(
        n_rows().alias("n_people"))
