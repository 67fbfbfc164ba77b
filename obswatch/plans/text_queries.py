"""Text, JSON, HTML and grouped blocks over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from obswatch.functions import text as tx
from obswatch.functions.shipping import ship
from obswatch.operators import extract, series
from obswatch.plans.registry import query
from obswatch.plans.tables import read
from obswatch.sources import payloads


@query("""WITH g AS (SELECT conv_id, turn, text, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS block FROM conversations)
SELECT conv_id, block::BIGINT AS block, count(*)::BIGINT AS n_parts, string_agg(text, ' ' ORDER BY turn) AS text FROM g WHERE block > 0 GROUP BY 1, 2""")
def group_continuation_blocks(spark, sf):
    return series.blocks(read(spark, sf, "conversations"), ["conv_id"], "turn", F.col("role") == "user", "text")


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY (role = 'assistant')::INT DESC, turn) AS r FROM conversations) WHERE r = 1")
def one_per_key_preferred(spark, sf):
    c = read(spark, sf, "conversations")
    return series.latest(c, ["conv_id"], F.desc((F.col("role") == "assistant").cast("int")), F.col("turn")).select("conv_id", "turn", "role")


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def page_titles(spark, sf):
    return read(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(replace(translate(text, chr(160) || 'º˚’–', ' °°''-'), '—', ' - '), '\s+', ' ', 'g'))) AS digest FROM documents")
def normalise_text(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.md5(tx.normalised(F.col("text")).cast("binary")).alias("digest"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, sha256(props) AS digest, props[1:5] AS head FROM events")
def tolerant_numbers(spark, sf):
    return read(spark, sf, "events").select("event_id", tx.number(F.get_json_object("props", "$.k")).alias("k"), F.sha2("props", 256).alias("digest"), tx.squeezed(F.col("props"), 5).alias("head"))


@query()
def html_blocks(spark, sf):
    ship(spark)
    return extract.page_blocks(read(spark, sf, "pages").select("page_id", "html"))


_SAID = "SELECT conv_id AS page_id, (DATE '2024-12-20' + turn::INT)::DATE AS report_date, (length(text) % 700)::INT AS count_researchers, (turn % 40 + 45)::DOUBLE AS river_temp_f, turn FROM conversations"


@query(f"""WITH said AS ({_SAID}), kept AS (SELECT *, row_number() OVER (PARTITION BY page_id, report_date ORDER BY turn) AS r FROM said)
SELECT page_id, report_date, count_researchers, river_temp_f, NOT river_temp_f BETWEEN 50 AND 80 AS needs_review FROM kept WHERE r = 1""")
def dated_reports(spark, sf):
    """Pages made of conversations, in dated paragraphs, through the extraction."""
    ship(spark)
    c = read(spark, sf, "conversations")
    day = F.date_format(F.date_add(F.lit("2024-12-20").cast("date"), F.col("turn").cast("int")), "MMMM d, yyyy")
    said = F.concat(F.lit("<p>"), day, F.lit(": we counted "), (F.length("text") % 700).cast("string"), F.lit(" animals; the river was "), (F.col("turn") % 40 + 45).cast("string"), F.lit("°F.</p>"))
    parts = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", said.alias("p")))).alias("ps"))
    pages = parts.select(F.col("conv_id").alias("page_id"), F.concat(F.lit("<html><title>Season 2024-2025</title><body>"), F.array_join(F.transform("ps", lambda x: x["p"]), ""), F.lit("</body></html>")).alias("html"))
    rows = extract.page_rows(pages, dt.date(2025, 3, 1))
    return extract.reports(rows).select("page_id", "report_date", "count_researchers", "river_temp_f", "needs_review")


@query("SELECT c_nationkey::BIGINT AS station, i::INT AS i, (DATE '2024-01-01' + i::INT)::DATE AS obs_date, CASE WHEN i % 3 = 2 THEN NULL ELSE c_nationkey + i / 2.0 END::DOUBLE AS low FROM (SELECT DISTINCT c_nationkey FROM customer), range(5) r(i)")
def parallel_arrays_to_rows(spark, sf):
    """Column-oriented JSON with equally long arrays, as rows."""
    n = read(spark, sf, "customer").select("c_nationkey").distinct()
    values = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i % 3 != 2, F.col("c_nationkey") + i / 2.0))
    times = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.date_add(F.lit("2024-01-01").cast("date"), i).cast("string"))
    raw = n.select("c_nationkey", F.to_json(F.struct(F.struct(times.alias("time"), values.alias("low")).alias("daily")), {"ignoreNullFields": "false"}).alias("payload"))
    rows = payloads.parallel_rows(raw, "payload", "daily", ["low"])
    return rows.select(F.col("c_nationkey").cast("long").alias("station"), F.col("position").alias("i"), F.to_date("time").alias("obs_date"), "low")
