"""Words, log lines and parsing."""

from pyspark.sql import functions as F

from millrace.checks import roles
from millrace.checks.registry import check
from millrace.functions import text
from millrace.operators import quality
from millrace.plans import reports, shop


@check(
    "word_count",
    r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents) WHERE word <> ''
    GROUP BY 1""",
)
def word_count(t):
    return text.word_counts(t.documents.select("text"))


@check(
    "word_count_lower",
    r"""
    SELECT lower(word) AS word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM conversations) WHERE word <> ''
    GROUP BY 1""",
)
def word_count_lower(t):
    return text.word_counts(t.conversations.select("text"), lower=True)


_CLEAN = r"""
    SELECT regexp_replace(lower(word), '[^a-z0-9]', '', 'g') AS word
    FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)"""


@check("word_count_clean", f"SELECT word, count(*) AS n FROM ({_CLEAN}) WHERE word <> '' GROUP BY 1")
def word_count_clean(t):
    return text.word_counts(t.documents.select("text"), clean=True)


@check(
    "top_words",
    f"""
    SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS position
    FROM (SELECT word, count(*) AS n FROM ({_CLEAN}) WHERE word <> '' GROUP BY 1)
    ORDER BY n DESC, word LIMIT 10""",
)
def top_words(t):
    return reports.top_words(t.documents.select("text"))


@check(
    "clean_text",
    """
    SELECT doc_id, upper(trim(lang)) AS lang, lower(source) AS source,
           length(regexp_replace(text, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g')) AS stripped_chars
    FROM documents""".replace("\\\\", "\\"),
)
def clean_text(t):
    return t.documents.select(
        "doc_id",
        F.upper(F.trim("lang")).alias("lang"),
        F.lower("source").alias("source"),
        F.length(text.strip(F.col("text"))).alias("stripped_chars"),
    )


@check(
    "log_error_filter",
    "SELECT 'ERROR ' || props AS value FROM events WHERE event_type = 'error'",
)
def log_error_filter(t):
    return reports.error_lines(roles.level_lines(t))


@check("log_error_count", "SELECT count(*) AS n FROM events WHERE event_type = 'error'")
def log_error_count(t):
    return reports.error_lines(roles.level_lines(t)).agg(F.count("*").alias("n"))


@check("log_level_count", "SELECT upper(event_type) AS level, count(*) AS n FROM events GROUP BY 1")
def log_level_count(t):
    return reports.level_counts(roles.level_lines(t))


@check(
    "parse_rows",
    f"""
    WITH src AS ({roles.ORDER_FIELDS_SQL})
    SELECT order_id, customer_id, product_id, TRY_CAST(qty AS BIGINT) AS qty,
           TRY_CAST(price AS DOUBLE) AS price, order_date, lower(status) AS status
    FROM src
    WHERE NOT short_line AND order_id <> '' AND TRY_CAST(qty AS BIGINT) > 0
      AND TRY_CAST(price AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(price AS DOUBLE))""",
)
def parse_rows(t):
    return quality.valid_only(quality.parse_delimited(roles.order_lines(t), shop.ORDER_LINE))


@check(
    "parse_counts",
    f"""
    WITH src AS ({roles.ORDER_FIELDS_SQL})
    SELECT count(*) AS total, count(*) - count(CASE WHEN NOT short_line AND order_id <> ''
             AND TRY_CAST(qty AS BIGINT) > 0 AND TRY_CAST(price AS DOUBLE) > 0
             AND NOT isnan(TRY_CAST(price AS DOUBLE)) THEN 1 END) AS bad
    FROM src""",
)
def parse_counts(t):
    parsed = quality.parse_delimited(roles.order_lines(t), shop.ORDER_LINE)
    return parsed.agg(F.count("*").alias("total"), F.count_if(~F.col("is_valid")).alias("bad"))
