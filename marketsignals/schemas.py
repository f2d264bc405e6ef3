"""Table schemas (all storage is Parquet)."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()

# One parsed price signal, in record order.
SIGNAL_FIELDS = [
    T.StructField("material", S),
    T.StructField("material_detail", S),
    T.StructField("change_type", S),
    T.StructField("amount", D),
    T.StructField("unit", S),
    T.StructField("currency", S),
    T.StructField("region", S),
    T.StructField("effective_date", S),
    T.StructField("announcement_date", S),
    T.StructField("source_company", S),
    T.StructField("confidence", S),
    T.StructField("summary_pl", S),
]

# Stored signals table: generated id, record, source url, run date, batch.
# ``amount_text`` keeps the amount as the response wrote it (35 vs 35.0),
# which the alert message prints.
STORED_SIGNAL = T.StructType(
    [T.StructField("id", L)] + SIGNAL_FIELDS[:10]
    + [T.StructField("source_url", S)] + SIGNAL_FIELDS[10:]
    + [T.StructField("extracted_on", S), T.StructField("amount_text", S), T.StructField("batch_id", L)]
)
STORED_SIGNAL_COLUMNS = [f.name for f in STORED_SIGNAL.fields]

# Complete uniqueness keys of stored signals, in folders by hash.
SIGNAL_KEY_INDEX = T.StructType([
    *[STORED_SIGNAL[c] for c in ("material", "source_company", "effective_date", "amount")],
    T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", L)])

TOKEN_USAGE = T.StructType([
    T.StructField("id", L),
    T.StructField("process", S, False),
    T.StructField("model", S, False),
    T.StructField("input_tokens", L, False),
    T.StructField("output_tokens", L, False),
    T.StructField("reasoning_tokens", L, False),
    T.StructField("total_tokens", L, False),
    T.StructField("logged_at", T.TimestampNTZType()),
])

ALERT_SENT = T.StructType([
    T.StructField("signal_id", L),
    T.StructField("alert_message", S),
    T.StructField("sent_on", S),
    T.StructField("channel", S),
])

# XML schema of an item of an RSS <channel> element.
RSS_ITEM = T.StructType([
    T.StructField("title", S),
    T.StructField("link", S),
    T.StructField("description", S),
    T.StructField("pubDate", S),
])
