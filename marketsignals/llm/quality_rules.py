"""Quality rules as a bitmask ledger, with DataFrame operations only.

Every rule is evaluated once per document.  The ledger stores the measurements
and one bit for each rule that fails; policies are versioned masks that are
applied to the bits later, and ablations come from counts per bit pattern - of
which there are at most 2 to the number of rules - without reading texts again.

All work on a text stays in its row; nothing is shuffled but the ablation's
counts.  Defined results: a null text has no words, fails few_words and has
measurements 0; rows that repeat are judged each; other columns are kept unless
a ledger column has their name; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bind, named, SPACE_RUN

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")

# Rule name -> fails when; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 70 * n_lines",
    "long_words": "word_chars > 40 * n_words",
    "capitals": "n_words >= 10 and n_letters >= 40 and 100 * n_upper > 70 * n_letters",
}
BASE_RULES = ("few_words", "repeated_words")
# Version -> the rules that reject.  Versions are only added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "capitals"),
    "v2": (*BASE_RULES, "symbols", "repeated_lines", "long_words", "capitals"),
}
CURRENT = "v2"


def mask(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that are found twice or more in the array, by 64-bit hashes of the windows."""
    def covered(wins: Column) -> Column:
        keyed = F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            at = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
            start = F.array_sort(F.transform(at, lambda x: x["i"]))
            return F.aggregate(start, F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
                               lambda acc, i: F.struct((i + window).alias("end"),
                                                       (acc["total"] + i + window - F.greatest(i, acc["end"])).alias("total")),
                               lambda acc: acc["total"])

        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), 0).otherwise(bind(keyed, count))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - window),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(window)]))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < window, 0).otherwise(bind(bind(hashes, windows), covered))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the measurements."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.array_remove(F.split(whole, SPACE_RUN), "")

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
                        repeat_words(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))

    # Arrays of structs expand through inline, a barrier that keeps later filters from measuring again.
    rest = F.struct(F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
                    F.regexp_count(whole, F.lit("[A-Za-z]")).alias("n_letters"),
                    F.regexp_count(whole, F.lit("[A-Z]")).alias("n_upper"))
    kept = [named(c) for c in docs.columns if c.lower() not in MEASURES]
    every = F.array(F.struct(bind(words, of_words).alias("w"), bind(lines, of_lines).alias("l"), rest.alias("r")))
    rows = docs.select(*kept, F.inline(every))
    return rows.select(*kept, *[F.col(f"{s}.{m}").cast("long").alias(m) for s, ms in (
        ("w", ("n_words", "word_chars", "n_repeat_words")), ("l", ("n_lines", "n_dup_lines")),
        ("r", ("n_symbols", "n_letters", "n_upper"))) for m in ms])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with measurements and fail_bits."""
    rows = measure(docs, text)
    rows = rows.select(*[named(c) for c in rows.columns if c.lower() != "fail_bits"])
    bits = sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(0) for i, rule in enumerate(RULES.values())), F.lit(0))
    return rows.withColumn("fail_bits", bits.cast("long"))


def passes(version: str = CURRENT) -> Column:
    """Whether the ledger row passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0


def ablations(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and that only it rejects (kept without it)."""
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    each = patterns.select("fail_bits", "n", F.explode(F.array(*map(F.lit, POLICIES[version]))).alias("rule"))
    names = F.create_map(*[x for i, r in enumerate(RULES) for x in (F.lit(r), F.lit(1 << i))])
    bit = F.element_at(names, F.col("rule")).cast("long")
    on = F.col("fail_bits").bitwiseAND(bit) != 0
    only = F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) == bit
    return each.groupBy("rule").agg(F.sum(F.when(on, F.col("n")).otherwise(0)).alias("n_failed"),
                                    F.sum(F.when(only, F.col("n")).otherwise(0)).alias("n_only"))


def op8(spark, sf_dir: str) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes("base")).alias("base_failed"), passes().alias("kept"), "fail_bits")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM m),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS c FROM g),
r AS (
  SELECT doc_id, sum(least(5, i - coalesce(p, -9))) AS n FROM (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM h WHERE c > 1) GROUP BY doc_id),
x AS (
  SELECT m.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         n_letters, n_upper FROM m LEFT JOIN r USING (doc_id)),
b AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (100 * n_symbols > 30 * n_words)::BIGINT + 8 * (n_lines >= 4 AND 100 * n_dup_lines > 70 * n_lines)::BIGINT
    + 16 * (word_chars > 40 * n_words)::BIGINT
    + 32 * (n_words >= 10 AND n_letters >= 40 AND 100 * n_upper > 70 * n_letters)::BIGINT AS fail_bits FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits FROM b
"""
