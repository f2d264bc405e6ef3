"""Secret scans with multipart credential linking, with DataFrame operations only.

Three kinds are reported wherever they stand (assign, access, hex).  Weak
candidates - identifier-like, secret-like and endpoint-like strings - are only
reported when complementary parts co-occur in their scope, which reaches
``scope`` code points to both sides within the document:

* an identifier needs a secret, a secret needs an identifier;
* an endpoint needs both.

Found parts join as intervals: every part is listed in the bins of ``scope``
code points that it touches, a weak candidate looks into the bins of its scope.
Parts of one kind don't overlap, so a bin holds a bounded number of them, however
long its document is.  Texts are read once; joins carry positions only.

Defined results: a null text is empty; offsets are code points, end exclusive;
rows that repeat are reported each; a weak candidate that overlaps a reported
kind is left to that; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bind, materialize, text_key

SCOPE = 200
# Kinds in the order in which spans with one start are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]{24,}"}
# A part may follow '=' and stand before a '.' that ends a word.  Repeats are possessive: time grows with the text only.
_EDGE, _END = r"(?<![A-Za-z0-9+/_.-])", r"(?!\.?[A-Za-z0-9+/_=-])"
WEAK = {
    "identifier_part": _EDGE + r"(?=[A-Z]*+[0-9])[A-Z0-9]{16,}+" + _END,
    "secret_part": _EDGE + r"(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{32,}+={0,2}+" + _END,
    "endpoint_part": r"(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9]*+(?:\+[A-Za-z0-9]++){0,3}+://[A-Za-z0-9.:@-]+",
}
KINDS = [*BASE, *WEAK]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier_part": "identifier",
        "secret_part": "secret", "endpoint_part": "endpoint"}
_SPANS = "array<struct<start:int,end:int>>"
_STEP = 64


def positions(found: Column, between: Column) -> Column:
    """Start and end of every match, from the matches and the pieces around them.

    Lengths are summed in blocks of 64, so the work for n matches grows little
    faster than n.
    """
    sizes = F.transform(F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("p")),
                        lambda x: F.struct(F.length(x["p"]).alias("p"), F.length(x["m"]).alias("m")))

    def block_spans(block: Column, offset: Column) -> Column:
        zero = F.struct(offset.alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("out"))
        return F.aggregate(block, zero, lambda acc, x: F.struct(
            (acc["at"] + x["p"] + x["m"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["p"]).alias("start"),
                                                  (acc["at"] + x["p"] + x["m"]).alias("end")))).alias("out")))["out"]

    def spread(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x["p"] + x["m"]))
        offsets = F.aggregate(totals, F.array(F.lit(0)),
                              lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t)))
        return bind(offsets, lambda off: F.flatten(F.transform(blocks, lambda b, i: block_spans(b, F.get(off, i)))))

    cut = bind(sizes, lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _STEP).cast("int")),
                                            lambda b: F.slice(s, b * _STEP + 1, _STEP)))
    return F.when(F.size(found) > 0, bind(cut, spread)).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def _scan(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rid, doc_id, one array of spans a kind), written down: the only reading of the texts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    regex = BASE | WEAK
    rows = docs.select(F.col(doc_id).alias("doc_id"), *text_key(text), whole.alias("text"),
                       *[F.regexp_extract_all(whole, F.lit(r), F.lit(0)).alias(f"m_{k}") for k, r in regex.items()])
    cols = []
    for kind, r in regex.items():
        found = F.col(f"m_{kind}")
        spans = positions(found, F.split("text", r, -1))
        if kind == "assign":    # matches with short values are found, and dropped
            long = F.transform(found, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
            spans = bind(long, lambda ok: F.filter(spans, lambda _, i: F.get(ok, i)))
        elif kind == "access":
            spans = F.filter(spans, lambda s: s["end"] - s["start"] >= 20)
        cols.append(F.when(F.size(found) > 0, spans).otherwise(F.expr(f"cast(array() as {_SPANS})")).alias(kind))
    return materialize(rows.select("doc_id", "k1", "k2", *cols).withColumn("rid", F.monotonically_increasing_id()), "parts")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """(rid, weak): the weak candidates of each document that complementary parts support."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(ROLE[kind]).alias("role"), F.lit(kind).alias("kind"),
                                                    s["start"].alias("start"), s["end"].alias("end")))

    def listed(kinds) -> Column:
        return F.flatten(F.array(*map(named, kinds)))

    weak_any = sum((F.size(k) for k in WEAK), F.lit(0)) > 0
    rows = parts.where(weak_any)
    seen = (rows.select("rid", F.inline(listed(KINDS)))
            .select("rid", F.col("role").alias("p_role"), F.col("kind").alias("p_kind"), F.col("start").alias("p_start"),
                    F.col("end").alias("p_end"),
                    F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))).alias("bin")))
    weak = (rows.select("rid", F.inline(listed(WEAK)))
            .withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope),
                                                    F.floor((F.col("end") + scope - 1) / scope)))))
    pairs = weak.join(seen, ["rid", "bin"]).where(
        (F.col("p_start") < F.col("end") + scope) & (F.col("start") < F.col("p_end") + scope))
    other = (F.col("p_start") >= F.col("end")) | (F.col("start") >= F.col("p_end"))
    one = pairs.groupBy("rid", "kind", "role", "start", "end").agg(
        F.max(other & (F.col("p_role") == "identifier")).alias("id"),
        F.max(other & (F.col("p_role") == "secret")).alias("secret"),
        F.max(~other & F.col("p_kind").isin(*BASE)).alias("known"))
    complete = (F.when(F.col("role") == "identifier", F.col("secret")).when(F.col("role") == "secret", F.col("id"))
                .otherwise(F.col("id") & F.col("secret")))
    return (one.where(complete & ~F.col("known")).groupBy("rid")
            .agg(F.collect_list(F.struct("start", "end", "kind")).alias("weak")))


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, base and spans (arrays of start, end, kind in reading order), n_assign, n_access,
    n_hex, k1 and k2 (the text's key)."""
    parts = _scan(docs, doc_id, text)

    def ordered(spans: Column) -> Column:
        rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"),
                                                      s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                   s["kind"].alias("kind")))

    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    base = F.flatten(F.array(*map(named, BASE)))
    out = parts.join(_linked(parts, scope), "rid", "left").withColumn("base", ordered(base))
    extra = F.coalesce("weak", F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)"))
    return out.select("doc_id", "base", F.when(F.size(extra) > 0, ordered(F.concat("base", extra))).otherwise(F.col("base"))
                      .alias("spans"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], "k1", "k2")


def span_list(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch under spans (in order of start) replaced by a mark."""
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(piece))).alias("out"))

    done = F.aggregate(spans, zero, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return secret_spans(docs).select("doc_id", "n_assign", "n_access", "n_hex",
                                     F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
                                     span_list(F.col("spans")).alias("spans"))
