"""The daily run as an incremental Structured Streaming job.

New announcement items land in a folder; each micro-batch gets the registered
sources' order, enriches short items from the landed pages, assembles the texts,
extracts, parses, stores only signals that are new against everything stored
(uniqueness is eternal and NULL-aware, so this is an anti-join on the table, not
a watermark-bounded dedup), and raises alerts for exactly the rows it stored.

A batch stages its part of every table and publishes all of them with one commit
(``operators/batches.py``); readers see it whole or not at all.  Uniqueness reads
the key index, ids go on from the commits, and only earlier batches count.  Model
responses are committed first, by themselves, and read again instead of asked for
again: a replayed micro-batch (restart after failure) gives the same rows with the
same ids and makes no call.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.text import contains_any
from ..operators import alerts as AL
from ..operators import answers as AN
from ..operators import extract as EX
from ..operators import items as IT
from ..operators import marts as M
from ..operators import store as ST
from ..operators import usage as U
from ..operators.batches import Attempt, BatchStore
from ..operators.ids import assign_ids
from ..schemas import TOKEN_USAGE
from ..sources.feeds import feed_order, stream_feeds


@dataclass
class RunConfig:
    root: str                      # shared folder holding the tables
    order_cols: list[str]          # feed order (first writer wins)
    text_col: str = "text"
    url_col: str = "source_url"
    run_date: str | None = None    # None: the day on which a batch runs
    notify: bool = True
    channels: list[str] = field(default_factory=lambda: list(K.ALERT_CHANNELS))
    threshold_pct: float = K.ALERT_THRESHOLD_PCT
    backend: object = None
    process: str = K.PROCESS_AUTOMATIC
    partitions: int | None = None  # tasks for the extraction of a batch
    # What spares calls of a paid model; off by default, as it changes counts and usage.
    keywords: list[str] | None = None  # O09 before the model: texts with none of these are not asked for
    skip_known_links: bool = False     # items whose link an earlier batch asked for are not asked for again
    answer_scope: str | None = None    # names model and prompt: answers are kept by text (operators/answers.py)
    # The full daily run: batches hold items (source, title, summary, link and
    # the order columns after source_ord), which are made to texts first.
    sources: list[str] = field(default_factory=lambda: [name for name, _ in K.SOURCE_REGISTRY])  # in reading order
    pages: str | None = None           # Parquet table of landed pages (url, html)
    # Parquet table of listing items (the columns of items): a batch is then one
    # run, and sources without an item in it take theirs (only with ``pages``).
    listing: str | None = None

    def store(self, spark: SparkSession) -> BatchStore:
        """The published tables of the run."""
        return BatchStore(spark, self.root)


def texts_of(items: DataFrame, pages: DataFrame, sources: list[str], listing: DataFrame | None = None,
             listing_order: list[str] = ("pos",)) -> DataFrame:
    """O03 (O04 with a listing), O16, O10: items of the registered sources with
    source_ord and the assembled ``text``; the link is their ``source_url``."""
    registry = IT.source_registry(items.sparkSession, sources)
    registered = (IT.union_sources(items, registry) if listing is None
                  else IT.with_fallback(items, listing, registry, fallback_order=listing_order))
    ready = IT.assembled_text(IT.enrich_items(registered, pages).withColumnRenamed("link", "source_url"))
    return ready.drop("text").withColumnRenamed("full_text", "text")


def _worth_asking(texts: DataFrame, store: BatchStore, batch_id: int, cfg: RunConfig) -> DataFrame:
    """The texts that go to the model: before it, since no filter moves through its call."""
    if cfg.keywords is not None:
        texts = texts.where(contains_any(F.col(cfg.text_col), cfg.keywords))
    if cfg.skip_known_links:
        earlier = store.read("responses", T.StructType([texts.schema[cfg.url_col]]), before=batch_id)
        known = earlier.where(F.col(cfg.url_col) != "").distinct()      # an empty link names no item
        texts = texts.join(known, cfg.url_col, "left_anti")
    return texts


def _responses(batch: DataFrame, batch_id: int, cfg: RunConfig) -> DataFrame:
    """The model responses of a batch: asked for once, committed, then read."""
    store = cfg.store(batch.sparkSession)
    keys = [*cfg.order_cols, cfg.url_col]
    if not any(c["batch_id"] == batch_id for c in store.commits("responses")):
        texts, attempt = _worth_asking(EX.guard_blank(batch, cfg.text_col), store, batch_id, cfg), Attempt(batch_id)
        if cfg.answer_scope is None:
            asked = EX.extract_responses(texts, cfg.text_col, keys, cfg.backend, cfg.process, cfg.partitions)
            store.stage(asked, "responses", attempt)
            store.commit(attempt, "responses")
        else:
            AN.stage_responses(texts, cfg.text_col, keys, store, attempt, cfg.answer_scope, cfg.backend, cfg.process, cfg.partitions)
            store.commit(attempt, "responses")
            AN.forget(store, batch_id)
    return store.read("responses", batch_id=batch_id).drop("batch_id")


def _stage_usage(responses: DataFrame, store: BatchStore, attempt: Attempt, cfg: RunConfig, run_date: str) -> None:
    """O34 as a stored table with ids, which go on after earlier batches."""
    usage = U.capture_usage(responses, run_ts=F.lit(run_date + " 06:00:00").cast("timestamp_ntz"))
    base = store.last_ids(attempt.batch_id).get("token_usage", 0)
    store.stage(assign_ids(usage, list(cfg.order_cols), base).select(*TOKEN_USAGE.fieldNames()), "token_usage", attempt, base=base)


def process_batch(batch: DataFrame, batch_id: int, cfg: RunConfig) -> None:
    """One run over one batch of announcements (also usable outside
    streaming, e.g. for a single daily batch)."""
    spark = batch.sparkSession
    run_date = cfg.run_date or dt.date.today().isoformat()
    keys = list(cfg.order_cols)
    if cfg.pages is not None:
        listing = None if cfg.listing is None else spark.read.parquet(cfg.listing)
        batch = texts_of(batch, spark.read.parquet(cfg.pages), cfg.sources, listing,
                         [c for c in keys if c != "source_ord"])
    # 1. model calls: written once, read back by every consumer
    responses = _responses(batch, batch_id, cfg)
    store, attempt = cfg.store(spark), Attempt(batch_id)
    # 2. usage is logged for every call that reports it, relevant or not
    _stage_usage(responses, store, attempt, cfg, run_date)
    # 3. parse + route; refusals and errors go to the quarantine.  The routed
    # rows feed three consumers, so they are kept for the batch; a lost
    # executor recomputes them from the written responses table.
    parsed = EX.parse_responses(responses, run_date=run_date).persist(StorageLevel.MEMORY_AND_DISK)
    counted, seen = M.observe_outcomes(parsed)     # this write reads every routed row, so it counts them too
    store.stage(EX.quarantine_of(counted).select(*keys, "status", "reason", "raw_output"), "quarantine", attempt)
    ok = EX.signals_of(parsed).select(*keys, *K.SIGNAL_KEYS, "amount_text", "extracted_on",
                                      F.col(cfg.url_col).alias("source_url"))
    # 4. store what is new against every earlier batch
    fresh = ST.new_signals(ok, ST.known_keys(store, ok, batch_id), keys)
    stored = ST.append_signals(store, attempt, fresh, keys)
    # 5. counters of the run (items read, outcomes, new signals, duplicates)
    store.stage(M.observed_counters(spark, seen, attempt.rows["price_signals"]), "run_counters", attempt)
    parsed.unpersist()
    # 6. alerts for exactly the rows stored by this batch
    if cfg.notify:
        alerted = AL.with_message(AL.with_alert(stored, cfg.threshold_pct).where("alert"), amount_text="amount_text")
        if cfg.channels:
            store.stage(AL.alert_outbox(alerted, ["id"], cfg.channels, run_date), "alert_outbox", attempt)
        else:             # nothing can be sent: record the warning count
            store.stage(AL.alerts_without_channel(alerted, cfg.channels), "alert_warnings", attempt)
    # 7. all of it becomes visible at once
    store.commit(attempt)


def record_deliveries(spark: SparkSession, deliveries: DataFrame, batch_id: int, cfg: RunConfig, sent_on: str) -> None:
    """Store the alerts of a batch that its channels report as delivered
    (``deliveries``: id, channel, ok) in ``alerts_sent``."""
    store, attempt = cfg.store(spark), Attempt(batch_id)
    outbox = store.read("alert_outbox", batch_id=batch_id).drop("batch_id")
    store.stage(AL.alerts_sent(outbox, deliveries, sent_on), "alerts_sent", attempt)
    store.commit(attempt, "deliveries")


def start_incremental(spark: SparkSession, landing: str, schema: T.StructType, cfg: RunConfig,
                      checkpoint: str, files_per_batch: int | None = None, available_now: bool = True):
    """Start the stream over ``landing`` (Parquet files of announcements)."""
    reader = spark.readStream.format("parquet").schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = (reader.load(landing).writeStream
              .foreachBatch(lambda df, bid: process_batch(df, bid, cfg))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()


def start_from_feeds(spark: SparkSession, feeds: str, cfg: RunConfig, checkpoint: str,
                     files_per_batch: int | None = None, available_now: bool = True):
    """Start the daily run from landed feed files (``<feeds>/source=<name>/*.xml``).  ``cfg`` names the pages (and the
    listing, if there is one, with the columns file and ordinal) and has ``FEED_ORDER`` as its order columns."""
    if cfg.pages is None:
        raise ValueError("feed items need the table of landed pages")
    writer = (stream_feeds(spark, feeds, files_per_batch).writeStream
              .foreachBatch(lambda df, bid: process_batch(feed_order(df), bid, cfg))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
