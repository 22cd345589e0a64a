"""Command-line jobs for spark-submit. Each handles all symbols and days at once;
``--symbol`` and ``--event_date`` narrow it.

    spark-submit ... run_job.py features --input_path ... --output_path ...
"""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickforge.functions.codec import decode
from tickforge.operators.bars import price_bars
from tickforge.operators.chunks import TRADES_PER_CHUNK
from tickforge.operators.documents import typed_documents
from tickforge.operators.enrich import enrich_asof
from tickforge.operators.filters import has_keys, partition_filter
from tickforge.operators.labels import save_label_counts, saved_labels
from tickforge.operators.messages import as_records, trade_messages
from tickforge.operators.quality import preview
from tickforge.operators.recos import flatten_recos, latest_as_of, latest_if_current
from tickforge.plans.completeness import require_complete, table_completeness
from tickforge.plans.features import trade_features, typed_trades, unreadable_times
from tickforge.plans.market import enrich_market
from tickforge.schemas import (
    BARS,
    KEYS,
    LABEL_COLUMNS,
    RECO_MESSAGE,
    RECOS,
    SYMBOLS,
    TRADE_FEATURES,
    TRADE_MESSAGE,
)
from tickforge.session import build_session, require_utc, session_conf, staged
from tickforge.sinks.files import export_json_lines, show_rows, write_table, write_topic
from tickforge.sources.files import read_json_arrays, read_table
from tickforge.sources.streams import folder_stream, record_stream, topic_stream
from tickforge.streaming.bars import bars_query
from tickforge.streaming.chunks import chunk_query, flush_chunks
from tickforge.streaming.landing import (
    LANDING_CONF,
    MESSAGE_SCHEMAS,
    console_query,
    landing_query,
    landing_steps,
    read_landed,
    read_misfits,
    redrive_query,
)
from tickforge.streaming.totals import totals_query


def _raw(spark, args, feed, schema, **days):
    """Raw messages of the symbol and days asked for; other folders are not read.

    What cannot be typed goes to ``--rejects_path``, if that is given.
    """
    if args.raw_layout == "arrays":
        return read_json_arrays(spark, args.input_path, schema, args.symbol, days.get("event_date"))
    if args.rejects_path:
        misfits = read_misfits(spark, args.input_path, feed, args.symbol, **days)
        misfits.write.mode("append").json(args.rejects_path)
    return read_landed(spark, args.input_path, feed, args.symbol, **days)


def _write(args, df, **options):
    if args.debug:
        df.printSchema()
        show_rows(preview(df, 10), 10, False)
    write_table(df, args.output_path, **options)


def features(spark: SparkSession, args) -> None:
    """Raw trades to the feature table.

    JSON is parsed once, into a staged columnar table that the following passes
    read with column pruning. Rows leave the rolling shuffle grouped by key, so the
    write adds no shuffle. With ``--labels_path`` the days' label counts are saved there and
    codes follow the counts of all saved days; without, those of this run.
    """
    raw = _raw(spark, args, "trades", TRADE_MESSAGE, event_date=args.event_date)
    if args.rejects_path:
        unread = unreadable_times(raw).select(F.to_json(F.struct("*")).alias("value"))
        unread = unread.withColumn("reason", F.lit("bad time"))
        unread.write.mode("append").json(args.rejects_path)
    trades = partition_filter(typed_trades(raw), args.symbol, args.event_date)
    scope, labels = KEYS if args.code_scope == "day" else (), None
    with staged(trades, "typed-trades") as typed:
        if args.require_symbols:
            require_complete(typed, args.require_symbols, args.event_date)
        if args.labels_path:
            save_label_counts(typed, args.labels_path, LABEL_COLUMNS)
            labels = saved_labels(spark, args.labels_path)
        table = trade_features(typed, labels, scope, on_null_label=args.on_null_label)
        _write(args, table, rebalance=False)
    if args.completeness_path:
        symbols = args.require_symbols or SYMBOLS
        found = table_completeness(spark, args.output_path, symbols, args.event_date)
        found.write.mode("overwrite").json(args.completeness_path)


def bars(spark: SparkSession, args) -> None:
    """Feature table to bars."""
    table = read_table(spark, args.input_path, TRADE_FEATURES, args.symbol, args.event_date)
    _write(args, price_bars(table, args.window_size))


def recos(spark: SparkSession, args) -> None:
    """Raw recommendations to the full history, up to ``--event_date`` if given."""
    flat = flatten_recos(_raw(spark, args, "recos", RECO_MESSAGE, until=args.event_date), args.symbol)
    _write(args, partition_filter(flat, until=args.event_date))


def latest_recos(spark: SparkSession, args) -> None:
    """Recommendation history to one latest row per symbol as of ``--event_date``.

    Rows written for earlier dates stay in the table, in their own partitions.
    """
    history = read_table(spark, args.input_path, RECOS, args.symbol)
    pick = latest_if_current if args.only_if_current else latest_as_of
    _write(args, pick(history, args.event_date))


def enrich(spark: SparkSession, args) -> None:
    """Bars and recommendation history to the enriched table."""
    table = read_table(spark, args.bars_path, BARS, args.symbol, args.event_date)
    history = read_table(spark, args.recos_path, RECOS, args.symbol, until=args.event_date)
    _write(args, enrich_asof(table, history))


def market(spark: SparkSession, args) -> None:
    """Feature table and recommendation history straight to the enriched table."""
    trades = read_table(spark, args.input_path, TRADE_FEATURES, args.symbol, args.event_date)
    history = read_table(spark, args.recos_path, RECOS, args.symbol, until=args.event_date)
    _write(args, enrich_market(trades, history, args.window_size))


def documents(spark: SparkSession, args) -> None:
    """Feature table to typed JSON-lines documents."""
    table = read_table(spark, args.input_path, TRADE_FEATURES, args.symbol, args.event_date)
    made = typed_documents(table.drop("timestamp_parsed", "id"))
    export_json_lines(made, args.output_path, KEYS)


def _records(spark, args):
    if args.brokers:
        return topic_stream(
            spark, args.brokers, args.topic, args.max_per_trigger, args.min_partitions
        )
    read = record_stream if args.records else folder_stream
    return read(spark, args.input_path, args.max_per_trigger)


def _run(spark, args, writer):
    if args.once:
        writer = writer.trigger(availableNow=True)
    with session_conf(spark, LANDING_CONF):
        writer.start().awaitTermination()


def land(spark: SparkSession, args) -> None:
    """A topic, or a folder of JSON lines, into the raw zone; runs until stopped."""
    where = _records(spark, args), args.output_path, args.checkpoint, args.feed
    if args.gather_after:
        _run(spark, args, landing_steps(*where, args.gather_after))
    else:
        _run(spark, args, landing_query(*where, args.records_per_file))


def watch(spark: SparkSession, args) -> None:
    """Print the first messages of every trigger."""
    _run(spark, args, console_query(_records(spark, args)))


def publish(spark: SparkSession, args) -> None:
    """Landed trades as keyed records, to a topic or into a folder of saved records."""
    raw = read_landed(spark, args.input_path, "trades", args.symbol, args.event_date)
    records = as_records(trade_messages(typed_trades(raw)), keyed=True)
    if args.brokers:
        write_topic(records, args.brokers, args.topic)
    else:
        records.write.mode("append").json(args.output_path)


def chunk(spark: SparkSession, args) -> None:
    """A topic or folder into arrays of ``--size`` messages of one symbol and day.

    Messages of one trigger are in the order of their offsets, those of a folder in a fixed
    order by content.
    """
    schema = MESSAGE_SCHEMAS[args.feed]
    records = _records(spark, args)
    order = "offset" if "offset" in records.columns else "_line"
    arriving = records if order == "offset" else records.withColumn("_line", F.xxhash64("value"))
    kept = StructType([*schema.fields, StructField(order, LongType())])
    messages = arriving.select(order, decode("value", schema)).select(*kept.names)
    messages = messages.where(has_keys())
    writer = chunk_query(messages, args.output_path, args.checkpoint, [order], args.size, args.wait)
    _run(spark, args, writer)
    if args.once and args.flush:
        flush_chunks(spark, args.output_path, kept, [order], size=args.size)


def total(spark: SparkSession, args) -> None:
    """Running counts of a topic's messages by feed and outcome."""
    _run(spark, args, totals_query(_records(spark, args), args.output_path, args.checkpoint, args.feed))


def stream_bars(spark: SparkSession, args) -> None:
    """A topic or folder of trades into final bars."""
    trades = typed_trades(_records(spark, args).select(decode("value", TRADE_MESSAGE)))
    writer = bars_query(trades, args.output_path, args.checkpoint, args.window_size, args.delay)
    _run(spark, args, writer)


def redrive(spark: SparkSession, args) -> None:
    """Refused messages of a raw zone, mended by an SQL expression over ``value``, into another."""
    repair = args.repair
    writer = redrive_query(
        spark, args.input_path, args.output_path, args.checkpoint, lambda _: F.expr(repair), args.feed
    )
    _run(spark, args, writer)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tickforge")
    commands = parser.add_subparsers(dest="job", required=True)

    def command(run, *paths, output="output_path"):
        sub = commands.add_parser(run.__name__.replace("_", "-"), help=run.__doc__.split("\n")[0])
        sub.set_defaults(run=run)
        for path in filter(None, (*paths, output)):
            sub.add_argument(f"--{path}", required=True)
        sub.add_argument("--symbol")
        sub.add_argument("--event_date", help="YYYY-MM-DD")
        sub.add_argument("--debug", action="store_true", help="show schema and rows (extra job)")
        return sub

    sub = command(features, "input_path")
    sub.add_argument("--raw_layout", choices=["landed", "arrays"], default="landed")
    sub.add_argument("--rejects_path", help="landed messages with a field of a wrong type")
    sub.add_argument("--code_scope", choices=["input", "day"], default="input")
    sub.add_argument(
        "--require_symbols", nargs="*", help="fail unless these have data; none named = default six"
    )
    sub.add_argument("--labels_path", help="label counts by day, refitted with the days read")
    sub.add_argument("--on_null_label", choices=["error", "keep"], default="error")
    sub.add_argument("--completeness_path", help="rows and files per expected symbol and day")
    command(bars, "input_path").add_argument("--window_size", default="1 minute")
    sub = command(recos, "input_path")
    sub.add_argument("--raw_layout", choices=["landed", "arrays"], default="landed")
    sub.add_argument("--rejects_path", help="landed messages with a field of a wrong type")
    sub = command(latest_recos, "input_path")
    sub.add_argument("--only_if_current", action="store_true")
    command(enrich, "bars_path", "recos_path")
    command(market, "input_path", "recos_path").add_argument("--window_size", default="1 minute")
    command(documents, "input_path")

    def streaming(run, feed_help, **feed):
        sub = command(run, output=None if run is watch else "output_path")
        sub.add_argument("--input_path")
        sub.add_argument("--checkpoint", required=run is not watch)
        sub.add_argument("--feed", choices=["trades", "recos", "news"], help=feed_help, **feed)
        sub.add_argument("--once", action="store_true", help="process what is there, then stop")
        if run is not redrive:
            sub.add_argument("--brokers")
            sub.add_argument("--topic")
            sub.add_argument("--records", action="store_true", help="input has saved topic records")
            sub.add_argument("--max_per_trigger", type=int)
            sub.add_argument("--min_partitions", type=int)
        return sub

    mixed = "none for a mixed topic"
    sub = streaming(land, mixed)
    sub.add_argument("--records_per_file", type=int)
    sub.add_argument("--gather_after", type=int, help="write so many triggers again as one")
    streaming(watch, "not used")
    sub = command(publish, "input_path", output=None)
    for name in ("brokers", "topic", "output_path"):
        sub.add_argument(f"--{name}")
    sub = streaming(chunk, "what the messages are", default="trades")
    sub.add_argument("--size", type=int, default=TRADES_PER_CHUNK)
    sub.add_argument("--wait", default="10 minutes", help="a short array leaves after that long")
    sub.add_argument("--flush", action="store_true", help="with --once, let short arrays go")
    streaming(total, mixed)
    sub = streaming(stream_bars, "trades only")
    sub.add_argument("--window_size", default="1 minute")
    sub.add_argument("--delay", default="10 minutes", help="how late a trade may come")
    streaming(redrive, mixed).add_argument("--repair", required=True, help="SQL over value")
    return parser


def parse(argv=None) -> argparse.Namespace:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "require_symbols", None) == []:
        args.require_symbols = SYMBOLS
    if getattr(args, "require_symbols", None) and not args.event_date:
        parser.error("--require_symbols needs --event_date")
    if args.job == "latest-recos" and not args.event_date:
        parser.error("latest-recos needs --event_date")
    if getattr(args, "labels_path", None) and (args.symbol or args.code_scope == "day"):
        parser.error("--labels_path counts whole days of all symbols")
    if args.job == "publish" and not (args.output_path or (args.brokers and args.topic)):
        parser.error("publish needs --output_path, or --brokers and --topic")
    if hasattr(args, "once"):
        brokers = getattr(args, "brokers", None) and args.topic
        if not (args.input_path or brokers):
            parser.error(f"{args.job} needs --input_path, or --brokers and --topic")
    return args


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or build_session(f"tickforge {args.job}")
    require_utc(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
