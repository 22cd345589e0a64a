"""Every registered query. Dates and instants are given as text and floating
results rounded to six places, so that two engines can be compared exactly."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import adapters as given
from tickforge.functions import calendar, clock, columns
from tickforge.functions.codec import FAITHFUL, decode, encode
from tickforge.operators import (
    bars,
    chunks,
    documents,
    enrich,
    filters,
    labels,
    messages,
    quality,
    recos,
    rolling,
)
from tickforge.plans import features, market
from tickforge.plans.completeness import table_completeness
from tickforge.schemas import CONDITION_CODES, ENRICHED_COLUMNS, FEATURE_COLUMNS, LABEL_COLUMNS
from tickforge.schemas import KEYS, RECO_COUNTS, RECOS, TRADE_MESSAGE
from tickforge.session import run_folder, session_conf, stage
from tickforge.sinks import files as sinks
from tickforge.sources import files as sources
from tickforge.sources import streams
from tickforge.streaming import bars as streamed_bars
from tickforge.streaming import chunks as streamed_chunks
from tickforge.streaming import landing, totals

DAY = "2024-01-10"


_AS_TEXT = {
    "date": "date_format(`{0}`, 'yyyy-MM-dd') as `{0}`",
    "timestamp": "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as `{0}`",
    "double": "round(`{0}`, 6) as `{0}`",
}


def _text(df):
    """Dates and timestamps to text, doubles rounded."""
    return df.selectExpr(*[_AS_TEXT.get(kind, "`{0}`").format(name) for name, kind in df.dtypes])


def _flat_bars(df):
    return _text(df.select(F.col("window.start").alias("bar_start"), "*").drop("window"))


def time_parts(spark, sf):
    return given.trades(spark, sf).select("id", *_aliased(clock.time_parts("timestamp_parsed")))


def _aliased(columns_by_name):
    return [column.alias(name) for name, column in columns_by_name.items()]


def epoch_roundtrip(spark, sf):
    whole = given.trades(spark, sf).select(
        "id", F.unix_timestamp("timestamp_parsed").alias("timestamp_epoch")
    )
    return _text(bars.ensure_timestamp(whole))


def parse_timestamps(spark, sf):
    text = given.trades(spark, sf).select("id", clock.iso_text("timestamp_parsed").alias("t"))
    return _text(text.select("id", "t", clock.parse_timestamp("t").alias("parsed")))


def condition_flags(spark, sf):
    flags = {n: columns.array_flag("conditions", c) for n, c in CONDITION_CODES.items()}
    return given.trades(spark, sf).select("id", *_aliased(flags))


def _index(column):
    def query(spark, sf):
        trades = given.trades(spark, sf)
        fitted = labels.fit_labels(trades, [column])
        code = LABEL_COLUMNS[column]
        return labels.apply_labels(trades, fitted, {column: code}).select("id", column, code)

    return query


def index_exchange_by_day(spark, sf):
    trades = given.trades(spark, sf)
    fitted = labels.fit_labels(trades, ["exchange"], scope=KEYS)
    coded = labels.apply_labels(trades, fitted, {"exchange": "exchange_index"})
    return coded.select("id", "exchange", "exchange_index")


def index_exchange_merged(spark, sf):
    """Codes from label counts that were saved in two goes, one day in both."""
    root = run_folder(spark, "labels")
    trades = given.trades(spark, sf)
    for part in ("event_date <= '{}'", "event_date >= '{}'"):
        labels.save_label_counts(trades.where(part.format(DAY)), root, LABEL_COLUMNS)
    coded = labels.apply_labels(trades, labels.saved_labels(spark, root), LABEL_COLUMNS)
    return coded.select("id", "exchange", "exchange_index")


def rolling_incremental(spark, sf):
    """Four parts of each day in order of time, each computed from the last ten trades before."""
    trades = given.trades(spark, sf)
    hour = F.hour("timestamp_parsed")
    last, parts = rolling.last_trades(trades.limit(0)), []
    for part in range(4):
        new = trades.where(F.floor(hour / 6) == part)
        rolled, following = rolling.rolling_increment(new, last)
        parts.append(rolled)
        last = stage(following, "last-trades")
    rolled = reduce(lambda a, b: a.unionByName(b), parts)
    return _text(
        rolled.select("id", "rolling_avg_price", "rolling_std_price", "cumulative_volume")
    )


def parquet_file(spark, sf):
    """A single table written as parquet and read as it is."""
    path = run_folder(spark, "file")
    given.recos(spark, sf).write.parquet(path)
    return _text(sources.read_parquet_file(spark, path))


def landing_restarted(spark, sf):
    """Two runs on one checkpoint, the second with new messages only, by gathered steps."""
    folder = run_folder(spark, "landing-restarted")
    sent = given.messages(spark, sf)
    lines = sent.select(encode(*sent.columns).alias("value"), F.col("payload.id").alias("id"))
    for part in range(4):
        lines.where(F.col("id") % 4 == part).select("value").write.mode("append").text(f"{folder}/in")
        stream = streams.folder_stream(spark, f"{folder}/in")
        _run(landing.landing_steps(stream, f"{folder}/raw", f"{folder}/checkpoint", gather_after=2))
    landed = landing.landed_text(spark, f"{folder}/raw")
    number = F.get_json_object("value", "$.payload.id").cast("long").alias("id")
    symbol = F.get_json_object("value", "$.symbol").alias("symbol")
    day = F.get_json_object("value", "$.event_date").alias("event_date")
    return landed.select(number, symbol, day, "feed", "reason")


def rolling_features(spark, sf):
    rolled = rolling.rolling_features(given.trades(spark, sf))
    return _text(
        rolled.select("id", "rolling_avg_price", "rolling_std_price", "cumulative_volume")
    )


def trade_features(spark, sf):
    return _text(features.feature_columns(features.trade_features(given.trades(spark, sf))))


def _bars(size):
    return lambda spark, sf: _flat_bars(bars.price_bars(given.trades(spark, sf), size))


def bars_from_features(spark, sf):
    """Bars over the 17 feature columns alone: whole seconds, ties by price."""
    table = features.feature_columns(features.trade_features(given.trades(spark, sf)))
    return _flat_bars(bars.price_bars(table, "1 hour"))


def bars_one_symbol_day(spark, sf):
    part = filters.partition_filter(given.trades(spark, sf), "S1", DAY)
    return _flat_bars(bars.price_bars(part, "1 minute"))


def reco_flatten(spark, sf):
    return _text(recos.flatten_recos(messages.reco_messages(given.recos(spark, sf)), "S2"))


def reco_periods(spark, sf):
    return _text(recos.reco_periods(given.recos(spark, sf)))


def latest_if_current(spark, sf):
    return _text(recos.latest_if_current(given.recos(spark, sf), "2024-12-31"))


def latest_if_current_cut(spark, sf):
    """Odd symbols have nothing after the cut-off, the others do and so yield no row."""
    table = given.recos(spark, sf).where("symbol in ('S1', 'S3') or event_date > '2024-01-15'")
    early = table.where("symbol not in ('S1', 'S3') or event_date <= '2024-01-15'")
    return _text(recos.latest_if_current(early, "2024-01-20"))


def latest_as_of(spark, sf):
    return _text(recos.latest_as_of(given.recos(spark, sf), "2024-01-20"))


def enrich_day(spark, sf):
    table = bars.price_bars(given.trades(spark, sf), "1 minute")
    return _text(enrich.enrich_day(table, given.recos(spark, sf), DAY))


def enrich_asof(spark, sf):
    table = bars.price_bars(given.trades(spark, sf), "1 hour")
    return _text(enrich.enrich_asof(table, given.recos(spark, sf)))


def enrich_market(spark, sf):
    table = market.enrich_market(given.trades(spark, sf), given.recos(spark, sf), "1 minute")
    return _text(table)


def enrich_universe(spark, sf):
    table = market.enrich_market(
        given.trades(spark, sf), given.recos(spark, sf), "5 minutes", ["S0", "S3", "S5"]
    )
    return _text(table.select(*ENRICHED_COLUMNS))


def trade_messages(spark, sf):
    return messages.trade_messages(given.trades(spark, sf)).withColumn(
        "conditions", F.array_join("conditions", ",")
    )


def trade_records(spark, sf):
    """Key and JSON value of every record, the value decoded again."""
    records = messages.as_records(messages.trade_messages(given.trades(spark, sf)), keyed=True)
    back = records.select("key", decode("value", TRADE_MESSAGE))
    return back.withColumn("conditions", F.array_join("conditions", ",")).drop("symbol")


def reco_messages(spark, sf):
    built = messages.reco_messages(given.recos(spark, sf))
    return built.select("symbol", "event_date", "type", "payload.*")


def news_messages(spark, sf):
    news = given.messages(spark, sf).where(F.col("type") == "NEWS").select("symbol", "payload")
    return messages.news_messages(news).select(
        "symbol", "event_date", "type", F.col("payload.id").alias("id")
    )


def _classified(spark, sf, feed=None):
    records = messages.as_records(given.messages(spark, sf), keyed=False)
    return messages.classify(messages.read_envelopes(records), feed)


def _message_rows(df, *more):
    number = F.get_json_object("value", "$.payload.id").cast("long").alias("id")
    return df.select(number, "symbol", "event_date", "type", *more)


def valid_messages(spark, sf):
    return _message_rows(messages.accepted(_classified(spark, sf, "news")))


def rejected_messages(spark, sf):
    return _message_rows(messages.rejected(_classified(spark, sf, "news")), "reason")


def reco_only(spark, sf):
    return _message_rows(messages.accepted(_classified(spark, sf, "recos")))


def routed_messages(spark, sf):
    return _message_rows(_classified(spark, sf), "feed", "reason")


def message_counts(spark, sf):
    return quality.message_counts(_classified(spark, sf, "recos"))


def session_trades(spark, sf):
    return _text(filters.in_session(given.trades(spark, sf), DAY).drop("conditions"))


def universe_trades(spark, sf):
    return _text(filters.in_universe(given.trades(spark, sf), ["S0", "S2", "S4"]).drop("conditions"))


def news_one_day(spark, sf):
    news = given.messages(spark, sf).where(F.col("type") == "NEWS")
    return filters.on_day(news, DAY).select("symbol", F.col("payload.id").alias("id"))


def _dates(name, function):
    def query(spark, sf):
        return _text(given.calendar(spark, sf).select("day", function(F.col("day")).alias(name)))

    return query


def message_chunks(spark, sf):
    trades = given.trades(spark, sf).select(*KEYS, "id", "price", "size")
    return _text(chunks.message_chunks(trades, ["id"], size=25).drop("messages"))


def chunk_messages(spark, sf):
    """The arrays themselves, as text: times to the microsecond and NULLs included."""
    trades = given.trades(spark, sf).select(
        *KEYS, "id", "price", "size", "timestamp_parsed", F.expr("nullif(tape, 'B') as tape")
    )
    made = chunks.message_chunks(trades, ["id"], size=25)
    return _text(made.select(*KEYS, "chunk", "messages"))


def latest_per_key(spark, sf):
    newest = chunks.latest_per_key(given.trades(spark, sf), "symbol", ["timestamp_parsed", "id"])
    return _text(newest.drop("conditions"))


def completeness(spark, sf):
    return _text(quality.completeness(given.trades(spark, sf), given.EXPECTED_SYMBOLS))


def completeness_one_day(spark, sf):
    return _text(quality.completeness(given.trades(spark, sf), given.EXPECTED_SYMBOLS, DAY))


def completeness_files(spark, sf):
    """Rows and files of each symbol and day, from listing and footers of a table by partition.

    Even ids are written first, odd ones added: a day with both has two files.
    """
    path = run_folder(spark, "completeness")
    trades = given.trades(spark, sf)
    sinks.write_table(trades.where("id % 2 = 0"), path)
    odd = trades.where("id % 2 <> 0").hint("rebalance", *KEYS)
    odd.write.mode("append").partitionBy(*KEYS).parquet(path)
    symbols = spark.createDataFrame([(s,) for s in given.EXPECTED_SYMBOLS], "symbol string")
    return _text(table_completeness(spark, path, symbols))


def missing_symbols(spark, sf):
    return _text(quality.missing_symbols(given.trades(spark, sf), given.EXPECTED_SYMBOLS))


def profile(spark, sf):
    return quality.profile(given.trades(spark, sf))


def value_counts(spark, sf):
    rolled = rolling.rolling_features(given.trades(spark, sf))
    return quality.value_counts(_text(rolled.select("rolling_avg_price")), "rolling_avg_price")


def preview(spark, sf):
    return _text(quality.preview(given.trades(spark, sf).drop("conditions"), 10, ["id"]))


def documents_typed(spark, sf):
    table = features.feature_columns(features.trade_features(given.trades(spark, sf)))
    as_text = table.select(*[F.col(c).cast("string").alias(c) for c in FEATURE_COLUMNS])
    return _text(documents.typed_documents(as_text))


def export_roundtrip(spark, sf):
    path = run_folder(spark, "export")
    trades = given.trades(spark, sf)
    sinks.export_json_lines(trades, path)
    return _text(sources.read_json_lines(spark, path, trades.schema)).withColumn(
        "conditions", F.array_join("conditions", ",")
    )


def json_arrays_roundtrip(spark, sf):
    """Landing as one JSON array per key and chunk, then the multi-line scan."""
    path = run_folder(spark, "arrays")
    made = chunks.message_chunks(messages.trade_messages(given.trades(spark, sf)), ["id"])
    sinks.write_json_arrays(made, path)
    back = sources.read_json_arrays(spark, path, TRADE_MESSAGE)
    return _text(features.typed_trades(back)).withColumn(
        "conditions", F.array_join("conditions", ",")
    )


def overwrite_keeps_partitions(spark, sf):
    """Symbols written in two turns; the second must leave the first in place."""
    path = run_folder(spark, "overwrite")
    table = given.recos(spark, sf)
    early = F.col("symbol") < "S3"
    sinks.write_table(table.where(early), path)
    sinks.write_table(table.where(~early), path)
    return _text(sources.read_table(spark, path, RECOS).select(*KEYS, *RECO_COUNTS))


def landing_stream(spark, sf):
    """All messages as JSON lines, landed by the streaming query, read back."""
    folder = run_folder(spark, "landing")
    sent = given.messages(spark, sf)
    sent.select(encode(*sent.columns).alias("value")).write.text(f"{folder}/in")
    stream = streams.folder_stream(spark, f"{folder}/in")
    writer = landing.landing_query(stream, f"{folder}/raw", f"{folder}/checkpoint")
    with session_conf(spark, landing.LANDING_CONF):
        writer.trigger(availableNow=True).start().awaitTermination()
    landed = landing.landed_text(spark, f"{folder}/raw")
    decoded = {
        "id": F.get_json_object("value", "$.payload.id").cast("long"),
        "symbol": F.get_json_object("value", "$.symbol"),
        "event_date": F.get_json_object("value", "$.event_date"),
    }
    return landed.select(*_aliased(decoded), "feed", "reason")


def landed_one_day(spark, sf):
    """One symbol and day of the landed news, found by folder."""
    folder = run_folder(spark, "landed-day")
    sent = given.messages(spark, sf)
    sent.select(encode(*sent.columns).alias("value")).write.text(f"{folder}/in")
    stream = streams.folder_stream(spark, f"{folder}/in")
    writer = landing.landing_query(stream, f"{folder}/raw", f"{folder}/checkpoint")
    with session_conf(spark, landing.LANDING_CONF):
        writer.trigger(availableNow=True).start().awaitTermination()
    news = landing.read_landed(spark, f"{folder}/raw", "news", "S1", DAY)
    return news.groupBy("symbol", "event_date").agg(F.count("*").alias("n"))


def _run(writer):
    """Start a streaming query, take what is there, and stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def chunks_streamed(spark, sf):
    """Arrays of 25 filled over four triggers, each of a query that was started anew."""
    folder = run_folder(spark, "chunks-streamed")
    trades = given.trades(spark, sf).select(*KEYS, "id", "price", "size", "timestamp_parsed")
    least, most = trades.agg(F.min("id"), F.max("id")).first()
    quarter = F.floor((F.col("id") - least) * 4 / (most - least + 1))
    for number in range(4):
        part = trades.where(quarter == number)
        part.select(F.to_json(F.struct("*"), FAITHFUL).alias("value")).write.mode("append").text(
            f"{folder}/in"
        )
        stream = streams.folder_stream(spark, f"{folder}/in").select(decode("value", trades.schema))
        _run(
            streamed_chunks.chunk_query(
                stream, f"{folder}/out", f"{folder}/checkpoint", ["id"], 25, "1 day"
            )
        )
    streamed_chunks.flush_chunks(spark, f"{folder}/out", trades.schema, ["id"], size=25)
    made = streamed_chunks.read_chunks(spark, f"{folder}/out", trades.schema)
    number = F.row_number().over(Window.partitionBy(*KEYS).orderBy("step", "chunk")) - 1
    return _text(
        made.select(*KEYS, number.cast("long").alias("chunk"), "n_messages", "messages")
    )


def bars_streamed(spark, sf):
    """Hourly bars over a stream with a delay of a day, every 97th trade sent last.

    A trade far ahead of the others ends the stream; its own bar stays open.
    """
    folder = run_folder(spark, "bars-streamed")
    trades = given.trades(spark, sf).drop("conditions")
    moment = F.unix_micros("timestamp_parsed")
    least, most = trades.agg(F.min(moment), F.max(moment)).first()
    quarter = F.floor((moment - least) * 4 / (most - least + 1))
    held = F.col("id") % 97 == 5
    last = trades.limit(1).withColumn("timestamp_parsed", F.timestamp_micros(F.lit(most + 10**12)))
    parts = [trades.where(~held & (quarter == n)) for n in range(4)] + [trades.where(held), last]
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(trades.schema).parquet(f"{folder}/in")
        _run(streamed_bars.bars_query(stream, f"{folder}/out", f"{folder}/checkpoint", "1 hour", "1 day"))
    return _flat_bars(streamed_bars.read_bars(spark, f"{folder}/out"))


def _positioned(spark, sf):
    """News and other messages as topic records whose offsets run against their times."""
    sent = given.messages(spark, sf)
    return sent.select(
        F.lit("mixed").alias("topic"),
        (F.col("payload.id") % 3).cast("int").alias("partition"),
        F.expr("4000000000 - payload.id").alias("offset"),
        F.expr("1704067200000000 - payload.id").alias("broker_micros"),
        encode(*sent.columns).alias("value"),
    )


def latest_by_position(spark, sf):
    """The news that arrived last for each symbol; every offset is landed twice, as after a
    lost checkpoint."""
    folder = run_folder(spark, "positions")
    _positioned(spark, sf).write.json(f"{folder}/in")
    roots = [f"{folder}/raw", f"{folder}/raw-again"]
    for root in roots:
        stream = streams.record_stream(spark, f"{folder}/in")
        _run(landing.landing_query(stream, root, f"{root}-checkpoint"))
    news = landing.read_landed(spark, roots, "news", positions=True)
    newest = chunks.latest_by_position(news, "symbol")
    number = F.get_json_object("payload", "$.id").cast("long").alias("id")
    return newest.select("symbol", "event_date", number, "topic", "partition", "offset")


def _faulty(spark, sf):
    """Trade messages of which some are cut off, misdated, no objects or wrongly typed."""
    trades = given.trades(spark, sf)
    made = messages.trade_messages(trades).drop("conditions")
    text = encode(*made.columns)
    day = F.col("event_date")
    broken = (
        F.when(F.col("id") % 20 == 1, F.expr("substring(v, 1, length(v) - 1)"))
        .when(F.col("id") % 20 == 2, F.expr("replace(v, concat('\"', event_date, '\"'), '\"2024-13-45\"')"))
        .when(F.col("id") % 20 == 3, F.expr("replace(v, event_date, replace(event_date, '-', '/'))"))
        .when(F.col("id") % 20 == 4, F.concat(F.lit("["), F.col("v"), F.lit("]")))
        .when(F.col("id") % 20 == 5, F.expr("replace(v, '\"price\":', '\"price\":\"about \",\"was\":')"))
        .when(F.col("id") % 20 == 6, F.expr("replace(v, '\"symbol\":', '\"ticker\":')"))
        .otherwise(F.col("v"))
    )
    return made.select("id", text.alias("v"), day).select(broken.alias("value"))


def _land_faulty(spark, sf, folder):
    _faulty(spark, sf).write.text(f"{folder}/in")
    stream = streams.folder_stream(spark, f"{folder}/in")
    _run(landing.landing_query(stream, f"{folder}/raw", f"{folder}/checkpoint", "trades"))
    return f"{folder}/raw"


def _id_in_text():
    return F.regexp_extract("value", '"id":([0-9]+)', 1).cast("long").alias("id")


def rejected_malformed(spark, sf):
    """Every faulty message with what is wrong with it, refused or not readable as typed."""
    root = _land_faulty(spark, sf, run_folder(spark, "malformed"))
    refused = landing.read_rejected(spark, root)
    return refused.union(landing.read_misfits(spark, root, "trades")).select(_id_in_text(), "reason")


def redriven(spark, sf):
    """Days written with slashes and renamed symbols are mended and landed, once in two runs."""
    folder = run_folder(spark, "redriven")
    root = _land_faulty(spark, sf, folder)

    def repair(value):
        named = F.regexp_replace(value, '"ticker":', '"symbol":')
        return F.regexp_replace(named, r"(\d{4})/(\d{2})/(\d{2})", "$1-$2-$3")

    for _ in range(2):
        _run(
            landing.redrive_query(
                spark, root, f"{folder}/mended", f"{folder}/redrive", repair, "trades"
            )
        )
    landed = landing.landed_text(spark, f"{folder}/mended")
    symbol = F.get_json_object("value", "$.symbol").alias("symbol")
    return landed.select(_id_in_text(), symbol, "feed", "reason")


def message_totals(spark, sf):
    """Counts of one query that ran twice on one checkpoint, new messages between."""
    folder = run_folder(spark, "totals")
    sent = given.messages(spark, sf)
    lines = sent.select(encode(*sent.columns).alias("value"), F.col("payload.id").alias("id"))
    for part in (0, 1):
        lines.where(F.col("id") % 2 == part).select("value").write.mode("append").text(f"{folder}/in")
        stream = streams.folder_stream(spark, f"{folder}/in")
        _run(totals.totals_query(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return totals.message_totals(spark, f"{folder}/out")


def export_keeps_symbols(spark, sf):
    """Two narrowed exports; the second must leave the first in place."""
    path = run_folder(spark, "export-keys")
    table = given.recos(spark, sf)
    early = F.col("symbol") < "S3"
    sinks.export_json_lines(table.where(early), path, KEYS)
    sinks.export_json_lines(table.where(~early), path, KEYS)
    return _text(sources.read_json_lines(spark, path, RECOS).select(*KEYS, *RECO_COUNTS))


def _sliced(query, *columns):
    """A split operator with slices small enough to be cut at any scale."""

    def run(spark, sf):
        made = query(given.trades(spark, sf))
        return _text(made.select(*columns) if columns else made)

    return run


QUERIES = {
    "latest_if_current_cut": latest_if_current_cut,
    "landed_one_day": landed_one_day,
    "export_keeps_symbols": export_keeps_symbols,
    "rolling_features_split": _sliced(
        lambda trades: rolling.rolling_features(trades, 40),
        "id", "rolling_avg_price", "rolling_std_price", "cumulative_volume",
    ),
    "trade_features_split": _sliced(
        lambda trades: features.feature_columns(features.trade_features(trades, target_rows=40))
    ),
    "chunks_split": _sliced(
        lambda trades: chunks.message_chunks(
            trades.select(*KEYS, "id", "price", "size"), ["id"], size=25, target_rows=40
        ).drop("messages")
    ),
    "time_parts": time_parts,
    "epoch_roundtrip": epoch_roundtrip,
    "parse_timestamps": parse_timestamps,
    "condition_flags": condition_flags,
    "index_exchange": _index("exchange"),
    "index_tape": _index("tape"),
    "index_exchange_by_day": index_exchange_by_day,
    "rolling_features": rolling_features,
    "trade_features": trade_features,
    "bars_1m": _bars("1 minute"),
    "bars_1h": _bars("1 hour"),
    "bars_from_features": bars_from_features,
    "bars_one_symbol_day": bars_one_symbol_day,
    "reco_flatten": reco_flatten,
    "reco_periods": reco_periods,
    "latest_if_current": latest_if_current,
    "latest_as_of": latest_as_of,
    "enrich_day": enrich_day,
    "enrich_asof": enrich_asof,
    "enrich_market": enrich_market,
    "enrich_universe": enrich_universe,
    "trade_messages": trade_messages,
    "trade_records": trade_records,
    "reco_messages": reco_messages,
    "news_messages": news_messages,
    "valid_messages": valid_messages,
    "rejected_messages": rejected_messages,
    "reco_only": reco_only,
    "routed_messages": routed_messages,
    "message_counts": message_counts,
    "session_trades": session_trades,
    "universe_trades": universe_trades,
    "news_one_day": news_one_day,
    "prev_market_day": _dates("previous_market_day", calendar.previous_market_day),
    "month_start": _dates("month_start", calendar.month_start),
    "prev_day": _dates("previous_day", lambda day: calendar.shift_days(day, -1)),
    "chunks": message_chunks,
    "chunk_messages": chunk_messages,
    "latest_per_key": latest_per_key,
    "completeness": completeness,
    "completeness_one_day": completeness_one_day,
    "completeness_files": completeness_files,
    "missing_symbols": missing_symbols,
    "profile": profile,
    "value_counts": value_counts,
    "preview": preview,
    "documents_typed": documents_typed,
    "export_roundtrip": export_roundtrip,
    "json_arrays_roundtrip": json_arrays_roundtrip,
    "overwrite_keeps_partitions": overwrite_keeps_partitions,
    "landing_stream": landing_stream,
    "chunks_streamed": chunks_streamed,
    "latest_by_position": latest_by_position,
    "rejected_malformed": rejected_malformed,
    "redriven": redriven,
    "message_totals": message_totals,
    "bars_streamed": bars_streamed,
    "index_exchange_merged": index_exchange_merged,
    "rolling_incremental": rolling_incremental,
    "parquet_file": parquet_file,
    "landing_restarted": landing_restarted,
}
