"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the whole tables it needs. Queries named `stream_*` publish the records to
a topic folder in several rounds, run the stream over all of them, and return what the
stream stored last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger import schemas
from skyledger.catalog import archives as made_archives
from skyledger.catalog import flights as derived
from skyledger.functions import texts
from skyledger.operators import legs as leg_ops
from skyledger.operators.traffic import endpoint_counts
from skyledger.plans import cleaning, itineraries, popularity, punctuality, wordcount
from skyledger.session import folder_size, new_path, stage, stream_session
from skyledger.sinks import files
from skyledger.sinks.keyed import KeyedTable
from skyledger.sinks.partials import PartialSums
from skyledger.sources import archives, topics
from skyledger.sources import files as source_files
from skyledger.sources.records import flight_lines, flights_from_lines
from skyledger.streaming import runs, running
from skyledger.streaming import trips as trip_streams

Query = Callable[[SparkSession, str], DataFrame]

TRIP_YEAR = 2008

# Batches a replay of any number of files is spread over.
REPLAY_ROUNDS = 8

# Keys asked for by the lookup queries.
LOOKUP = {"origin": "A05", "connection": "A07", "destination": "A03", "origin_date": "2008-01-27"}
LOOKUP_MILLIS = 1_201_392_000_000  # that date


# --- inputs -----------------------------------------------------------------

def _flights(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    return cleaning.clean_on_time(derived.raw_flights(spark, sf_dir), year)


def _coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_origin_destination(derived.raw_flights(spark, sf_dir))


def _trips(spark: SparkSession, sf_dir: str, pm_from_hour: int = 12) -> DataFrame:
    return itineraries.trips(_flights(spark, sf_dir, TRIP_YEAR), pm_from_hour)


# --- cleaning, and the readers and writers around it -------------------------

def _raw_export(spark: SparkSession, sf_dir: str, schema: T.StructType) -> DataFrame:
    """Derived records in the full column layout of an export."""
    raw = derived.raw_flights(spark, sf_dir)
    return raw.select(
        *[
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


# Records a file of an export holds at most: a compressed file is read by one task.
EXPORT_RECORDS = 500_000


def _written_export(spark: SparkSession, sf_dir: str, schema: T.StructType) -> str:
    """The export as compressed text; uncompressed it is mostly quotes around empty fields."""
    path = new_path(spark, "export")
    export = _raw_export(spark, sf_dir, schema)
    writer = export.write.option("header", True).option("quoteAll", True)
    writer.option("compression", "snappy").option("maxRecordsPerFile", EXPORT_RECORDS).csv(path)
    return f"{path}/*.csv.snappy"


def csv_clean_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_export(spark, sf_dir, schemas.RAW_ON_TIME)
    return cleaning.clean_on_time(source_files.read_on_time_csv(spark, path))


def csv_clean_origin_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_export(spark, sf_dir, schemas.RAW_COUPONS)
    return cleaning.clean_origin_destination(source_files.read_coupon_csv(spark, path))


def tsv_clean_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "flights-tsv")
    files.write_flights_tsv(_flights(spark, sf_dir), path)
    return source_files.read_flights_tsv(spark, path)


def tsv_clean_origin_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "coupons-tsv")
    files.write_coupons_tsv(_coupons(spark, sf_dir), path)
    return source_files.read_coupons_tsv(spark, path)


def flights_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of the stored flights; the year is a folder."""
    path = new_path(spark, "flights")
    files.write_flights(_flights(spark, sf_dir), path)
    stored = spark.read.schema(schemas.FLIGHTS).parquet(path)
    return stored.where(F.col("year") == TRIP_YEAR).select(*schemas.FLIGHTS.fieldNames())


def zip_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _raw_export(spark, sf_dir, schemas.RAW_ON_TIME)
    lines = export.select(F.to_csv(F.struct(*export.columns), {"quoteAll": "true"}).alias("line"))
    folder = new_path(spark, "archives")
    made_archives.write_archives(lines, folder)
    raw = archives.land_archives(spark, folder, new_path(spark, "landed"), schemas.RAW_ON_TIME)
    return cleaning.clean_on_time(raw)


def zip_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per text of a field that holds line breaks and quotes, read from archives; broken ones apart.

    City names of flights whose number ends in 7 hold a line break, quotes and commas; records
    of those whose number ends in 33 have a quote that stays open, and come back as they were written.
    """
    export = _raw_export(spark, sf_dir, schemas.RAW_ON_TIME)
    export = export.withColumn(
        "OriginCityName",
        F.when(F.col("FlightNum").endswith("7"), F.concat("Origin", F.lit('\n"twin", '), "Dest")).otherwise(F.col("Origin")),
    )
    lines = export.select(
        F.to_csv(F.struct(*export.columns), {"quoteAll": "true", "escape": '"'}).alias("line"),
        F.concat("Origin", F.lit(',"'), "FlightNum").alias("broken"), F.col("FlightNum").endswith("33").alias("bad"),
    ).select(F.when(F.col("bad"), F.col("broken")).otherwise(F.col("line")).alias("line"))
    folder = new_path(spark, "archives")
    made_archives.write_archives(lines, folder)
    landed = archives.land_records(spark, folder, new_path(spark, "landed"), schemas.RAW_ON_TIME)
    broken = F.col(archives.CORRUPT).isNotNull()
    return landed.groupBy(
        broken.alias("broken"), F.coalesce(archives.CORRUPT, "OriginCityName").alias("content")
    ).agg(F.count("*").alias("n"), F.sum("ArrDelay").alias("delay"))


def clean_bad_rows(spark: SparkSession, sf_dir: str, valid_clock_only: bool = False) -> DataFrame:
    """The cleaning of records among which are years up to 1980, null years and readings of 1965."""
    return cleaning.clean_on_time(derived.with_bad_rows(spark, sf_dir), valid_clock_only=valid_clock_only)


def word_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of text files; a line break inside a document only makes one more line."""
    path = new_path(spark, "texts")
    derived.table(spark, sf_dir, "documents").select("text").where("text IS NOT NULL").write.text(path)
    return wordcount.word_count(source_files.read_text(spark, path))


# --- stored results ----------------------------------------------------------

def _loaded(spark: SparkSession, rows: DataFrame, schema: T.StructType, single: bool = False) -> DataFrame:
    """Write a result as CSV, then load that into a table."""
    path = new_path(spark, "result")
    if single:
        files.write_single_csv(rows, path)
    else:
        files.write_csv(rows, path)
    return stage(source_files.read_result_csv(spark, path, schema), "loaded")


def _text_pair(first: str, second: str) -> T.StructType:
    return T.StructType([T.StructField(first, T.StringType()), T.StructField(second, T.StringType())])


def top_carriers_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = punctuality.top_carriers(_flights(spark, sf_dir))
    rows = punctuality.as_name_list(ranked, "carrier", "carriers")
    return _loaded(spark, rows, _text_pair("airport", "carriers"), single=True)


def top_destinations_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = punctuality.top_destinations(_flights(spark, sf_dir))
    rows = punctuality.as_name_list(ranked, "dest", "destinations")
    return _loaded(spark, rows, _text_pair("airport", "destinations"), single=True)


def stored_mean_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV, then loaded into a keyed table in place of what it held."""
    path = new_path(spark, "means")
    files.write_csv(punctuality.mean_arrival_delay(_flights(spark, sf_dir)), path)
    table = KeyedTable(new_path(spark, "table"), schemas.MEAN_DELAYS, ["origin", "destination"])
    table.replace(source_files.read_result_csv(spark, path, schemas.MEAN_DELAYS))
    return table.latest(spark).drop("batch_id")


def stored_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "popularity")
    rows = popularity.popularity_rank(_coupons(spark, sf_dir)).select("rank", "total")
    files.write_single_csv(rows, path, header=True)
    return source_files.read_result_csv(spark, path, rows.schema, header=True)


def stored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, _trips(spark, sf_dir), schemas.TRIPS)


def trip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "trips")
    itineraries.store_trips(_trips(spark, sf_dir), path)
    return itineraries.trip_lookup(itineraries.stored_trips(spark, path), **LOOKUP)


def quoted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = endpoint_counts(_coupons(spark, sf_dir))
    return totals.select(texts.quoted_line(F.col("airport"), F.col("total")).alias("line"))


def best_legs_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = leg_ops.best_legs(leg_ops.timed_legs(_flights(spark, sf_dir, TRIP_YEAR)))
    return itineraries.legs_as_millis(legs)


# --- streams -----------------------------------------------------------------

# Seconds of a slice published for windows; less than their watermark lags.
CLOSING_SLICE_SECONDS = 10


def publish_records(
    spark: SparkSession, sf_dir: str, rounds: int = 4, year: int | None = None, closing: bool = False
) -> str:
    """Publish all records in order of arrival; returns the topic folder.

    Slices for windows last less than a window is waited for: a batch that ends within a slice then
    leaves no record behind the watermark, however many files a slice has.

    `closing` adds a last leg of each half-day a day later. They move the watermarks past every
    window before them and stay in windows that never close.
    """
    raw = derived.raw_flights(spark, sf_dir, with_arrival=True)
    clean = cleaning.clean_on_time(raw, year, keep=["timestamp"])
    folder = new_path(spark, "topic")
    second = F.unix_seconds("timestamp") - derived.ARRIVAL_START
    slices = max(rounds, -(-derived.ARRIVAL_SPAN // CLOSING_SLICE_SECONDS)) if closing else rounds
    runs.publish_in_order(
        flight_lines(clean, keep=["timestamp"]), folder,
        F.floor(second * slices / derived.ARRIVAL_SPAN), slices,
    )
    if closing:
        sent = spark.read.schema(topics.TOPIC).parquet(folder)
        legs = leg_ops.timed_legs(flights_from_lines(sent, keep=["value", "timestamp"]), keep=["value", "timestamp"])
        # One row, of which two are made.
        last = stage(
            legs.agg(
                F.array(*[F.min(F.when(F.col("leg") == half, F.col("value"))) for half in ("am", "pm")]).alias("values"),
                F.timestamp_add("DAY", F.lit(1), F.max("timestamp")).alias("timestamp"),
            ).select(F.explode("values").alias("value"), "timestamp").where("value IS NOT NULL"),
            "closing",
        )
        last.write.mode("append").parquet(folder)
    return folder


# The test tables are small, and so is the state of their streams.
STATE_PARTITIONS = 8


def open_topic(spark: SparkSession, folder: str, rounds: int) -> tuple[DataFrame, str]:
    """The topic as a stream of about `rounds` batches, and a new work folder."""
    _, size = folder_size(spark, folder)
    stream = topics.read_topic_folder(
        stream_session(spark, STATE_PARTITIONS), folder, bytes_per_batch=str(-(-size // rounds))
    )
    return stream, new_path(spark, "stream")


def _published(
    spark: SparkSession, sf_dir: str, rounds: int = 4, year: int | None = None, closing: bool = False
) -> tuple[DataFrame, str]:
    folder = publish_records(spark, sf_dir, rounds, year, closing)
    return open_topic(spark, folder, rounds)


def _last_batch(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The newest of the per-batch outputs, by the names of their folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(out)
    entries = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = [e.getPath().getName() for e in entries]
    newest = max(int(n.split("=")[1]) for n in names if n.startswith("batch="))
    return spark.read.schema(schema).csv(f"{out}/batch={newest}")


def stream_top_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, work = _published(spark, sf_dir)
    running.top_airports(topic, f"{work}/out", f"{work}/cp", seconds=None).awaitTermination()
    schema = T.StructType.fromDDL("place int, airport string, total bigint")
    return _last_batch(spark, f"{work}/out", schema)


def stream_top_airports_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a timed trigger, stopped once all that was published is worked off."""
    topic, work = _published(spark, sf_dir)
    query = running.top_airports(topic, f"{work}/out", f"{work}/cp", seconds=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    schema = T.StructType.fromDDL("place int, airport string, total bigint")
    return _last_batch(spark, f"{work}/out", schema)


def stream_popularity_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, work = _published(spark, sf_dir)
    running.popularity_index(topic, f"{work}/out", f"{work}/cp", seconds=None).awaitTermination()
    schema = T.StructType.fromDDL("index bigint, total bigint")
    return _last_batch(spark, f"{work}/out", schema)


def stream_weekday_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, work = _published(spark, sf_dir)
    running.weekday_delay(topic, f"{work}/out", f"{work}/cp", seconds=None).awaitTermination()
    schema = T.StructType.fromDDL("day_of_week string, day_name string, avg_delay double")
    return _last_batch(spark, f"{work}/out", schema)


def stream_mean_arrival_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, work = _published(spark, sf_dir)
    table = KeyedTable(f"{work}/means", schemas.MEAN_DELAYS, ["origin", "destination"])
    running.mean_arrival_table(topic, table, f"{work}/cp", seconds=None).awaitTermination()
    return table.latest(spark).drop("batch_id")


def stream_mean_arrival_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over sums of two parts: a batch over the first half of the records, a stream over the rest.

    The backfill runs twice, as one done again does.
    """
    topic, work = _published(spark, sf_dir)
    moment = F.timestamp_seconds(F.lit(derived.ARRIVAL_START + derived.ARRIVAL_SPAN // 2))
    raw = derived.raw_flights(spark, sf_dir, with_arrival=True)
    past = cleaning.clean_on_time(raw, keep=["timestamp"]).where(F.col("timestamp") < moment)
    keys = T.StructType(schemas.MEAN_DELAYS.fields[:2])
    sums = PartialSums(f"{work}/sums", keys)
    for _ in range(2):
        sums.backfill("past", past.withColumnRenamed("dest", "destination"), "arr_delay")
    later = topic.where(F.col("timestamp") >= moment)
    running.partial_arrival_delays(later, sums, "stream", f"{work}/cp", seconds=None).awaitTermination()
    return sums.means(spark, "mean_delay")


def _stream_ten_best(spark: SparkSession, sf_dir: str, name: str, prefix: str, wide: bool) -> DataFrame:
    topic, work = _published(spark, sf_dir)
    ranked_schema = T.StructType.fromDDL(f"origin string, rank int, {name} string, avg_delay double")
    cells = [f"{prefix}{i:02d} string" for i in range(1, punctuality.LIST_LENGTH + 1)]
    wide_schema = T.StructType.fromDDL(", ".join(["airport string", *cells]))
    ranked = KeyedTable(f"{work}/ranked", ranked_schema, ["origin", "rank"])
    wide_table = KeyedTable(f"{work}/wide", wide_schema, ["airport"])
    running.ten_best_table(
        topic, name, ranked, wide_table, prefix, f"{work}/cp", seconds=None
    ).awaitTermination()
    return (wide_table if wide else ranked).latest(spark).drop("batch_id")


def stream_top_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_ten_best(spark, sf_dir, "carrier", "c", wide=False)


def stream_top_carriers_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_ten_best(spark, sf_dir, "carrier", "c", wide=True)


def stream_top_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_ten_best(spark, sf_dir, "dest", "d", wide=False)


def stream_top_destinations_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_ten_best(spark, sf_dir, "dest", "d", wide=True)


def _incremental(spark: SparkSession, sf_dir: str) -> trip_streams.TripTables:
    topic, work = _published(spark, sf_dir)
    tables = trip_streams.TripTables(f"{work}/tables")
    trip_streams.incremental_trips(
        topic, tables, f"{work}/cp", year=TRIP_YEAR, seconds=None, session=spark
    ).awaitTermination()
    return tables


def stream_trips_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir).trips(spark)


def stream_trips_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream stopped within a batch, between its two writes, and started again."""
    topic, work = _published(spark, sf_dir)
    tables = trip_streams.TripTables(f"{work}/tables")
    write = tables.tables.write

    def broken(rows: DataFrame, table: str, batch_id: int) -> str:
        if (table, batch_id) == ("trips", 1):
            raise RuntimeError("stopped on purpose")
        return write(rows, table, batch_id)

    def run() -> None:
        trip_streams.incremental_trips(
            topic, tables, f"{work}/cp", year=TRIP_YEAR, seconds=None, session=spark).awaitTermination()

    tables.tables.write = broken
    try:
        run()
    except StreamingQueryException as error:
        if "stopped on purpose" not in str(error):
            raise
    else:
        raise RuntimeError("the stream was not stopped")
    if (seen := tables.tables.open(spark).batch) != 0:
        raise RuntimeError(f"readers see batch {seen} of a stream stopped in batch 1")
    tables.tables.write = write
    run()
    return tables.trips(spark)


def stream_trip_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir).origins(spark)


def stream_trip_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir).destinations(spark)


def stream_legs_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _incremental(spark, sf_dir)
    date = F.lit(LOOKUP["origin_date"]).cast("date")
    return tables.legs_at(spark, LOOKUP["connection"], date)


def legs_at_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored morning legs into an airport on a date given in epoch milliseconds."""
    tables = trip_streams.TripTables(new_path(spark, "tables"))
    legs = leg_ops.best_legs(leg_ops.timed_legs(_flights(spark, sf_dir, TRIP_YEAR)))
    tables.store_legs(spark, legs, 0)
    return tables.legs_at_millis(spark, LOOKUP["connection"], LOOKUP_MILLIS)


def stream_trips_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, work = _published(spark, sf_dir, rounds=6, year=TRIP_YEAR, closing=True)
    query = trip_streams.windowed_trips(
        topic, f"{work}/out", f"{work}/cp", seconds=None, session=spark)
    query.awaitTermination()
    if late := runs.dropped_rows(query):
        raise RuntimeError(f"{late} records came behind the watermark")
    schema = schemas.extended(schemas.TRIPS, "window_start", T.LongType())
    return spark.read.schema(schema).parquet(f"{work}/out/trips").select(*schema.fieldNames())


def stream_trips_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, work = _published(spark, sf_dir, rounds=6, year=TRIP_YEAR, closing=True)
    query = trip_streams.joined_trips(topic, f"{work}/out", f"{work}/cp", seconds=None)
    query.awaitTermination()
    if late := runs.dropped_rows(query):
        raise RuntimeError(f"{late} records came behind the watermark")
    schema = schemas.extended(schemas.TRIPS, "window_start", T.LongType())
    return spark.read.schema(schema).parquet(f"{work}/out").select(*schema.fieldNames())


def stream_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records counted batch by batch, added up."""
    topic, work = _published(spark, sf_dir)
    counts = KeyedTable(f"{work}/counts", T.StructType.fromDDL("batch bigint, n bigint"), ["batch"])

    def store(batch_id: int, n: int) -> None:
        counts.upsert(spark.createDataFrame([(batch_id, n)], counts.schema), batch_id)

    handler = runs.count_batches(store)
    runs.each_batch(topic, handler, f"{work}/cp", "append", seconds=None).awaitTermination()
    return counts.latest(spark).agg(F.sum("n").alias("n"))


def replay_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text files sent to a topic one after another, then read from its beginning."""
    source, topic = new_path(spark, "replay"), new_path(spark, "replayed")
    files.write_flights_tsv(_flights(spark, sf_dir), source)
    count, _ = folder_size(spark, source)
    sending = runs.replay_files(stream_session(spark, STATE_PARTITIONS), source, -(-count // REPLAY_ROUNDS))
    runs.publish_to_folder(sending, topic, new_path(spark, "cp"), seconds=None).awaitTermination()
    return flights_from_lines(spark.read.schema(topics.TOPIC).parquet(topic))


def queries() -> dict[str, Query]:
    return {
        "clean_on_time": _flights,
        "clean_on_time_2008": lambda s, d: _flights(s, d, TRIP_YEAR),
        "clean_origin_destination": _coupons,
        "csv_clean_on_time": csv_clean_on_time,
        "csv_clean_origin_destination": csv_clean_origin_destination,
        "tsv_clean_on_time": tsv_clean_on_time,
        "tsv_clean_origin_destination": tsv_clean_origin_destination,
        "flights_by_year": flights_by_year,
        "zip_ingest": zip_ingest,
        "zip_records": zip_records,
        "clean_bad_rows": clean_bad_rows,
        "valid_clock_only": lambda s, d: clean_bad_rows(s, d, valid_clock_only=True),
        "word_count_files": word_count_files,
        "legs_at_millis": legs_at_millis,
        "top_airports": lambda s, d: popularity.top_airports(_coupons(s, d)),
        "popularity_rank": lambda s, d: popularity.popularity_rank(_coupons(s, d)),
        "weekday_delay": lambda s, d: punctuality.weekday_delay(_flights(s, d)),
        "top_carriers": lambda s, d: punctuality.top_carriers(_flights(s, d)),
        "top_destinations": lambda s, d: punctuality.top_destinations(_flights(s, d)),
        "top_carriers_list": top_carriers_list,
        "top_destinations_list": top_destinations_list,
        "mean_arrival_delay": lambda s, d: punctuality.mean_arrival_delay(_flights(s, d)),
        "trips": _trips,
        "trips_pm13": lambda s, d: _trips(s, d, 13),
        "trips_text": lambda s, d: itineraries.trips_as_text(_trips(s, d)),
        "trips_millis": lambda s, d: itineraries.trips_as_millis(_trips(s, d)),
        "best_legs_millis": best_legs_millis,
        "trip_lookup": trip_lookup,
        "stored_mean_delays": stored_mean_delays,
        "stored_popularity": stored_popularity,
        "stored_trips": stored_trips,
        "quoted_totals": quoted_totals,
        "word_count": lambda s, d: wordcount.word_count(derived.table(s, d, "documents")),
        "stream_top_airports": stream_top_airports,
        "stream_top_airports_timed": stream_top_airports_timed,
        "stream_popularity_index": stream_popularity_index,
        "stream_weekday_delay": stream_weekday_delay,
        "stream_mean_arrival_delay": stream_mean_arrival_delay,
        "stream_mean_arrival_backfilled": stream_mean_arrival_backfilled,
        "stream_top_carriers": stream_top_carriers,
        "stream_top_carriers_wide": stream_top_carriers_wide,
        "stream_top_destinations": stream_top_destinations,
        "stream_top_destinations_wide": stream_top_destinations_wide,
        "stream_trips_incremental": stream_trips_incremental,
        "stream_trips_restarted": stream_trips_restarted,
        "stream_trip_origins": stream_trip_origins,
        "stream_trip_destinations": stream_trip_destinations,
        "stream_legs_at": stream_legs_at,
        "stream_trips_windowed": stream_trips_windowed,
        "stream_trips_joined": stream_trips_joined,
        "stream_record_count": stream_record_count,
        "replay_files": replay_files,
    }
