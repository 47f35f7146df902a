"""The given star-schema tables in the shapes the operators expect.

Orders and lines play trips over several years, events play rides within one month
and station reports, suppliers and customers play the zone lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfact.functions import conditions, text
from wayfact.operators import clean, demand, dims, eventlog, joins
from wayfact.plans import summaries
from wayfact.session import configure, materialize

FIRST_HOUR, LAST_HOUR = "2024-01-01 00:00:00", "2024-01-30 23:00:00"
RIDES_PERIOD = ("2024-01-01", "2024-01-31")
TRIPS_PERIOD = ("1995-01-01", "2002-01-01")
TRIP_DAYS = 2557  # days of TRIPS_PERIOD
HOURS = dims.hours_between(FIRST_HOUR, LAST_HOUR)
STATION = "STATION-1"
DEMAND_GROUPS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
LAST_TRAIN_DAY = 22
SNOW_TEMPERATURE = 4.0
RIDE_LIMITS = clean.HourlyLimits(location=(0, None))
TRIP_LIMITS = clean.HourlyLimits(
    location=(0, None),
    minutes=(1440.0, 259200.0),
    distance=(0.1, 100.0),
    fare=(0.0, 200000.0),
    tip=(0.0, 20000.0),
    total=(0.0, 250000.0),
)
TRIP_DAILY_LIMITS = clean.DailyLimits(
    distance=45.0, fare=90000.0, total=95000.0, minutes=(1440.0, 259200.0)
)
KEY_TYPES = {"pickup_location_id": "bigint"}


def _record(fields: dict[str, Column]) -> Column:
    """A struct from named columns."""
    return F.named_struct(*[part for n, c in fields.items() for part in (F.lit(n), c)])


class Views:
    """Lazily built views over one directory of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._observed: DataFrame | None = None

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    # lookups

    def _zones(self, table: str, prefix: str, key: str, service: str) -> DataFrame:
        """Region and nation are scanned as they are; Spark sizes them from their files."""
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        owner = self.table(table)
        return owner.join(
            nations, F.col(f"{prefix}_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            F.col(key).alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.col(service).alias("service_zone"),
        )

    def trip_zones_raw(self) -> DataFrame:
        return self._zones("supplier", "s", "s_suppkey", "s_name")

    def ride_zones_raw(self) -> DataFrame:
        return self._zones("customer", "c", "c_custkey", "c_mktsegment")

    def trip_zones(self) -> DataFrame:
        return joins.zone_lookup(self.trip_zones_raw(), "bigint")

    def ride_zones(self) -> DataFrame:
        return joins.zone_lookup(self.ride_zones_raw(), "bigint")

    def lookup_rows(self, table: str) -> int:
        """Rows of a lookup's source table, from file footers; a bound for the lookup."""
        return self.table(table).count()

    # facts

    def trips_raw(self) -> DataFrame:
        """Order lines as raw trips; both sides are large, so Spark picks the join."""
        price, off = F.col("l_extendedprice"), F.col("l_discount")
        lines = self.table("lineitem")
        orders = self.table("orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
            F.col("o_orderdate").alias("tpep_pickup_datetime"),
            F.col("l_shipdate").alias("tpep_dropoff_datetime"),
            F.col("l_suppkey").alias("PULocationID"),
            F.col("l_linenumber").alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.substring("o_orderpriority", 1, 1).try_cast("int").alias("payment_type"),
            price.alias("fare_amount"),
            (price * off).alias("tip_amount"),
            (price * (1 - off) * (1 + F.col("l_tax"))).alias("total_amount"),
        )

    def numbered_events(self) -> DataFrame:
        """Events with the number in their text.

        The one-element explode keeps filters on the number above the pattern match,
        which otherwise would be repeated inside every pushed condition.
        """
        number = F.array(text.numeric_text(F.col("props")))
        return self.table("events").withColumn("number", F.explode(number))

    def line_trips(self) -> DataFrame:
        """The trip columns that come from order lines alone, without the join to orders.

        Every line has one order, so the rows are those of ``canonical_trips``.
        """
        price, off = F.col("l_extendedprice"), F.col("l_discount")
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("pickup_location_id"),
            F.col("l_linenumber").cast("double").alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance_miles"),
            price.alias("fare_amount"),
            (price * off).alias("tip_amount"),
            (price * (1 - off) * (1 + F.col("l_tax"))).alias("total_amount"),
        )

    def rides_raw(self) -> DataFrame:
        """Events as raw rides; the number in the text gives length, distance and tip."""
        kind = F.col("event_type")
        payment = (
            F.when(kind == "purchase", 1)
            .when(kind == "view", 2)
            .when(kind == "click", 3)
            .when(kind == "signup", 4)
            .when(kind == "error", 5)
        )
        number = F.col("number")
        tip = number / F.lit(20.0)
        return self.numbered_events().select(
            F.col("ts").alias("tpep_pickup_datetime"),
            F.timestamp_add("MINUTE", number.cast("int"), "ts").alias("tpep_dropoff_datetime"),
            F.col("user_id").alias("PULocationID"),
            F.floor(number / F.lit(25.0)).alias("passenger_count"),
            (number * F.lit(0.5)).alias("trip_distance"),
            payment.alias("payment_type"),
            F.col("value").alias("fare_amount"),
            tip.alias("tip_amount"),
            (F.col("value") + tip).alias("total_amount"),
        )

    def canonical_trips(self) -> DataFrame:
        return clean.canonical_trips(self.trips_raw(), KEY_TYPES)

    def canonical_rides(self) -> DataFrame:
        return clean.canonical_trips(self.rides_raw(), KEY_TYPES)

    def trips(self) -> DataFrame:
        return clean.prepared_hourly(self.canonical_trips(), *TRIPS_PERIOD, TRIP_LIMITS)

    def rides(self) -> DataFrame:
        return clean.prepared_hourly(self.canonical_rides(), *RIDES_PERIOD, RIDE_LIMITS)

    # conditions

    def obs(self) -> DataFrame:
        """Every event as a station report in text, with the usual flaws.

        Two event types carry usable report types, some values are blank, flagged or
        not numeric, and some times lack the clock part.
        """
        kind = F.col("event_type")
        report = (
            F.when(kind == "error", " FM-15").when(kind == "signup", "FM-16 ").otherwise("FM-12")
        )
        n = F.col("number")
        whole = n.cast("int").cast("string")
        value = F.col("value").cast("string")
        amount = F.greatest(n - F.lit(60.0), F.lit(0.0)) / F.lit(10.0)
        return (
            self.numbered_events()
            .select(
                F.lit(STATION).alias("STATION"),
                F.when(n == 13, F.date_format("ts", "yyyy-MM-dd"))
                .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
                .alias("DATE"),
                report.alias("REPORT_TYPE"),
                F.when(n.between(5, 9), "")
                .when(n >= 50, F.concat(value, F.lit("s")))
                .otherwise(value)
                .alias("HourlyDryBulbTemperature"),
                F.when(n.between(20, 29), "t ")
                .when(n.between(30, 34), " ")
                .otherwise(amount.cast("string"))
                .alias("HourlyPrecipitation"),
                F.when(n.between(40, 44), F.lit(None)).otherwise(whole).alias(
                    "HourlyRelativeHumidity"
                ),
                F.when(n.between(45, 49), "")
                .otherwise(F.floor(n / F.lit(10.0)).cast("string"))
                .alias("HourlyWindSpeed"),
                F.when(n >= 90, "VRB").otherwise(whole).alias("HourlyWindDirection"),
                F.when(n >= 97, "-SN:03").when(n > 60, "RA:61").alias("HourlyPresentWeatherType"),
            )
        )

    def candidates(self) -> DataFrame:
        return dims.hourly_candidates(self.obs())

    def observed_hours(self) -> DataFrame:
        """The best report per hour, written once because completion reads it again."""
        if self._observed is None:
            best = dims.best_record_per_hour(self.candidates())
            self._observed = materialize(best, "observed-hours")
        return self._observed

    def spine(self) -> DataFrame:
        return dims.hour_spine(self.spark, FIRST_HOUR, LAST_HOUR)

    def completed_hours(self) -> DataFrame:
        return dims.complete_hours(self.spine(), self.observed_hours(), STATION)

    def hours(self) -> DataFrame:
        """Classified hours; never more rows than the spine."""
        filled = dims.fill_neighbors(self.completed_hours())
        limits = conditions.HourlyThresholds(snow_temperature=SNOW_TEMPERATURE)
        return dims.classify_hours(filled, limits)

    def days(self) -> DataFrame:
        return dims.daily_from_hourly(self.hours())

    def day_obs(self) -> DataFrame:
        """Orders per date as daily station text; never more rows than the period's days."""
        n = F.col("n")
        period = clean.in_period(F.col("o_orderdate"), *TRIPS_PERIOD)
        high, low = F.col("high") / F.lit(10000.0), F.col("low") / F.lit(10000.0)
        return (
            self.table("orders")
            .where(period)
            .groupBy(F.to_date("o_orderdate").alias("day"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.max("o_totalprice").alias("high"),
                F.min("o_totalprice").alias("low"),
            )
            .select(
                F.col("day").cast("string").alias("DATE"),
                F.when(n % 3 != 0, (high + low) / F.lit(2.0)).cast("string").alias("TAVG"),
                F.when(n % 7 != 0, high).cast("string").alias("TMAX"),
                low.cast("string").alias("TMIN"),
                ((n % 8) / F.lit(10.0)).cast("string").alias("PRCP"),
                F.when(n % 5 == 0, "1").otherwise("0").alias("SNOW"),
                n.cast("string").alias("AWND"),
            )
        )

    def parsed_days(self) -> DataFrame:
        """Typed daily rows, written once because the repair reads them again."""
        return materialize(dims.parse_daily(self.day_obs()), "daily-rows")

    def day_conditions(self) -> DataFrame:
        return dims.classified_days(dims.repair_daily(self.parsed_days()))

    # joined facts

    def _with_ride_zones(self, rides: DataFrame) -> DataFrame:
        return joins.attach_zones(rides, self.ride_zones(), self.lookup_rows("customer"))

    def _with_trip_zones(self, trips: DataFrame) -> DataFrame:
        return joins.attach_zones(trips, self.trip_zones(), self.lookup_rows("supplier"))

    def joined_rides(self) -> DataFrame:
        """Rides with zone and the condition of the hour."""
        return joins.attach_hourly(self._with_ride_zones(self.rides()), self.hours(), HOURS)

    def joined_rides_daily(self) -> DataFrame:
        """Rides with zone and the condition of the day."""
        return joins.attach_daily(self._with_ride_zones(self.rides()), self.days(), HOURS // 24)

    def _trip_days(self) -> DataFrame:
        """Daily conditions under the names the summaries average."""
        return self.day_conditions().select(
            "weather_date",
            "weather_condition",
            F.col("avg_temp_f").alias("temperature_c"),
            F.col("precip_inches").alias("precipitation_mm"),
        )

    def joined_trips(self) -> DataFrame:
        """Trips with zone and the condition of the day."""
        return joins.attach_daily(self._with_trip_zones(self.trips()), self._trip_days(), TRIP_DAYS)

    def conditioned_trips(self) -> DataFrame:
        """Trips with the condition of the day, for summaries that need no zone."""
        return joins.attach_daily(self.trips(), self._trip_days(), TRIP_DAYS)

    def conditioned_rides(self) -> DataFrame:
        return joins.attach_hourly(self.rides(), self.hours(), HOURS)

    def daily_trips(self) -> DataFrame:
        """The daily pipeline's clean trips."""
        return clean.clean_daily(
            self.canonical_trips(), "1995-01-01", "2001-12-31", TRIP_DAILY_LIMITS
        )

    def conditioned_daily_trips(self) -> DataFrame:
        return joins.attach_daily(self.daily_trips(), self.day_conditions(), TRIP_DAYS)

    def conditioned_rides_daily(self) -> DataFrame:
        return joins.attach_daily(self.rides(), self.days(), HOURS // 24)

    def ride_zone_summary(self, rides: DataFrame, name: str) -> DataFrame:
        rows = self.lookup_rows("customer")
        return summaries.summarize_by_zone(rides, self.ride_zones(), name, rows)

    def trip_zone_summary(self, trips: DataFrame, name: str) -> DataFrame:
        rows = self.lookup_rows("supplier")
        return summaries.summarize_by_zone(trips, self.trip_zones(), name, rows)

    # demand

    def demand_source(self) -> DataFrame:
        return demand.demand_source(self.joined_rides(), *RIDES_PERIOD, DEMAND_GROUPS)

    def is_train(self) -> Column:
        return F.dayofmonth("pickup_date") <= LAST_TRAIN_DAY

    def demand_table(self) -> DataFrame:
        return demand.complete_demand(self.demand_source(), DEMAND_GROUPS)

    def split_demand(self) -> DataFrame:
        return demand.time_split(demand.demand_indicators(self.demand_table()), self.is_train())

    def labelled_demand(self) -> DataFrame:
        return demand.labelled_demand(self.demand_source(), DEMAND_GROUPS, self.is_train())

    def gapped_demand(self) -> DataFrame:
        """The labelled table with gaps in two measures, as raw station data has them."""
        hour = F.col("pickup_hour_of_day")
        return self.labelled_demand().withColumns(
            {
                "temperature_c": F.when(hour % 5 != 0, F.col("temperature_c")),
                "wind_speed_mps": F.when(hour % 7 != 0, F.col("wind_speed_mps")),
            }
        )

    # ride file and event log

    def ride_file(self) -> DataFrame:
        """Events and their customers in the columns of a ride file."""
        start = F.date_trunc("second", "ts").cast("timestamp_ntz")
        rides = self.numbered_events().withColumn("LocationID", F.col("user_id"))
        joined = joins.attach(
            rides, self.ride_zones_raw(), "LocationID", "left", self.lookup_rows("customer")
        )
        return joined.select(
            F.col("event_id").cast("string").alias("ride_id"),
            F.col("event_type").alias("rideable_type"),
            start.alias("started_at"),
            F.timestamp_add("MINUTE", F.col("number").cast("int"), start).alias("ended_at"),
            F.when(F.col("number") >= 5, F.col("Zone")).alias("start_station_name"),
            F.col("LocationID").cast("string").alias("start_station_id"),
            F.col("Borough").alias("end_station_name"),
            F.col("number").cast("int").cast("string").alias("end_station_id"),
            (F.col("number") / F.lit(8.0)).alias("start_lat"),
            (F.col("number") / F.lit(16.0)).alias("start_lng"),
            (F.col("number") / F.lit(32.0)).alias("end_lat"),
            F.col("value").alias("end_lng"),
            F.col("service_zone").alias("member_casual"),
        )

    def log_lines(self) -> DataFrame:
        """Events as lines of three run logs: jobs, SQL runs, stages, tasks and broken text."""
        kind = F.col("event_type")
        n = F.col("number").cast("bigint")
        metrics = _record(
            {
                "Executor Run Time": n,
                "Executor CPU Time": n * 1000000,
                "Memory Bytes Spilled": n * 7,
                "Disk Bytes Spilled": n * 3,
                "Peak Execution Memory": n * 1024,
                "Input Metrics": _record({"Bytes Read": n * 4096, "Records Read": n * 2}),
                "Output Metrics": _record({"Bytes Written": n * 512, "Records Written": n}),
                "Shuffle Read Metrics": _record(
                    {
                        "Remote Bytes Read": n * 5,
                        "Local Bytes Read": n * 6,
                        "Total Records Read": n + 1,
                    }
                ),
                "Shuffle Write Metrics": _record(
                    {"Shuffle Bytes Written": n * 9, "Shuffle Records Written": n * 8}
                ),
            }
        )
        reason = F.when(kind == "click", "Success").otherwise("ExceptionFailure")
        user, zero = F.col("user_id"), F.lit(0)
        task = _record(
            {
                "Event": F.lit(eventlog.TASK_END),
                "Stage ID": user,
                "Stage Attempt ID": zero,
                "Task End Reason": _record({"Reason": reason}),
                "Task Info": _record({"Task ID": F.col("event_id"), "Attempt": zero}),
                "Task Metrics": metrics,
            }
        )
        stage_info = {"Stage ID": user, "Stage Attempt ID": zero, "Number of Tasks": F.lit(4)}
        stage = _record({"Event": F.lit(eventlog.STAGE_DONE), "Stage Info": _record(stage_info)})
        job = _record({"Event": F.lit(eventlog.JOB_START), "Job ID": user})
        sql = _record({"Event": F.lit(eventlog.SQL_START)})
        line = (
            F.when((kind == "view") & (n >= 90), F.lit('{"Event": '))
            .when((kind == "signup") & (n == 50), F.lit("  "))
            .when(kind.isin("click", "error"), F.to_json(task))
            .when(kind == "purchase", F.to_json(stage))
            .when(kind == "signup", F.to_json(job))
            .otherwise(F.to_json(sql))
        )
        copies = F.when(kind == "click", 2).otherwise(1)
        return (
            self.numbered_events()
            .select(
                line.alias("value"),
                F.concat(
                    F.lit("eventlog_v2_app-"), (user % 3).cast("string"), F.lit("/events_"), kind
                ).alias("file"),
                F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
            )
            .drop("copy")
        )
