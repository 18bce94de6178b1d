"""Raw documents: one JSON forecast per point and batch, unrolled to hourly rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import clean
from skyledger.functions.time import parse_instant
from skyledger.schema import (
    AQI_COLUMNS,
    CLEAN_COLUMNS,
    HOURLY_TYPE,
    POINT_COLUMNS,
    POLLUTANTS,
    RAW_SCHEMA,
    RESPONSE_TYPE,
    SCHEMA_VERSION,
)

MEASURES = POLLUTANTS + AQI_COLUMNS


def read_raw(
    spark: SparkSession,
    root: str,
    date: str | None = None,
    hour: str | None = None,
    batch: str | None = None,
    schema=RAW_SCHEMA,
) -> DataFrame:
    """Raw documents below ``root``, pruned by the partition folders.

    The folder columns are part of the schema, so that an hour ``05`` or a batch
    id of digits stays a text.
    """
    folders = [T.StructField(c, T.StringType()) for c in ("date", "hour", "batch_id") if c not in schema.names]
    full = T.StructType([*schema.fields, *folders])
    df = spark.read.schema(full).option("multiLine", True).json(root)
    for name, wanted in (("date", date), ("hour", hour), ("batch_id", batch)):
        if wanted is not None:
            df = df.where(F.col(name) == wanted)
    return df


#: Objects within objects that a JSON reader follows; deeper documents are unreadable anyhow.
DEEPEST = 1000


def find_hourly(response: str | Column) -> Column:
    """The object with hourly arrays that comes first in a JSON text, at any depth.

    A struct of its ``path``, empty at the top, and of the arrays as ``text``, or null. The objects of one
    depth are opened together, and only as long as there are any; a place is the list of
    positions that lead to it, so the least place is the first in the document's order.
    Each object is read once as texts and once as values, and none behind the first found
    is opened. Lists are not searched, nor are texts that hold JSON.
    """
    text = F.col(response) if isinstance(response, str) else response
    node = "place: array<int>, path: string, text: string"
    member = f"struct<{node}, above: string, object: boolean, hit: boolean>"

    def opened(at: Column) -> Column:
        """The members of an object in their order, each as text and as what it is."""
        entries = F.map_entries(F.from_json(at["text"], "map<string, string>")).alias("entry")
        values = F.map_values(F.from_json(at["text"], "map<string, variant>")).alias("value")
        return F.transform(
            F.coalesce(F.arrays_zip(entries, values), F.array()),
            lambda m, i: F.struct(
                F.concat(at["place"], F.array(i)).alias("place"),
                F.concat_ws(".", F.when(at["path"] != "", at["path"]), m["entry"]["key"]).alias("path"),
                m["entry"]["value"].alias("text"),
                at["path"].alias("above"),
                F.try_variant_get(m["value"], "$", "map<string, variant>").isNotNull().alias("object"),
                (
                    (m["entry"]["key"] == "hourly")
                    & F.try_variant_get(m["value"], "$.time", "array<variant>").isNotNull()
                ).alias("hit"),
            ),
        )

    def first_of(state: Column) -> Column:
        """The first hit up to the depth of the members."""
        # The place of a hit is that of the object around it: it comes before all its members.
        hits = F.transform(
            F.filter(state["members"], lambda m: m["hit"]),
            lambda m: F.struct(
                F.slice(m["place"], F.lit(1), F.size(m["place"]) - 1).alias("place"),
                m["above"].alias("path"),
                m["text"].alias("text"),
            ),
        )
        return F.array_min(F.concat(F.array_compact(F.array(state["first"])), hits))

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """What is made of a value that is worked out once, however often it is used."""
        return F.transform(F.array(value), use)[0]

    def deeper(state: Column, _: Column) -> Column:
        def below(first: Column) -> Column:
            ahead = F.filter(
                state["members"], lambda m: m["object"] & (first.isNull() | (m["place"] < first["place"]))
            )
            return F.struct(first.alias("first"), F.flatten(F.transform(ahead, opened)).alias("members"))

        return once(first_of(state), below)

    top = F.struct(
        F.array().alias("place"), F.lit("").alias("path"), text.alias("text"), F.lit("").alias("above"),
        F.lit(True).alias("object"), F.lit(False).alias("hit"),
    )
    start = F.struct(
        F.lit(None).cast(f"struct<{node}>").alias("first"), F.array(top).cast(f"array<{member}>").alias("members")
    )
    levels = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(DEEPEST), F.regexp_count(text, F.lit(r"\{")))))
    first = F.aggregate(levels, start, deeper, first_of)
    return once(first, lambda first: F.struct(first["path"].alias("path"), first["text"].alias("text")))


def open_responses(raw: DataFrame) -> DataFrame:
    """Documents with ``answer``, the known parts of the response, and ``found``, arrays elsewhere.

    Arrays directly under the response come before all others, so nothing is searched then.
    """
    answered = raw.withColumn("answer", F.from_json("api_response", RESPONSE_TYPE))
    direct = F.col("answer.hourly.time").isNotNull()
    return answered.withColumn("found", F.when(~direct & F.col("api_response").isNotNull(), find_hourly("api_response")))


def locate_hourly() -> Column:
    """The hourly arrays of an opened document, wherever the response carries them."""
    direct = F.col("answer.hourly.time").isNotNull()
    return F.when(direct, F.col("answer.hourly")).otherwise(F.from_json(F.col("found.text"), HOURLY_TYPE))


def hourly_path() -> Column:
    """Where an opened document holds its hourly arrays."""
    deeper = F.concat_ws(".", F.when(F.col("found.path") != "", F.col("found.path")), F.lit("hourly"))
    return F.when(F.col("answer.hourly.time").isNotNull(), "hourly").when(F.col("found.text").isNotNull(), deeper)


def point_field(name: str) -> Column:
    """A point attribute of an opened document; the response is asked where the point lacks it."""
    return F.coalesce(F.col(f"point.{name}"), F.col(f"answer.{name}"))


def point_metadata() -> list[Column]:
    point_id = clean.strip(point_field("point_id"))
    return [
        point_id.alias("point_id"),
        clean.strip(point_field("location_id")).alias("location_id"),
        F.coalesce(clean.strip(point_field("point_name")), point_id).alias("point_name"),
        F.coalesce(clean.strip(point_field("point_type")), F.lit("unknown")).alias("point_type"),
        point_field("latitude").alias("latitude"),
        point_field("longitude").alias("longitude"),
    ]


def record_count() -> Column:
    """Hours a document announces."""
    return F.when(F.col("hourly.time").isNotNull(), F.size("hourly.time")).otherwise(0)


def with_failure(raw: DataFrame, source: str) -> DataFrame:
    """Documents with located arrays, point attributes and the first failure.

    ``failure`` is null for a usable document, so one bad document never stops
    the others.
    """
    df = open_responses(raw).select(
        "batch_id",
        F.coalesce("source", F.lit(source)).alias("source"),
        clean.strip(F.coalesce("schema_version", F.lit(SCHEMA_VERSION))).alias("schema_version"),
        "extracted_at",
        locate_hourly().alias("hourly"),
        *point_metadata(),
    )
    length = F.size("hourly.time")
    mismatch = F.lit(False)
    for c in MEASURES:
        array = F.col(f"hourly.{c}")
        mismatch = mismatch | (array.isNotNull() & (F.size(array) != length))
    fraction = F.lit(False)
    for c in AQI_COLUMNS:
        fraction = fraction | F.coalesce(
            F.exists(f"hourly.{c}", lambda v: F.coalesce(v % 1 != 0, F.lit(False))), F.lit(False)
        )
    bad_time = F.exists("hourly.time", lambda t: clean.to_timestamp(t).isNull())
    coordinates = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    failure = (
        F.when(clean.is_blank(F.col("batch_id")), "BLANK_BATCH_ID")
        .when(clean.strip("source") != source, "WRONG_SOURCE")
        .when(~clean.has_offset(F.col("extracted_at")), "BAD_EXTRACTED_AT")
        .when(clean.is_blank(F.col("point_id")), "BLANK_POINT_ID")
        .when(clean.is_blank(F.col("location_id")), "BLANK_LOCATION_ID")
        .when(~F.coalesce(coordinates, F.lit(False)), "BAD_COORDINATES")
        .when(F.col("hourly").isNull(), "NO_HOURLY")
        .when(length == 0, "EMPTY_HOURLY")
        .when(bad_time, "BAD_TIME")
        .when(mismatch, "LENGTH_MISMATCH")
        .when(fraction, "FRACTIONAL_AQI")
    )
    return df.withColumn("failure", failure)


def explode_documents(documents: DataFrame) -> DataFrame:
    """Usable documents to clean hourly rows.

    A failed document unrolls to nothing. A filter would do the same, but be
    pushed below the projection with a copy of the whole failure expression.
    """
    length = F.size("hourly.time")
    arrays = [F.col("hourly.time").alias("time")] + [
        F.coalesce(
            F.col(f"hourly.{c}"), F.array_repeat(F.lit(None).cast("double"), length)
        ).alias(c)
        for c in MEASURES
    ]
    named = documents.select(
        "failure",
        *POINT_COLUMNS,
        "source",
        "batch_id",
        "schema_version",
        clean.to_timestamp(F.col("extracted_at")).alias("ingested_at"),
        *[column.alias(f"_{name}") for column, name in zip(arrays, ("time", *MEASURES))],
    )
    zipped = F.arrays_zip(*[f"_{name}" for name in ("time", *MEASURES)])
    rows = named.select(
        *POINT_COLUMNS,
        "source",
        "batch_id",
        "schema_version",
        "ingested_at",
        F.inline(F.when(F.col("failure").isNull(), zipped)),
    )
    return rows.select(
        *POINT_COLUMNS,
        parse_instant(F.col("_time")).alias("forecast_time"),
        *[F.col(f"_{c}").alias(c) for c in POLLUTANTS],
        *[F.col(f"_{c}").cast("int").alias(c) for c in AQI_COLUMNS],
        "source",
        "batch_id",
        "schema_version",
        "ingested_at",
    ).select(*CLEAN_COLUMNS)


def failures(documents: DataFrame) -> DataFrame:
    """Rejected documents; unrolled like the rows and for the same reason."""
    found = F.when(F.col("failure").isNotNull(), F.array("failure"))
    return documents.select("batch_id", "point_id", F.explode(found).alias("failure"))


def envelope_issues(raw: DataFrame, source: str) -> DataFrame:
    """Every envelope rule a document breaks: (batch_id, point_id, code, field).

    The arrays are looked for directly under the response or below its
    ``response`` object. A missing outer part hides the rules of its inner ones.
    """
    answered = raw.withColumn("_answer", F.from_json("api_response", RESPONSE_TYPE))
    hourly = F.when(F.col("_answer.response").isNotNull(), F.col("_answer.response.hourly")).otherwise(
        F.col("_answer.hourly")
    )
    df = answered.withColumn("_hourly", hourly)

    def issue(code: str, field: str, broken: Column) -> Column:
        return F.when(broken, F.struct(F.lit(code).alias("code"), F.lit(field).alias("field")))

    top = ("schema_version", "batch_id", "source", "extracted_at", "point", "api_response")
    complete = F.lit(True)
    for c in top:
        complete = complete & F.col(c).isNotNull()
    checks = [issue("RAW_FIELD_MISSING", c, F.col(c).isNull()) for c in top]
    checks += [
        issue("RAW_SCHEMA_VERSION", "schema_version", complete & (F.col("schema_version") != SCHEMA_VERSION)),
        issue("RAW_SOURCE", "source", complete & (F.col("source") != source)),
        issue("RAW_BATCH_ID", "batch_id", complete & clean.is_blank(F.col("batch_id"))),
        issue("RAW_EXTRACTED_AT", "extracted_at", complete & ~clean.has_offset(F.col("extracted_at"))),
    ]
    for c in POINT_COLUMNS:
        checks.append(issue("RAW_POINT_FIELD_MISSING", f"point.{c}", complete & F.col(f"point.{c}").isNull()))
    for c in POINT_COLUMNS[:4]:
        checks.append(issue("RAW_POINT_STRING", f"point.{c}", complete & clean.is_blank(F.col(f"point.{c}"))))
    for c, bound in (("latitude", 90), ("longitude", 180)):
        inside = F.coalesce(F.col(f"point.{c}").between(-bound, bound), F.lit(False))
        checks.append(issue("RAW_COORDINATE_RANGE", f"point.{c}", complete & ~inside))
    has_hourly = complete & F.col("_hourly").isNotNull()
    length = F.size("_hourly.time")
    has_time = has_hourly & F.coalesce(length > 0, F.lit(False))
    checks += [
        issue("RAW_HOURLY_OBJECT", "api_response.hourly", complete & F.col("_hourly").isNull()),
        issue("RAW_HOURLY_TIME", "hourly.time", has_hourly & ~F.coalesce(length > 0, F.lit(False))),
    ]
    for c in MEASURES:
        array = F.col(f"_hourly.{c}")
        checks.append(issue("RAW_HOURLY_FIELD", f"hourly.{c}", has_time & array.isNull()))
        checks.append(
            issue("RAW_HOURLY_LENGTH", f"hourly.{c}", has_time & array.isNotNull() & (F.size(array) != length))
        )
    return df.select(
        "batch_id",
        F.col("point.point_id").alias("point_id"),
        F.inline(F.array_compact(F.array(*checks))),
    )
