"""Raw feed rows to table rows, with one reason for every row that is left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import parsing as P
from ..functions.clock import midnight_s
from ..functions.geo import in_any_box
from ..operators.exact import first_per_key
from ..schemas import DETECTIONS, REPORTS, conform
from .landed import MALFORMED

DETECTION_KEY = ["acq_datetime", "latitude", "longitude", "satellite"]
REPORT_KEY = ["global_event_id"]


def _checked(parsed: Column, text: Column, strict: bool, name: str) -> Column:
    """With ``strict``, an unreadable optional value stops the job instead of becoming NULL."""
    if not strict:
        return parsed
    bad = F.coalesce(P.unreadable(text, parsed), F.lit(0)) == 1
    return F.when(bad, F.raise_error(F.concat(F.lit(f"unreadable {name}: "), text))).otherwise(
        parsed)


def confident_at_ingest(confidence: Column) -> Column:
    """Keeps blank confidence, unlike the filter before proximity dedup. Not trimmed."""
    return ~F.lower(F.coalesce(confidence, F.lit(""))).isin(*V.LOW_CONFIDENCE)


def route_detections(
    raw: DataFrame, boxes=V.COUNTRY_BOXES, strict: bool = False
) -> DataFrame:
    """Parsed columns plus ``reason``: the first of low_conf, parse_err, outside_zone, or ok.

    ``warnings`` counts optional values with text that could not be read. Rows that were read with
    :data:`~.landed.MALFORMED` columns keep them, and ``malformed`` comes before all other reasons.
    """
    c = F.col
    told = MALFORMED if "malformed" in raw.columns else ()
    decimals = ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "scan", "track")
    optional = (*decimals[2:], "type")
    # each text is stripped once, then parsed once, then looked at by warnings and strictness
    texts = raw.withColumns({f"_{n}": P.stripped(c(n)) for n in (*decimals, "type")})
    values = texts.withColumns(
        {n: P.decimal(c(f"_{n}")) for n in decimals}
        | {"type": P.whole(c("_type"), "smallint")})
    parsed = P.settled(values.select(
        confident_at_ingest(c("confidence")).alias("_keep"),
        P.moment(c("acq_date"), c("acq_time")).alias("acq_datetime"),
        "latitude",
        "longitude",
        *[_checked(c(n), c(f"_{n}"), strict, n).alias(n) for n in optional],
        P.clipped(c("satellite"), 10).alias("satellite"),
        P.clipped(c("confidence"), 10).alias("confidence"),
        P.clipped(c("daynight"), 1).alias("daynight"),
        P.clipped(c("version"), 10).alias("version"),
        sum((F.coalesce(P.unreadable(c(f"_{n}"), c(n)), F.lit(0)) for n in optional), F.lit(0))
        .alias("warnings"),
        *told,
    ))
    readable = (
        c("acq_datetime").isNotNull() & c("latitude").isNotNull() & c("longitude").isNotNull())
    first = F.when(c("malformed").isNotNull(), "malformed") if told else F
    reason = (
        first.when(~c("_keep"), "low_conf")
        .when(~readable, "parse_err")
        .when(~in_any_box(c("latitude"), c("longitude"), boxes), "outside_zone")
        .otherwise("ok")
    )
    return parsed.withColumn("reason", reason).drop("_keep")


def route_reports(
    raw: DataFrame,
    sub_types=V.STRIKE_SUB_TYPES,
    precisions=V.GEO_PRECISION_OK,
    strict: bool = False,
) -> DataFrame:
    """Parsed columns plus ``reason``: ok or skipped, and ``warnings`` as for detections."""
    c = F.col
    named = {
        "event_type": "event_type", "notes": "description", "actor1": "actor1_name",
        "actor2": "actor2_name", "location": "action_geo_fullname",
        "country": "action_geo_country",
    }
    numbers = ("latitude", "longitude", "fatalities", "geo_precision")
    texts = raw.withColumns({f"_{n}": P.stripped(c(n)) for n in numbers})
    values = texts.withColumns({
        "latitude": P.decimal(c("_latitude")),
        "longitude": P.decimal(c("_longitude")),
        "fatalities": P.whole(c("_fatalities")),
        "event_date": P.day(c("event_date")),
    })
    parsed = P.settled(values.select(
        c("event_id_cnty").alias("global_event_id"),
        "event_date",
        F.timestamp_seconds(midnight_s(c("event_date"))).alias("event_datetime"),
        P.text_or_null(c("sub_event_type")).alias("sub_event_type"),
        *[P.text_or_null(c(old)).alias(new) for old, new in named.items()],
        P.source_count(c("source")).alias("num_sources"),
        P.text_or_null(c("source")).alias("source"),
        _checked(c("fatalities"), c("_fatalities"), strict, "fatalities").alias("fatalities"),
        "latitude",
        "longitude",
        F.coalesce(P.whole(c("_geo_precision")), F.lit(0)).alias("_precision"),
        (F.coalesce(P.unreadable(c("_fatalities"), c("fatalities")), F.lit(0))
         + c("event_id_cnty").isNull().cast("int")).alias("warnings"),
    ))
    accepted = (
        c("latitude").isNotNull() & c("longitude").isNotNull() & c("event_date").isNotNull()
        & c("_precision").isin(*precisions)
        & F.coalesce(c("sub_event_type").isin(*sub_types), F.lit(False))
    )
    return parsed.withColumn(
        "reason", F.when(accepted, "ok").otherwise("skipped")).drop("_precision")


def select_reports(raw: DataFrame, since: str, until: str) -> DataFrame:
    """The rows the report feed is asked for: scope countries, one event type, closed dates.

    Plain comparisons on raw columns, so they reach the scan.
    """
    return raw.filter(
        F.col("country").isin(*V.REPORT_COUNTRIES)
        & (F.col("event_type") == V.REPORT_EVENT_TYPE)
        & F.col("event_date").between(since, until))


def normalise_detections(raw: DataFrame, **options) -> DataFrame:
    """Accepted detections in table form: exact duplicates dropped, id and ingest time added."""
    kept = route_detections(raw, **options).filter("reason = 'ok'").drop(
        "reason", "warnings", *MALFORMED)
    unique = first_per_key(kept, DETECTION_KEY)
    return conform(
        unique.withColumn("id", P.key_hash(*DETECTION_KEY))
        .withColumn("ingested_at", F.current_timestamp()), DETECTIONS)


def normalise_reports(raw: DataFrame, **options) -> DataFrame:
    """Accepted reports in table form, one per event id; rows without an id are not merged."""
    kept = route_reports(raw, **options).filter("reason = 'ok'").drop("reason", "warnings")
    unique = first_per_key(kept, REPORT_KEY, null_keys_differ=True)
    return conform(
        unique.withColumn("id", F.when(
            F.col("global_event_id").isNotNull(), P.key_hash(F.col("global_event_id"))))
        .withColumn("ingested_at", F.current_timestamp()), REPORTS)


def reason_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def quality_report(routed: DataFrame, key: list[str]) -> DataFrame:
    """One row: raw and kept rows, rows per reason, unreadable values, exact duplicates. ``malformed``
    is a column where the rows were read with it.

    Counting per key first combines copies map side; the second count is over distinct keys.
    """
    per_key = routed.groupBy("reason", *key).agg(
        F.count(F.lit(1)).alias("n"), F.sum("warnings").alias("warnings"))
    kept = F.col("reason") == "ok"
    reasons = ["low_conf", "parse_err", "outside_zone", "skipped"]
    if "malformed" in routed.columns:
        reasons.insert(0, "malformed")
    return per_key.agg(
        F.sum("n").alias("raw_rows"),
        *[F.coalesce(F.sum(F.when(F.col("reason") == r, F.col("n"))), F.lit(0)).alias(r)
          for r in reasons],
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("kept"),
        F.count_if(kept).alias("unique_rows"),
        F.coalesce(F.sum(F.when(kept, F.col("n") - 1)), F.lit(0)).alias("exact_duplicates"),
        F.coalesce(F.sum("warnings"), F.lit(0)).alias("warnings"),
    )
