"""Small inputs and a brute-force reference for the distance operators."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from skyground.schemas import DETECTIONS, REPORTS, conform

RADIUS = 6_371_000.0
METRES_PER_DEGREE = math.radians(1) * RADIUS


def metres(lat_a, lon_a, lat_b, lon_b):
    pa, pb = np.radians(lat_a), np.radians(lat_b)
    h = (np.sin((pb - pa) / 2) ** 2
         + np.cos(pa) * np.cos(pb) * np.sin(np.radians(lon_b - lon_a) / 2) ** 2)
    return 2 * RADIUS * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def detections(spark, rows):
    """``rows`` of dicts with any of the table's columns; ``sec`` sets the time."""
    fields = ["id", "latitude", "longitude", "sec", "frp", "confidence"]
    data = [(r.get("id"), r.get("latitude"), r.get("longitude"), r.get("sec"),
             r.get("frp", 10.0), r.get("confidence", "n")) for r in rows]
    df = spark.createDataFrame(
        data, "id bigint, latitude double, longitude double, sec bigint, frp double,"
              " confidence string").toDF(*fields)
    return conform(df.withColumn("acq_datetime", F.timestamp_seconds("sec")), DETECTIONS)


def reports(spark, rows):
    data = [(r.get("id"), r.get("latitude"), r.get("longitude"), r.get("sec"),
             r.get("num_sources", 1), r.get("place"), r.get("sub_event_type")) for r in rows]
    df = spark.createDataFrame(
        data, "id bigint, latitude double, longitude double, sec bigint, num_sources int,"
              " action_geo_fullname string, sub_event_type string")
    return conform(df.withColumn("event_datetime", F.timestamp_seconds("sec")), REPORTS)


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def brute_dominated(points, radius=1006.0, window=21600):
    """points: rows (id, lat, lon, sec)."""
    p = np.array(points, dtype=float)
    out = set()
    for i in range(len(p)):
        later = p[p[:, 0] > p[i, 0]]
        later = later[np.abs(later[:, 3] - p[i, 3]) <= window]
        if len(later) and (metres(p[i, 1], p[i, 2], later[:, 1], later[:, 2]) <= radius).any():
            out.add(int(p[i, 0]))
    return sorted(out)


def brute_pairs(fires, events, radius=10000.0, back=172800, ahead=21600):
    """Rows (id, lat, lon, sec) on both sides to sorted (fire id, event id)."""
    f, e = np.array(fires, dtype=float), np.array(events, dtype=float)
    out = []
    for row in f:
        d = metres(row[1], row[2], e[:, 1], e[:, 2]).astype(np.float32)
        ok = (d <= radius) & (e[:, 3] >= row[3] - back) & (e[:, 3] <= row[3] + ahead)
        out += [(int(row[0]), int(x)) for x in e[ok, 0]]
    return sorted(out)


def as_rows(points, **extra):
    return [dict(id=int(i), latitude=float(a), longitude=float(o), sec=int(s), **extra)
            for i, a, o, s in points]
