"""Site geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialspark.functions.geo import haversine_km
from trialspark.operators import geo, search
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables

CENTER = (10.0, 20.0)
NEAR = "distance(10.0,20.0,900km)"


def duck_km(lat1, lon1, lat2, lon2):
    inner = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"(2 * 6371.0088 * asin(sqrt(least({inner}, 1.0))))"


@query(
    "jn05_region_coverage",
    """SELECT coalesce(s.country, 'unknown') AS country, coalesce(s.state, 'unknown') AS state, count(*) AS site_count,
         count(DISTINCT s.trial_id) AS trial_count, count(DISTINCT t.sponsor_id) AS sponsor_count,
         round(avg(latitude), 6) AS centroid_latitude, round(avg(longitude), 6) AS centroid_longitude
       FROM site s JOIN trial t ON t.trial_id = s.trial_id
       WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""",
    "site trial",
)
def region_coverage(t: Tables):
    rounded = {c: F.round(c, 6) for c in ("centroid_latitude", "centroid_longitude")}
    return geo.region_coverage(t.site, t.trial).withColumns(rounded)


@query(
    "jn02_site_trial_geography",
    """SELECT s.site_id, s.trial_id, t.nct_id, t.overall_status, s.facility_name, s.state, s.country, s.latitude, s.longitude
       FROM site s JOIN trial t ON t.trial_id = s.trial_id""",
    "site trial",
)
def site_trials(t: Tables):
    return geo.site_trial_geography(t.site, t.trial).select(
        "site_id", "trial_id", "nct_id", "overall_status", "facility_name", "state", "country", "latitude", "longitude"
    )


@query(
    "jn03_sites_within_radius",
    f"""SELECT s.site_id, s.trial_id, t.nct_id, s.country, round({duck_km('s.latitude', 's.longitude', *CENTER)}, 6) AS distance_km
        FROM site s JOIN trial t ON t.trial_id = s.trial_id
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND {duck_km('s.latitude', 's.longitude', *CENTER)} <= 900
        ORDER BY {duck_km('s.latitude', 's.longitude', *CENTER)}, s.site_id LIMIT 500""",
    "site trial",
)
def within_radius(t: Tables):
    found = geo.sites_within_radius(t.site, t.trial, *CENTER, radius_km=900.0, max_results=500)
    return found.select("site_id", "trial_id", "nct_id", "country", F.round("distance_km", 6).alias("distance_km"))


@query(
    "jn04_site_catchment",
    f"""WITH pts AS MATERIALIZED (SELECT site_id, trial_id, latitude, longitude FROM site),
        pairs AS (SELECT a.site_id, count(*) AS sites, count(DISTINCT n.trial_id) AS trials
          FROM pts a JOIN pts n ON n.latitude BETWEEN a.latitude - 0.5 AND a.latitude + 0.5 AND n.site_id <> a.site_id
          WHERE {duck_km('a.latitude', 'a.longitude', 'n.latitude', 'n.longitude')} <= 50 GROUP BY 1)
        SELECT p.site_id, p.trial_id, t.nct_id, coalesce(sites, 0) AS nearby_site_count,
          coalesce(trials, 0) AS nearby_trial_count
        FROM pts p JOIN trial t ON t.trial_id = p.trial_id LEFT JOIN pairs ON pairs.site_id = p.site_id""",
    "site trial",
)
def catchment(t: Tables):
    return geo.site_catchment(t.site, t.trial, 50.0)


@query(
    "sc21_great_circle_km",
    f"""SELECT site_id, round({duck_km('latitude', 'longitude', 48.85, 2.35)}, 6) AS km FROM site""",
    "site",
)
def great_circle(t: Tables):
    return t.site.select("site_id", F.round(haversine_km("latitude", "longitude", 48.85, 2.35), 6).alias("km"))


@query(
    "prj19_geo_decay",
    f"""WITH near AS (SELECT trial_id, min({duck_km('latitude', 'longitude', *CENTER)}) AS km FROM site
          WHERE latitude IS NOT NULL GROUP BY 1)
        SELECT trial_id, round(km, 6) AS distance_km,
          round(pow(0.5, greatest(km - 160.9344, 0) / 482.8032), 6) AS proximity_exp,
          round(pow(0.3, pow(greatest(km - 10, 0) / 500, 2)), 6) AS proximity_gauss,
          round(greatest(1 - greatest(km - 10, 0) * 0.9 / 1000, 0), 6) AS proximity_linear
        FROM near WHERE km <= 900""",
    "site",
)
def decay(t: Tables):
    kinds = {
        "exp": "func:exp,scale:300mi,offset:100mi,decay:0.5",
        "gauss": "func:gauss,scale:500km,offset:10km,decay:0.3",
        "linear": "func:linear,scale:1000km,offset:10km,decay:0.1",
    }
    near = search.geo_decay(t.site, NEAR, kinds["exp"]).withColumnRenamed("proximity", "proximity_exp")
    for name in ("gauss", "linear"):
        args = search.parse_decay(kinds[name])
        near = near.withColumn(f"proximity_{name}", search.distance_decay(F.col("distance_km"), **args))
    return near.select("trial_id", *[F.round(c, 6).alias(c) for c in near.columns if c != "trial_id"])
