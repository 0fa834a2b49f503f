"""Site geography: radius search, catchment and region coverage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.functions.geo import (
    EARTH_RADIUS_KM,
    bounding_box,
    cells_in_reach,
    chord_km,
    cube_cell,
    earth_xyz,
    haversine_km,
)
from trialspark.session import cut_lineage

#: Largest and smallest edge of a tile in radii, rows of a tile that one group takes on either side, and pairs compared at a time.
TILE, SMALL_TILE, TILE_ROWS, BLOCK = 8, 2, 100_000, 500_000
_LOCATED = "latitude is not null and longitude is not null"


def site_trial_geography(sites: DataFrame, trials: DataFrame) -> DataFrame:
    return sites.join(trials.select("trial_id", "nct_id", "overall_status"), "trial_id")


def sites_within_radius(
    sites: DataFrame,
    trials: DataFrame,
    lat: float,
    lon: float,
    radius_km: float = 50.0,
    max_results: int = 500,
) -> DataFrame:
    """Nearest sites to a point. The bounding box is pushed to the scan; only its rows are measured."""
    near = (
        sites.filter(_LOCATED)
        .filter(bounding_box(lat, lon, radius_km, "latitude", "longitude"))
        .withColumn("distance_km", haversine_km("latitude", "longitude", lat, lon))
        .filter(F.col("distance_km") <= radius_km)
    )
    return (
        near.join(trials.select("trial_id", "nct_id"), "trial_id")
        .orderBy("distance_km", "site_id")
        .limit(max(max_results, 1))
    )


def _folded(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of each distinct one, the place of every row among them, and how many each stands for."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back, np.bincount(back)


def _near(anchors: pa.Table, others: pa.Table, radius_km: float) -> pa.Table:
    """For each of ``anchors``, the sites, trials and sites of its own trial among ``others`` within the radius.

    Rows are folded to (coordinate, trial) first. Cube by cube of the radius' edge, anchors meet the rows of touching cubes as blocks of a product of
    bounded size: it decides but for what lies next to the limit, where the exact distance is taken.
    """
    def numbers(table, name):
        return table[name].to_numpy().astype(float)

    def space(lat, lon):
        return EARTH_RADIUS_KM * np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)

    trial = pa.chunked_array([*anchors["trial_id"].chunks, *others["trial_id"].chunks], anchors.schema.field("trial_id").type)
    code = trial.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    code, o_code = code[: len(anchors)], code[len(anchors) :]
    pick, back, _ = _folded(numbers(anchors, "longitude"), numbers(anchors, "latitude"), code)
    order, _, n = _folded(numbers(others, "longitude"), numbers(others, "latitude"), o_code)
    code, o_code, n = code[pick], o_code[order], n.astype(float)
    lat, lon = (np.radians(numbers(anchors, c))[pick] for c in ("latitude", "longitude"))
    o_lat, o_lon = (np.radians(numbers(others, c))[order] for c in ("latitude", "longitude"))
    at, o_at = space(lat, lon), space(o_lat, o_lon)
    cube, o_cube = np.floor(at / radius_km).astype(np.int64), np.floor(o_at / radius_km).astype(np.int64)
    limit = chord_km(radius_km) ** 2
    slack = 1e-6 * limit + 1e-6
    sure, out = EARTH_RADIUS_KM**2 - (limit - slack) / 2, EARTH_RADIUS_KM**2 - (limit + slack) / 2
    sums = np.zeros((3, len(pick)), np.int64)
    cells, cell_of = np.unique(cube, axis=0, return_inverse=True)
    by_cell = np.argsort(cell_of.ravel(), kind="stable")
    for cell, rows in zip(cells, np.split(by_cell, np.cumsum(np.bincount(cell_of.ravel()))[:-1])):
        near_by = np.flatnonzero((np.abs(o_cube - cell) <= 1).all(axis=1))
        if not len(near_by):
            continue
        c, weight = o_code[near_by], n[near_by]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        size = np.diff(np.r_[first, len(c)])
        alone = (np.repeat(size, size) == 1) & (c >= 0)  # rows whose trial has no other here count by themselves
        many = np.flatnonzero((np.repeat(size, size) > 1) & (c >= 0))
        starts = np.flatnonzero(np.r_[True, c[many][1:] != c[many][:-1]]) if len(many) else many
        weights = np.stack([weight, alone.astype(float)], axis=1)
        _, first, place = np.unique(np.stack([lat[rows], lon[rows]], axis=1), axis=0, return_index=True, return_inverse=True)
        place, points = place.ravel(), rows[first]
        by_place = np.argsort(place, kind="stable")
        step = max(1, BLOCK // len(near_by))
        for low in range(0, len(points), step):
            p = points[low : low + step]
            dot = at[p] @ o_at[near_by].T
            near = dot >= sure
            i, j = np.nonzero((dot >= out) & ~near)
            if len(i):
                a, b = p[i], near_by[j]
                half = np.sin((o_lat[b] - lat[a]) / 2) ** 2 + np.cos(lat[a]) * np.cos(o_lat[b]) * np.sin((o_lon[b] - lon[a]) / 2) ** 2
                near[i, j] = 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(half, 1.0))) <= radius_km
            sites, trials = (near.astype(float) @ weights).T
            if len(many):
                trials = trials + np.logical_or.reduceat(near[:, many], starts, axis=1).sum(axis=1)
            q = by_place[np.searchsorted(place[by_place], low) : np.searchsorted(place[by_place], low + len(p))]
            mine, of = rows[q], place[q] - low
            sums[0, mine], sums[1, mine] = sites[of], trials[of]
            begin, end = np.searchsorted(c, code[mine]), np.searchsorted(c, code[mine], "right")
            who = np.repeat(np.arange(len(q)), end - begin)
            row = np.arange(len(who)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + np.repeat(begin, end - begin)
            sums[2, mine] = np.bincount(who, near[of[who], row] * weight[row], len(q))
    return pa.table(dict(zip(("sites", "trials", "own"), map(pa.array, sums[:, back]))))


def site_catchment(sites: DataFrame, trials: DataFrame, radius_km: float = 50.0, most: int = TILE_ROWS) -> DataFrame:
    """Other sites, and distinct trials of other sites, within the radius of each site.

    Sites are written once and dealt to the tiles of a coarse cube grid that they are in reach of; each is an
    anchor in the tile that holds it. Pairs are counted where they meet and never leave the task, so what moves and
    is written grows with the sites; the comparisons with the pairs of near points. Tiles are made smaller while
    those of more than ``most`` rows hold most of the rows. What is crowded then, a dense city, is cut into parts
    that meet in pairs: the rows of a trial share a part, so that sites and distinct trials add up over the parts.
    An anchor leaves the sums of its point: itself from the sites, and its trial from the trials when no other site
    of that trial is near.
    """
    at, ids = ["latitude", "longitude"], ["site_id", "trial_id"]
    stored = cut_lineage(sites.select(*ids, *at))
    point = stored.filter(_LOCATED).withColumn("point", earth_xyz(*at))

    def in_reach(edge: float) -> DataFrame:
        return cells_in_reach(point, "point", edge, "tile", radius_km)

    total, edge = point.count(), TILE * radius_km
    while True:
        sizes = in_reach(edge).groupBy("tile").agg(F.count("*").alias("n"))
        crowded = cut_lineage(sizes.withColumn("_parts", F.ceil(F.col("n") / most).cast("int")).filter("_parts > 1"))
        rows = crowded.agg(F.sum("n")).first()[0] or 0
        if 2 * rows <= total or edge / 2 < SMALL_TILE * radius_km:
            break
        edge /= 2
    own = (cube_cell(F.col("point"), edge) == F.col("tile")) & F.col("trial_id").isNotNull()
    # only an anchor carries the id of its site
    placed = in_reach(edge).select(F.when(own, F.col("site_id")).alias("site_id"), "trial_id", *at, "tile", own.alias("own"))

    kinds = {f.name: f.dataType.simpleString() for f in stored.schema}

    def beside(columns: list[str], anchors: pa.Table, others: pa.Table) -> pa.Table:
        found = _near(anchors, others, radius_km)
        return pa.table({c: anchors[c] for c in columns} | {c: found[c] for c in found.column_names})

    def schema(columns: list[str]) -> str:
        return ", ".join([f"{c} {kinds.get(c, 'int')}" for c in columns] + ["sites bigint, trials bigint, own bigint"])

    whole = placed.join(crowded.select("tile"), "tile", "left_anti") if rows else placed
    sums = whole.groupBy("tile").applyInArrow(lambda here: beside(ids, here.filter(here["own"]), here), schema(ids))
    if rows:
        def dealt(df: DataFrame, part: str, meets: str, *key: str) -> DataFrame:
            return df.withColumns({
                part: F.pmod(F.xxhash64(*key), "_parts").cast("int"), meets: F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
            })

        block, same = ["tile", "_anchors", "_others"], [*ids, *at, "_parts"]
        apart = placed.join(crowded.select("tile", "_parts"), "tile")
        of_parts = (
            dealt(apart.filter("own"), "_anchors", "_others", *at, "trial_id").groupBy(*block)
            # renamed, so that the two sides do not share columns
            .cogroup(dealt(apart.toDF(*apart.columns), "_others", "_anchors", "trial_id").groupBy(*block))
            .applyInArrow(lambda anchors, others: beside(same, anchors, others), schema(same))
        )
        # equal rows have equal sums; each met every part
        copies = (F.count("*") / F.col("_parts")).cast("int").alias("copies")
        added = of_parts.groupBy(*same).agg(copies, *[F.sum(c).alias(c) for c in ("sites", "trials", "own")])
        added = added.select(*ids, *[(F.col(c) / F.col("copies")).cast("bigint").alias(c) for c in ("sites", "trials", "own")], F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
        sums = sums.unionByName(added.drop("copy"))
    near = sums.select(
        *ids, (F.col("sites") - 1).alias("nearby_site_count"),
        (F.col("trials") - F.when(F.col("own") == 1, 1).otherwise(0)).alias("nearby_trial_count"),
    )
    nowhere = stored.filter(f"not ({_LOCATED})").select(*ids, F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    return (
        near.union(nowhere)
        .join(trials.select("trial_id", "nct_id"), "trial_id")
        .select("site_id", "trial_id", "nct_id", "nearby_site_count", "nearby_trial_count")
    )


def region_coverage(sites: DataFrame, trials: DataFrame) -> DataFrame:
    """Sites, distinct trials, distinct sponsors and mean position per (country, state).

    Distinct counts come from grouping in steps (trial, then sponsor, then region), so a region with
    a third of all sites is merged map-side at every step. The first step keeps the partitioning of
    the join.
    """
    located = sites.filter(_LOCATED).select(
        F.coalesce("country", F.lit("unknown")).alias("country"),
        F.coalesce("state", F.lit("unknown")).alias("state"),
        "trial_id",
        "latitude",
        "longitude",
    )
    sums = [F.sum(c).alias(c) for c in ("sites", "lat", "lon")]
    per_trial = (
        located.join(trials.select("trial_id", "sponsor_id"), "trial_id")
        .groupBy("country", "state", "trial_id", "sponsor_id")
        .agg(F.count("*").alias("sites"), F.sum("latitude").alias("lat"), F.sum("longitude").alias("lon"))
    )
    per_sponsor = per_trial.groupBy("country", "state", "sponsor_id").agg(F.count("*").alias("trials"), *sums)
    return (
        per_sponsor.groupBy("country", "state")
        .agg(F.sum("trials").alias("trials"), F.count("sponsor_id").alias("sponsor_count"), *sums)
        .select(
            "country",
            "state",
            F.col("sites").alias("site_count"),
            F.col("trials").alias("trial_count"),
            "sponsor_count",
            (F.col("lat") / F.col("sites")).alias("centroid_latitude"),
            (F.col("lon") / F.col("sites")).alias("centroid_longitude"),
        )
    )
