"""Greedy cover of classes by cells.

A cell brings classes of two kinds (land cover and crop types) to the regions that it lies in. Region by region in
order of name, the candidate is placed that brings most classes still missing there, the first by name of equals, until
none is missing or no candidate brings any; a cell placed for one region counts in all that it lies in.

Gains only fall as cells are placed. So the driver takes the ``AHEAD`` best candidates of each region with their
classes, and places from them as long as the best has a gain now that no other candidate had when they were fetched;
only then the gains are counted anew in Spark. That gives the same cells as counting after each placement, with a job
for many placements. The driver holds the candidates fetched and the missing classes, never the cells as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrispark.operators.relations import cells_of
from agrispark.operators.splits import first_split
from agrispark.registry import query
from agrispark.storage import kept

#: Candidates of a region fetched at a time.
AHEAD = 256
MISSING = "region string, lc array<string>, ct array<string>"


def greedy_cover(cells: DataFrame, targets: DataFrame | None = None, ahead: int = AHEAD) -> tuple[list[tuple[str, str, int]], dict[str, tuple[set, set]], int]:
    """Placements ``(region, cell, gain)`` in order, what stays missing by region, and the number of times gains were counted.

    ``cells``: region, cell, lc, ct (arrays of classes; null counts as empty) and placed (whether the cell is there from
    the start). ``targets``: region, lc, ct; without it, all classes of a region's cells.
    """
    held = kept(cells.select("region", "cell", F.coalesce("lc", F.array().cast("array<string>")).alias("lc"), F.coalesce("ct", F.array().cast("array<string>")).alias("ct"), F.coalesce("placed", F.lit(False)).alias("placed")), "cells")
    classes = lambda where: held.where(where).groupBy("region").agg(F.array_distinct(F.flatten(F.collect_set("lc"))).alias("lc"), F.array_distinct(F.flatten(F.collect_set("ct"))).alias("ct"))
    wanted = targets.select("region", "lc", "ct") if targets is not None else classes("true")
    there = classes("placed").select("region", F.col("lc").alias("_lc"), F.col("ct").alias("_ct"))
    rows = wanted.join(there, "region", "left").collect()  # one row a region
    missing = {r["region"]: tuple(set(r[k] or ()) - set(r[f"_{k}"] or ()) for k in ("lc", "ct")) for r in rows}
    parts = F.collect_list(F.struct("region", "lc", "ct"))
    free = kept(held.groupBy("cell").agg(parts.alias("parts"), F.max("placed").alias("placed")).where("not placed").drop("placed"), "free")
    spark, picks, jobs = cells.sparkSession, [], 0
    todo = sorted(r for r, m in missing.items() if any(m))
    while todo:
        short = spark.createDataFrame([(r, sorted(missing[r][0]), sorted(missing[r][1])) for r in todo], MISSING)
        taken = [c for _, c, _ in picks]
        best = _candidates(free, taken, short, ahead)
        jobs += 1
        done = 0
        for region in todo:
            own = best.get(region, [])
            bound = own[-1][:2] if len(own) == ahead else None  # no cell that was not fetched comes before this
            own = [(cell, by) for _, cell, by in own]
            while any(missing[region]):
                scored = [(-_gain(by[region], missing[region]), cell, by) for cell, by in own if cell not in taken]
                key = min(scored, key=lambda s: s[:2], default=(0, "", None))
                if bound is not None and (key[2] is None or key[:2] > bound):
                    break
                if not key[0]:
                    done += 1
                    break
                taken.append(key[1])
                picks.append((region, key[1], -key[0]))
                for r, brought in key[2].items():
                    if r in missing:
                        missing[r] = tuple(m - b for m, b in zip(missing[r], brought, strict=True))
            else:
                done += 1
                continue
            if bound is not None and (key[2] is None or key[:2] > bound):
                break  # later regions depend on what this one still places
        todo = todo[done:]
    return picks, {r: m for r, m in missing.items() if any(m)}, jobs


def _gain(brought: tuple[set, set], missing: tuple[set, set]) -> int:
    return len(brought[0] & missing[0]) + len(brought[1] & missing[1])


def _candidates(free: DataFrame, taken: list[str], short: DataFrame, ahead: int) -> dict[str, list[tuple[int, str, dict]]]:
    """For each region its best candidates ``(-gain, cell, classes by region)`` in order."""
    gain = F.size(F.array_intersect("p.lc", "lc")) + F.size(F.array_intersect("p.ct", "ct"))
    rows = free.where(~F.col("cell").isin(taken)) if taken else free
    scored = rows.select("cell", "parts", F.explode("parts").alias("p")).withColumn("region", F.col("p.region")).join(F.broadcast(short), "region").withColumn("gain", gain).where("gain > 0")
    first = scored.withColumn("k", F.row_number().over(Window.partitionBy("region").orderBy(F.desc("gain"), "cell"))).where(F.col("k") <= ahead)
    out: dict[str, list] = {}
    for r in first.select("region", "gain", "cell", "parts").collect():  # at most ``ahead`` a region
        out.setdefault(r["region"], []).append((-r["gain"], r["cell"], {p["region"]: (set(p["lc"]), set(p["ct"])) for p in r["parts"]}))
    return {region: sorted(own, key=lambda o: o[:2]) for region, own in out.items()}


def class_cells(samples: DataFrame, by_region: bool) -> DataFrame:
    """Cells with their land covers and crop types by region; those dealt to validation are placed, those of training are candidates."""
    region = F.col("parent") if by_region else F.lit("all")
    split = first_split(samples).select("cell", "split")
    sets = cells_of(samples).groupBy(region.alias("region"), "cell").agg(F.collect_set("landcover").alias("lc"), F.collect_set(F.when(F.col("quality_ct") > 0, F.col("croptype"))).alias("ct"))
    return sets.join(split, "cell").where("split <> 'test'").withColumn("placed", F.col("split") == "val").drop("split")


def _placements(samples: DataFrame, by_region: bool) -> DataFrame:
    picks, _, _ = greedy_cover(class_cells(samples, by_region))
    rows = [(k, *p) for k, p in enumerate(picks)]
    return samples.sparkSession.createDataFrame(rows, "place int, region string, cell string, gain int")


@query("greedy_region_coverage", "samples")
def greedy_region_coverage(samples: DataFrame) -> DataFrame:
    """Cells added to validation until each region has all its classes there."""
    return _placements(samples, True)


@query("greedy_class_coverage", "samples")
def greedy_class_coverage(samples: DataFrame) -> DataFrame:
    """Cells added to validation until it has all classes."""
    return _placements(samples, False)
