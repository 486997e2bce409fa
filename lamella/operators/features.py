"""Feature blocks of a slide, as rows ``slide, feature, value``; a missing population gives null, stated zeros aside.

Values go into two tall tables (``slide, channel, v``), one of what cells, edges and distances say and one of what
neighbourhoods say, and each gets its moments and exact percentiles of all channels at once. Shares and counts are one
aggregation per source. Cells are named by slide and ``cell_id``; no block handles one slide at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.operators.cells import ROLES
from lamella.operators.clusters import CLUSTER_ROLES, MIN_CLUSTER, PAIRS, cluster_hulls, cluster_overlap, cluster_summary, members, tagged, untagged
from lamella.operators.delaunay import Sites, delaunay
from lamella.operators.nearest import nearest
from lamella.operators.order_stats import finite, stat_block
from lamella.session import Table, together

CHANNELS = ("area", "eccentricity", "circularity", "solidity", "major_axis")
TUMOR_CHANNELS = ("area", "eccentricity", "circularity")
EPS, BIN, LEAST_TUMOR, NEAR = 1e-9, 640, 20, 200


def _rows(df: DataFrame, named: dict[str, Column], keys: tuple[str, ...] = ("slide",)) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias("feature"), v.cast("double").alias("value")) for k, v in named.items()])
    return df.select(*keys, F.inline(pairs))


def entropy(shares: Column) -> Column:
    """Shannon entropy (nats) of an array of non-negative weights; 0 if they add up to nothing."""
    total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.aggregate(shares, F.lit(0.0), lambda a, x: a - F.when(x > 0, x / total * F.log(x / total)).otherwise(0.0))).otherwise(0.0)


def tissue(cells: DataFrame) -> DataFrame:
    """``slide, n, tissue_mm2`` and cells per role, by occupied bins of 64 um: no distinct over cells, two small sums."""
    counts = [F.sum(F.when(F.col("role") == r, 1).otherwise(0)).alias(r) for r in ROLES]
    bins = cells.groupBy("slide", F.floor(F.col("qx") / BIN).alias("bx"), F.floor(F.col("qy") / BIN).alias("by")).agg(F.count("*").alias("n"), *counts)
    return bins.groupBy("slide").agg(F.sum("n").alias("n"), (F.count("*") * (BIN / 10) ** 2 / 1e6).alias("tissue_mm2"), *[F.sum(r).alias(r) for r in ROLES])


def composition(cells: DataFrame) -> DataFrame:
    return composition_rows(tissue(cells))


def composition_rows(tissue: DataFrame) -> DataFrame:
    share = {r: F.col(r) / F.col("n") for r in ROLES}
    named = {"slide__n_cells": F.col("n"), "slide__tissue_area_mm2": F.col("tissue_mm2"), "comp__density_per_mm2": F.col("n") / (F.col("tissue_mm2") + EPS)}
    named |= {f"comp__{r}_frac": share[r] for r in ROLES}
    named |= {"comp__tumor_immune_ratio": share["tumor"] / (share["immune"] + EPS), "comp__role_entropy": entropy(F.array(*[share[r] for r in ROLES]))}
    return _rows(tissue, named)


def _complete(found: DataFrame, slides: DataFrame, names: list[str]) -> DataFrame:
    """A row for every slide and name; what wasn't found is null, what isn't named is left out."""
    every = slides.select("slide").distinct().select("slide", F.explode(F.array(*map(F.lit, names))).alias("feature"))
    return every.join(found, ["slide", "feature"], "left").select("slide", "feature", "value")


def _named(*prefixes: str) -> list[str]:
    return [f for f in FEATURES if f.startswith(prefixes)]


def _tall(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``slide, channel, v``: the finite ones of ``values``."""
    rows = df.select("slide", F.inline(F.array(*[F.struct(F.lit(c).alias("channel"), finite(v).alias("v")) for c, v in values.items()])))
    return rows.where("v is not null")


def statistics(values: DataFrame) -> DataFrame:
    """Rows ``slide, feature, value`` of all statistics of each channel of ``slide, channel, v``."""
    s = stat_block(values, ["slide", "channel"])
    stats = {k: F.col(k) for k in ("mean", "std", "p10", "p50", "p90", "skew")} | {"median": F.col("p50")}
    return s.select("slide", F.inline(F.array(*[F.struct(F.concat("channel", F.lit(f"__{k}")).alias("feature"), v.alias("value")) for k, v in stats.items()])))


def cell_values(cells: DataFrame) -> DataFrame:
    return _tall(cells, {f"morph__{c}": F.col(c) for c in CHANNELS} | {f"morph_tumor__{c}": F.when(F.col("role") == "tumor", F.col(c)) for c in TUMOR_CHANNELS})


def enough_tumor(found: DataFrame, tissue: DataFrame) -> DataFrame:
    """Without the tumour cells' statistics of slides with fewer than 20 of them, counted before anything is dropped."""
    few = tissue.where(F.col("tumor") < LEAST_TUMOR).select(F.col("slide").alias("few"))
    return found.join(few, (F.col("slide") == F.col("few")) & F.col("feature").startswith("morph_tumor__"), "left_anti")


def morphometry(cells: DataFrame) -> DataFrame:
    return _complete(statistics(Table(cell_values(cells)).df), cells, _named("morph__"))


def tumor_morphometry(cells: DataFrame) -> DataFrame:
    return _complete(enough_tumor(statistics(Table(cell_values(cells)).df), tissue(cells)), cells, _named("morph_tumor__"))


def directed(edges: DataFrame) -> DataFrame:
    """Both directions of each edge: ``slide, cell_id, other``."""
    e = edges.select("slide", F.col("i").alias("cell_id"), F.col("j").alias("other"))
    return e.unionByName(e.select("slide", F.col("other").alias("cell_id"), F.col("cell_id").alias("other")))


def edge_ends(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with role, type and channels of both ends (``_i``, ``_j``), written out."""
    def end(s: str) -> DataFrame:
        return cells.select("slide", F.col("cell_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("cell_type", "role", *CHANNELS)])

    return Table(edges.select("slide", "i", "j").join(end("i"), ["slide", "i"]).join(end("j"), ["slide", "j"])).df


def medians(found: DataFrame) -> DataFrame:
    """``slide`` and the median ``m_*`` of each channel, from statistics of the cells."""
    return Table(found.groupBy("slide").agg(*[F.max(F.when(F.col("feature") == f"morph__{c}__median", F.col("value"))).alias(f"m_{c}") for c in CHANNELS])).df


def node_measures(cells: DataFrame, ends: DataFrame, median: DataFrame) -> DataFrame:
    """Per cell: ``role``, ``degree``, neighbours per role, ``entropy`` of neighbours' types and the SD of each channel with itself.

    The ends of the edges hold the neighbours' attributes, so one aggregation by cell is all. Values that aren't finite
    count as the slide's median, 0 without one. Isolated cells have degree 0, entropy 0 and SD 0.
    """
    seen = lambda a, b: ends.select("slide", F.col(a).alias("cell_id"), F.lit(True).alias("real"), F.col(f"cell_type_{b}").alias("t"), F.col(f"role_{b}").alias("r"), *[F.col(f"{c}_{b}").alias(c) for c in CHANNELS])
    own = cells.select("slide", "cell_id", F.lit(False).alias("real"), F.col("cell_type").alias("t"), F.col("role").alias("r"), *CHANNELS)
    j = own.unionByName(seen("i", "j")).unionByName(seen("j", "i")).join(median, "slide", "left")
    value = lambda c: F.coalesce(finite(F.col(c)), f"m_{c}", F.lit(0.0))
    # a neighbourhood in a plane graph of short edges is small, so its types may be listed
    out = j.groupBy("slide", "cell_id").agg(
        F.max(F.when(~F.col("real"), F.col("r"))).alias("role"), F.sum(F.col("real").cast("int")).alias("degree"), F.array_sort(F.collect_list(F.when(F.col("real"), F.col("t")))).alias("ts"),
        *[F.sum((F.col("real") & (F.col("r") == r)).cast("int")).alias(f"n_{r}") for r in ROLES], *[F.stddev_pop(value(c)).alias(f"sd_{c}") for c in CHANNELS],
    )
    counts = F.transform(F.array_distinct("ts"), lambda t: F.size(F.filter("ts", lambda u: u == t)).cast("double"))
    return Table(out.withColumn("entropy", entropy(counts)).drop("ts")).df


def nodes_of(cells: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ends and node measures of a graph by itself."""
    ends = edge_ends(cells, edges)
    return ends, node_measures(cells, ends, medians(statistics(Table(cell_values(cells)).df)))


def neighbor_mean(values: DataFrame, edges: DataFrame, include_self: bool = True) -> DataFrame:
    """``slide, cell_id, mean`` of ``value`` over a cell's neighbours; alone it keeps its own value, or null without itself."""
    own = values.select("slide", "cell_id", F.col("value").alias("own"))
    near = directed(edges)
    if include_self:
        near = near.unionByName(own.select("slide", "cell_id", F.col("cell_id").alias("other")))
    mean = near.join(values.select("slide", F.col("cell_id").alias("other"), "value"), ["slide", "other"]).groupBy("slide", "cell_id").agg(F.avg("value").alias("mean"))
    return own.join(mean, ["slide", "cell_id"], "left").select("slide", "cell_id", "mean")


def mixedness(nodes: DataFrame) -> Column:
    return F.when(F.col("degree") > 0, 1 - F.greatest(*[F.col(f"n_{r}") for r in ROLES]) / F.col("degree"))


def measurements(nodes: DataFrame) -> DataFrame:
    """``slide, cell_id`` and what a viewer shows of a cell's neighbourhood; values that aren't defined are 0."""
    part = lambda r: F.when(F.col("degree") > 0, F.col(f"n_{r}") / F.col("degree")).otherwise(0.0)
    sds = [F.col(f"sd_{c}").alias(f"{c}_local_sd") for c in ("area", "eccentricity", "circularity")]
    return nodes.select("slide", "cell_id", part("immune").alias("immune_frac"), part("tumor").alias("tumor_frac"), F.coalesce(mixedness(nodes), F.lit(0.0)).alias("mixedness"), *sds)


def boundary_values(ends: DataFrame) -> DataFrame:
    far = {f"diversity__{c}_at_type_boundary": F.abs(F.col(f"{c}_i").cast("double") - F.col(f"{c}_j").cast("double")) for c in CHANNELS}
    return _tall(ends.where("cell_type_i <> cell_type_j"), far)


def edge_shares(ends: DataFrame, tissue: DataFrame) -> DataFrame:
    """The part of edges between types, and edges between immune and tumour cells against what chance gives."""
    it = ((F.col("role_i") == "immune") & (F.col("role_j") == "tumor")) | ((F.col("role_i") == "tumor") & (F.col("role_j") == "immune"))
    n = ends.groupBy("slide").agg(F.count("*").alias("e"), F.sum(it.cast("int")).alias("it"), F.avg((F.col("cell_type_i") != F.col("cell_type_j")).cast("double")).alias("cross"))
    expected = 2 * (F.col("immune") / F.col("n")) * (F.col("tumor") / F.col("n")) * F.col("e")
    named = {"diversity__cross_type_edge_frac": F.col("cross"), "spatil__immune_tumor_edge_enrichment": F.log((F.col("it") + EPS) / (expected + EPS))}
    return _rows(n.join(tissue.select("slide", "n", "immune", "tumor"), "slide"), named)


def type_boundary(cells: DataFrame, edges: DataFrame) -> DataFrame:
    return _complete(statistics(Table(boundary_values(edge_ends(cells, edges))).df), cells, [f for f in FEATURES if "_at_type_boundary__" in f])


def edge_enrichment(cells: DataFrame, edges: DataFrame) -> DataFrame:
    return _complete(edge_shares(edge_ends(cells, edges), tissue(cells)), cells, ["spatil__immune_tumor_edge_enrichment"])


def node_values(nodes: DataFrame) -> DataFrame:
    around = F.when((F.col("role") == "tumor") & (F.col("degree") > 0), F.col("n_immune") / F.col("degree"))
    return _tall(nodes, {f"diversity__{c}_local_sd": F.col(f"sd_{c}") for c in CHANNELS} | {"diversity__cell_type_diversity": F.col("entropy"), "spatil__tumor_local_immune_frac": around})


def node_shares(nodes: DataFrame) -> DataFrame:
    """Mean degree and mixedness, tumour cells beside an immune one, and neighbours of the own role."""
    named = {"slide__mean_neighbors_per_cell": F.avg("degree"), "diversity__neighborhood_mixedness__mean": F.avg(mixedness(nodes)), "spatil__tumor_with_immune_neighbor_frac": F.avg(F.when(F.col("role") == "tumor", (F.col("n_immune") > 0).cast("double")))}
    named |= {f"spatil__{r}_same_role_frac": F.avg(F.when((F.col("role") == r) & (F.col("degree") > 0), F.col(f"n_{r}") / F.col("degree"))) for r in CLUSTER_ROLES}
    return _rows(nodes.groupBy("slide").agg(*[v.alias(f"v{i}") for i, v in enumerate(named.values())]), {k: F.col(f"v{i}") for i, k in enumerate(named)})


def local_sd(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    return _complete(statistics(Table(node_values(nodes)).df), cells, [f for f in FEATURES if "_local_sd__" in f])


def neighborhood(cells: DataFrame, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Mean degree, type entropy of neighbourhoods, mixedness and the part of edges between types."""
    found = statistics(Table(node_values(nodes)).df).unionByName(node_shares(nodes)).unionByName(edge_shares(ends, tissue(cells)))
    return _complete(found, cells, [*_named("diversity__cell_type_diversity__"), "diversity__neighborhood_mixedness__mean", "slide__mean_neighbors_per_cell", "diversity__cross_type_edge_frac"])


def same_role(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    return _complete(node_shares(nodes), cells, [f"spatil__{r}_same_role_frac" for r in CLUSTER_ROLES])


def distances(cells: DataFrame, splits: DataFrame | None = None, pairs: tuple[tuple[str, str], ...] = (*PAIRS, ("immune", "immune"))) -> DataFrame:
    """``slide, a, b, cell_id, um`` of every cell of role a of each pair to the next other cell of role b; infinite without one.

    ``splits``: those of points tagged by role, where they are known.
    """
    roles = sorted({r for p in pairs for r in p})
    point = cells.where(F.col("role").isin(*roles)).select(F.concat_ws("|", "role", "slide").alias("slide"), F.col("cell_id").alias("id"), "qx", "qy")
    asked = F.explode(F.filter(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs]), lambda p: p["a"] == F.col("role")))
    query = cells.select("slide", F.col("cell_id").alias("id"), "qx", "qy", "role", asked.alias("p")).select(F.concat_ws("|", "p.b", "slide").alias("slide"), "id", "qx", "qy", F.col("p.a").alias("a"))
    found = nearest(query, point, other=True, splits=splits, carried=("a",))
    return untagged(found, "b", "a", F.col("id").alias("cell_id"), (F.col("steps") / 10).alias("um"))


def pair_distances(cells: DataFrame) -> DataFrame:
    return distances(cells, pairs=PAIRS)


def distance_values(found: DataFrame) -> DataFrame:
    name = F.concat(F.lit("spatil__"), F.col("a"), F.lit("_to_"), F.col("b"), F.lit("__nndist_um"))
    return found.where("a <> b and um < double('inf')").select("slide", name.alias("channel"), F.col("um").alias("v"))


def distance_shares(found: DataFrame, near: int = NEAR) -> DataFrame:
    """The part of a role's cells near another role's, and how near tumour immune cells lie against how near stroma."""
    part = lambda a, b: F.avg(F.when((F.col("a") == a) & (F.col("b") == b), (F.col("um") <= near / 10).cast("double")))
    n = found.groupBy("slide").agg(*[part(a, b).alias(f"{a}_{b}") for a, b in PAIRS])
    named = {f"spatil__{a}_near_{b}__frac": F.col(f"{a}_{b}") for a, b in PAIRS} | {"spatil__intratumoral_vs_stromal_immune": F.col("immune_tumor") / (F.col("immune_stroma") + EPS)}
    return _rows(n, named)


def nearest_features(cells: DataFrame, found: DataFrame) -> DataFrame:
    return _complete(statistics(Table(distance_values(found)).df).unionByName(distance_shares(found)), cells, [f for f in FEATURES if "__nndist_um__" in f or "_near_" in f])


def spacing(found: DataFrame, tissue: DataFrame) -> DataFrame:
    """Mean distance of immune cells to the next one against that of as many random points; null under three cells."""
    d = found.where("a = 'immune' and b = 'immune'").groupBy("slide").agg(F.avg("um").alias("nn"), F.count("*").alias("k")).where("k >= 3")
    expected = 0.5 / F.sqrt(F.col("k") / (F.col("tissue_mm2") * 1e6 + EPS))
    return _rows(d.join(tissue.select("slide", "tissue_mm2"), "slide"), {"spatil__immune_spatial_dispersion": F.col("nn") / (expected + EPS)})


def dispersion(cells: DataFrame) -> DataFrame:
    return _complete(spacing(distances(cells, pairs=(("immune", "immune"),)), tissue(cells)), cells, ["spatil__immune_spatial_dispersion"])


def infiltration(cells: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    rows = statistics(Table(node_values(nodes)).df).unionByName(node_shares(nodes)).unionByName(distance_shares(found))
    return _complete(rows, cells, [*_named("spatil__tumor_local_immune_frac__"), "spatil__tumor_with_immune_neighbor_frac", "spatil__intratumoral_vs_stromal_immune"])


def hull_features(cells: DataFrame, hull: DataFrame) -> DataFrame:
    s = Table(cluster_summary(cells, hull)).df
    stats = ["n_clusters", "clustered_frac", "mean_cluster_size", "largest_cluster_size", "mean_cluster_area_mm2", "mean_cluster_density"]
    out = s.select("slide", F.inline(F.array(*[F.struct(F.concat(F.lit("spatil__"), F.col("role"), F.lit(f"__{k}")).alias("feature"), F.col(k).cast("double").alias("value")) for k in stats])))
    one = _rows(s.where("role = 'immune'"), {"spatil__immune_cluster_roundness__mean": F.col("roundness"), "spatil__largest_immune_cluster_area_mm2": F.col("largest_cluster_area_mm2")})
    name = lambda verb, tail: F.concat(F.lit("spatil__"), F.col("a"), F.lit(f"_cluster_{verb}_"), F.col("b"), F.lit(f"_cluster__{tail}"))
    both = F.array(F.struct(name("meets", "frac").alias("feature"), F.col("meets_frac").alias("value")), F.struct(name("overlap", "mean_ratio").alias("feature"), F.col("overlap_ratio").alias("value")))
    return out.unionByName(one).unionByName(cluster_overlap(hull).select("slide", F.inline(both)))


def cluster_features(cells: DataFrame, hull: DataFrame) -> DataFrame:
    return _complete(hull_features(cells, hull), cells, [f for f in FEATURES if "cluster" in f])


def _names() -> list[str]:
    stats = ("mean", "std", "p10", "p90")
    names = ["slide__n_cells", "slide__tissue_area_mm2", "slide__mean_neighbors_per_cell", "comp__density_per_mm2"]
    names += [f"comp__{r}_frac" for r in ROLES] + ["comp__tumor_immune_ratio", "comp__role_entropy"]
    names += [f"morph__{c}__{k}" for c in CHANNELS for k in (*stats, "skew")] + [f"morph_tumor__{c}__{k}" for c in TUMOR_CHANNELS for k in stats]
    names += [f"diversity__{c}_{part}__{k}" for c in CHANNELS for part in ("local_sd", "at_type_boundary") for k in stats]
    names += [f"diversity__cell_type_diversity__{k}" for k in ("mean", "std", "p50", "p90")] + ["diversity__neighborhood_mixedness__mean", "diversity__cross_type_edge_frac"]
    cluster = ("n_clusters", "clustered_frac", "mean_cluster_size", "largest_cluster_size", "mean_cluster_area_mm2", "mean_cluster_density")
    names += [f"spatil__{r}__{k}" for r in CLUSTER_ROLES for k in cluster] + ["spatil__immune_cluster_roundness__mean", "spatil__largest_immune_cluster_area_mm2"]
    for a, b in PAIRS:
        names += [f"spatil__{a}_to_{b}__nndist_um__{k}" for k in ("median", "p10", "p90")]
        names += [f"spatil__{a}_near_{b}__frac", f"spatil__{a}_cluster_meets_{b}_cluster__frac", f"spatil__{a}_cluster_overlap_{b}_cluster__mean_ratio"]
    names += ["spatil__intratumoral_vs_stromal_immune", *[f"spatil__tumor_local_immune_frac__{k}" for k in ("mean", "std", "p50", "p90")], "spatil__tumor_with_immune_neighbor_frac"]
    return names + [f"spatil__{r}_same_role_frac" for r in CLUSTER_ROLES] + ["spatil__immune_tumor_edge_enrichment", "spatil__immune_spatial_dispersion"]


#: The 144 columns of the wide feature table.
FEATURES = _names()


def all_features(cells: DataFrame, longest: int = 500, least: int = MIN_CLUSTER, near: int = NEAR) -> DataFrame:
    """The 144 features of every slide as ``slide, feature, value``.

    ``longest``: the longest edge of the graph and of clusters, in grid steps; ``least``: cells of a cluster; ``near``:
    grid steps within which a cell counts as near another. One run of the graph operator serves all cells and each
    role's own graph.
    """
    spark = cells.sparkSession
    sites = Sites(tagged(cells))
    graph, far, area = together(spark, lambda: delaunay(sites, longest), lambda: Table(distances(cells, sites.splits)).df, lambda: Table(tissue(cells)).df)

    def hull_part() -> DataFrame:
        return Table(hull_features(cells, cluster_hulls(members(graph), least))).df

    def graph_part() -> DataFrame:
        ends = edge_ends(cells, untagged(graph.where("slide like 'all|%'"), "tag", "i", "j"))
        found = Table(statistics(Table(cell_values(cells).unionByName(boundary_values(ends)).unionByName(distance_values(far))).df)).df
        nodes = node_measures(cells, ends, medians(found))
        around = Table(statistics(Table(node_values(nodes)).df)).df
        return enough_tumor(found, area).unionByName(edge_shares(ends, area)).unionByName(around).unionByName(node_shares(nodes))

    rows = [composition_rows(area), distance_shares(far, near), spacing(far, area), *together(spark, hull_part, graph_part)]
    return Table(_complete(reduce(DataFrame.unionByName, rows), area, FEATURES)).df


def wide(features: DataFrame, names: list[str]) -> DataFrame:
    """One row per slide, one column per name, sorted by slide."""
    return features.groupBy("slide").pivot("feature", names).agg(F.first("value")).orderBy("slide")
