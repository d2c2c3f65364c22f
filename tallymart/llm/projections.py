"""Embedding near-dedup by sorted projection passes.

Equal vectors are first drawn together into classes. Every pass orders the classes of a label by a
key of concatenated random hashes, the signs of seeded projections of the vectors without their
label's mean, and compares all classes of a block of that order; pairs whose cosine reaches the
threshold, in double precision and of the raw vectors, are links, and the links of all passes are
united. Blocks have equal row counts and overlap by one window, so that no task of a pass holds more
than a block however the keys are distributed.

The passes of a label follow its size and shape: a sample of its vectors says how many signs part a
class from all but a fraction of a block, and how often a pair at the threshold agrees in as many;
passes are added until such a pair is missed with probability ``miss``. Blocks are counted from the
first class of the label, so a label that fits into one block needs one pass, which compares all its
classes. Beyond that there is no other way than passes, whatever they cost.

Blocks bound candidates, not results: within every component that was found, tiles of
at most ``tile`` by ``tile`` classes then compare all classes with all others, so that the links in
groups denser than a block are counted in full. What can be missed is a component that no pass of a
large label joined; the README has the measured recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.links import components, local_forest
from tallymart.llm.ranks import shuffle_partitions, with_positions
from tallymart.workspace import scratch_dir, write_and_read

THRESHOLD = 0.98
PASSES = 12  # at least
SIGNS = 62  # hashes concatenated into a key
WINDOW = 64
BLOCK = 1024
TILE = 1024
MISS = 1e-4  # share of pairs at the threshold that a large label may lose
SAMPLE = 1024  # classes that tell the shape of a label
SEED = 5


def usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component, and not zero."""
    def finite(x: Column) -> Column:
        wide = x.cast("double")
        return x.isNotNull() & ~F.isnan(wide) & (F.abs(wide) != F.lit(float("inf")))

    return F.coalesce(
        vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False)))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of norm 1, in double precision."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither over- nor underflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def passes_needed(unit: np.ndarray, classes: int, threshold: float, least: int, signs: int,
                  block: int, miss: float) -> int:
    """Passes that miss pairs at the threshold with probability ``miss``, judged by a sample.

    A class shares its first L signs with a share of the others that their angles tell; where that
    leaves a quarter of a block, a partner that agrees in L signs lies in the same block.
    """
    if classes <= block:
        return 1
    centred = unit - unit.mean(axis=0)
    norms = np.maximum(np.sqrt((centred * centred).sum(axis=1)), 1e-12)
    turned = centred / norms[:, None]
    agree = 1 - np.arccos(np.clip(turned @ turned.T, -1, 1)) / np.pi
    agree[unit @ unit.T >= threshold] = 0.0  # links lead to the component as well
    chord = np.sqrt(max(2 - 2 * threshold, 0.0))
    partner = 1 - 2 * np.arcsin(np.minimum(1.0, chord / 2 / norms)) / np.pi
    found, shared = np.zeros(len(unit)), np.ones_like(agree)
    for length in range(signs + 1):
        parted = (classes * shared.mean(axis=1) <= block / 4) & (found == 0)
        found[parted] = 0.75 * partner[parted] ** length
        shared *= agree
    passes = least
    while passes < classes and ((1 - found) ** passes).mean() > miss:
        passes += max(1, passes // 8)
    return passes


def label_plans(classes: DataFrame, threshold: float, passes: int, signs: int, block: int,
                miss: float) -> DataFrame:
    """label, size, classes, centre and passes per label and length."""
    label = classes.schema["label"].dataType.simpleString()
    sizes = classes.groupBy("label", "size").agg(F.count("*").alias("classes"))
    drawn = F.pmod(F.xxhash64("class_id"), F.col("classes")) < SAMPLE
    sample = classes.join(sizes, ["label", "size"]).where(drawn)

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        unit, n = unit_rows(rows["embedding"]), int(rows["classes"].iloc[0])
        needed = passes_needed(unit, n, threshold, passes, signs, block, miss)
        return pd.DataFrame({"label": rows["label"].iloc[:1], "size": rows["size"].iloc[:1],
                             "centre": [unit.mean(axis=0).tolist()], "passes": [needed]})

    shapes = sample.select("label", "size", "classes", "embedding").groupBy(
        "label", "size").applyInPandas(
            plan, f"label {label}, size int, centre array<double>, passes int")
    # A label of which the sample holds nothing (hashes can be unlucky) takes the least passes.
    return sizes.join(shapes, ["label", "size"], "left").withColumns({
        "passes": F.coalesce("passes", F.lit(passes)),
        "centre": F.coalesce("centre", F.array_repeat(F.lit(0.0), F.col("size")))})


def sort_keys(classes: DataFrame, signs: int, seed: int) -> DataFrame:
    """One row per class and pass: pass, key and what the comparison needs.

    ``classes`` has the centre and the passes of the label beside each class.
    """

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = 1 << np.arange(signs - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            for (_, size), part in batch.groupby(["label", "size"]):
                centred = unit_rows(part["embedding"]) - np.asarray(part["centre"].iloc[0])
                for number in range(int(part["passes"].iloc[0])):
                    if (size, number) not in planes:
                        planes[size, number] = np.random.default_rng(
                            [seed, size, number]).normal(size=(size, signs))
                    keys = (centred @ planes[size, number] > 0) @ weights
                    yield part.assign(sweep=number, sort_key=keys)[
                        ["sweep", "label", "size", "sort_key", "class_id", "embedding"]]

    return classes.select("class_id", "label", "size", "centre", "passes", "embedding").mapInPandas(
        project, f"sweep int, label {classes.schema['label'].dataType.simpleString()}, size int, "
                 f"sort_key long, class_id long, embedding array<double>")


def forest_of(ids: np.ndarray, unit: np.ndarray, threshold: float) -> pd.DataFrame:
    """Links (a, b) that connect all rows of ``unit`` that are linked with one another."""
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    row, root = local_forest(near)
    return pd.DataFrame({"a": ids[row], "b": ids[root]})


def window_links(keyed: DataFrame, threshold: float, window: int, block: int) -> DataFrame:
    """Links (a, b) that connect all classes linked within a block of some pass."""
    spark = keyed.sparkSession
    order = ["sweep", "label", "size", "sort_key", "class_id"]
    placed, _ = with_positions(keyed, order, shuffle_partitions(spark), "projections")
    run = ["sweep", "label", "size"]
    first = placed.groupBy(*run).agg(F.min("position").alias("start"))
    placed = placed.join(first, run).withColumn("position", F.col("position") - F.col("start"))
    number = F.expr(f"position div {block}")
    # The first rows of a block are also the tail of the block before it.
    homes = F.when(F.col("position") % block < window, F.array(number, number - 1)).otherwise(
        F.array(number))
    blocks = placed.withColumn("block", F.explode(homes)).where(F.col("block") >= 0)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class_id")
        return forest_of(rows["class_id"].to_numpy(), unit_rows(rows["embedding"]), threshold)

    return blocks.groupBy(*run, "block").applyInPandas(compare, "a long, b long").distinct()


def link_counts(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(class_id, linked) per class: rows of other classes of its component that it links with.

    ``members`` has root, class_id, copies and embedding. Every component is cut into tiles; a task
    compares the residents of one tile with the classes of another one.
    """
    packs = max(1, members.count() // tile)
    sizes = members.groupBy("root").agg(
        F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    # Components of one tile share tasks, about a tile's worth of rows in each.
    cut = (
        members.join(sizes, "root")
        .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("tiles").cast("long")).cast("int"))
        .withColumn("task", F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("root"), F.lit(packs)))
                    .otherwise(-1 - F.col("root")))
    )
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    columns = ["task", "root", "class_id", "copies", "embedding"]
    rows = (
        cut.select(*columns, F.col("own").alias("x"), every.alias("y"), F.lit(True).alias("left"))
        .unionByName(cut.select(*columns, every.alias("x"), F.col("own").alias("y"),
                                F.lit(False).alias("left")))
    )

    def count(part: pd.DataFrame) -> pd.DataFrame:
        left, right = part[part["left"]], part[~part["left"]]
        found = [pd.DataFrame({"class_id": [], "linked": []}).astype("int64")]
        for size, some in left.groupby(left["embedding"].map(len)):
            others = right[right["embedding"].map(len) == size]
            if others.empty:
                continue
            near = unit_rows(some["embedding"]) @ unit_rows(others["embedding"]).T >= threshold
            near &= some["root"].to_numpy()[:, None] == others["root"].to_numpy()[None, :]
            near &= some["class_id"].to_numpy()[:, None] != others["class_id"].to_numpy()[None, :]
            found.append(pd.DataFrame({"class_id": some["class_id"].to_numpy(),
                                       "linked": near @ others["copies"].to_numpy()}))
        return pd.concat(found)

    return (rows.groupBy("task", "x", "y").applyInPandas(count, "class_id long, linked long")
            .groupBy("class_id").agg(F.sum("linked").alias("linked")))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES,
                    signs: int = SIGNS, window: int = WINDOW, block: int = BLOCK,
                    tile: int = TILE, seed: int = SEED, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings``.

    Vectors are compared if their labels are equal and not NULL and their lengths are equal.
    Defined cases: a NULL label and an unusable vector (NULL, empty, zero, or with a NULL or
    non-finite component) link with nothing; equal vectors of a label always link; repeated rows are
    vectors of their own; a NULL vec_id names no component but is counted; an empty table gives an
    empty result; further columns are ignored.
    """
    spark = embeddings.sparkSession
    folder = scratch_dir(spark, "projections")
    # -0.0 becomes 0.0, so that equal vectors are equal as group keys.
    rows = embeddings.select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
        .alias("embedding"))
    comparable = usable(F.col("embedding")) & F.col("label").isNotNull()
    classes = write_and_read(
        rows.where(comparable).groupBy("label", "embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
        .withColumn("class_id", F.monotonically_increasing_id()), f"{folder}/classes")
    sized = classes.withColumn("size", F.size("embedding"))
    plans = write_and_read(label_plans(sized, threshold, passes, signs, block, miss),
                           f"{folder}/plans")
    planned = sized.join(plans, ["label", "size"])
    links = window_links(sort_keys(planned, signs, seed), threshold, window, block)
    roots = components(links, "projections/components").withColumnRenamed("node", "class_id")
    linked_classes = roots.unionByName(
        roots.select("root").distinct().select(F.col("root").alias("class_id"), "root"))
    members = write_and_read(classes.join(linked_classes, "class_id"), f"{folder}/members")
    counts = link_counts(members.select("root", "class_id", "copies", "embedding"), threshold,
                         tile)
    smallest = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    in_components = (
        members.select("class_id", "root").join(smallest, "root")
        .join(counts, "class_id", "left").select("class_id", "component_id", "linked"))
    by_class = classes.join(in_components, "class_id", "left").select(
        "label", "embedding",
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "first_id").alias("component_id"))
    linked = rows.where(comparable).join(by_class, ["label", "embedding"]).select(
        "vec_id", "n_links", "component_id")
    alone = rows.where(~comparable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
