"""Ranked lexical search by pipelined term partitioning.

The index is split by term: each stage of the pipeline owns the terms of one range of document
frequencies, the rarest first. Queries travel in bundles of items, which carry their sparse
accumulators (item, document, score so far) from stage to stage. At a stage a bundle meets the
postings of its terms by cogroup and adds integer contributions; an accumulator whose score cannot
reach the tenth-best score of its item any more is left behind, and where no unseen document can, no
accumulator is begun. What the last stage lets through is ranked.

A term's postings are split by blocks of documents, so a term that every document holds is no group
of its own: a cogroup holds one bundle, one block and one stage, whatever the corpus. All scores are
64-bit integers, and a contribution belongs to term and document alone, so that the order of
additions does not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches
from tallymart.llm.ranks import with_positions
from tallymart.workspace import scratch_dir, write_and_read

TOP = 10
BUNDLE_ITEMS = 256
BLOCK_BITS = 11  # 2,048 documents to a block
FILTER_BITS = 20  # size of the term filter that tokenising tasks hold: a fixed 128 KB
# Shares of all postings that the stages before the last one own together, from the rarest term up.
STAGE_SHARES = (1 / 16, 1 / 3)
SALTS = 16

# ASCII letters and digits and all bytes beyond ASCII make terms; only A to Z change case.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term of a whole text."""
    return Counter(text.encode("utf-8", "replace").translate(_TERM_BYTES).split()) if text \
        else Counter()


def _counted(text: Column, known: np.ndarray | None) -> Column:
    """Struct of n (all terms, with repeats), terms and tfs; only terms that pass the filter."""

    @F.pandas_udf("n long, terms array<string>, tfs array<long>")
    def count_terms(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        mask = (1 << FILTER_BITS) - 1
        passing = None if known is None else known.tobytes()
        for batch in batches:
            rows = []
            for text in batch:
                counts = term_counts(text)
                kept = [t for t in counts
                        if passing is None or passing[(h := crc32(t) & mask) >> 3] >> (h & 7) & 1]
                rows.append((sum(counts.values()), [t.decode() for t in kept],
                             [counts[t] for t in kept]))
            yield pd.DataFrame(rows, columns=["n", "terms", "tfs"])

    return count_terms(text)


def _filter_of(terms: DataFrame) -> np.ndarray:
    """A bit for each hash that some term has: at most 2**FILTER_BITS rows reach the driver."""
    slots = terms.select(
        F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        .cast("int").alias("slot")).distinct().toPandas()["slot"].to_numpy(dtype=np.int64)
    bits = np.zeros(1 << FILTER_BITS, dtype=np.uint8)
    bits[slots] = 1
    return np.packbits(bits, bitorder="little")


def _owners(terms: DataFrame) -> Column:
    """The stage that owns a term: by the share of all postings that rarer terms hold.

    Frequencies are compared by their logarithm, so that one row per power of two is collected.
    """
    power = F.floor(F.log2("df")).cast("int")
    masses = {r["power"]: r["mass"] for r in
              terms.groupBy(power.alias("power")).agg(F.sum("df").alias("mass")).collect()}
    total, before, stage = sum(masses.values()), 0, F.lit(0)
    for p in sorted(masses):
        before += masses[p]
        number = sum(before > share * total for share in STAGE_SHARES)
        stage = F.when(power >= p, F.lit(number)).otherwise(stage)
    return stage


def _top_slots(score: np.ndarray, keep: np.ndarray, top: int) -> np.ndarray:
    """Up to ``top`` of the places ``keep``, highest score first, equal ones by place."""
    if len(keep) > top:
        bound = np.partition(score[keep], len(keep) - top)[len(keep) - top]
        above = keep[score[keep] > bound]
        keep = np.concatenate([above, keep[score[keep] == bound][: top - len(above)]])
    return keep[np.lexsort((keep, -score[keep]))]


ACCUMULATORS = ("bundle int, block long, slots array<int>, places array<int>, scores array<long>, "
                "best_slots array<int>, best_scores array<long>")


def _advance(last: bool, top: int):
    """The work of a stage on one bundle and one block of documents."""

    def advance(key: tuple, carried: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        bundle = carried.iloc[0]
        order = np.argsort(postings["term_no"].to_numpy(), kind="stable")
        numbers = postings["term_no"].to_numpy()[order]
        places = postings["place"].to_numpy()[order]
        gains = postings["gain"].to_numpy()[order]
        # Terms of the bundle at this stage, as ranges of the postings.
        slot, times = np.asarray(bundle["item_slots"]), np.asarray(bundle["item_times"])
        wanted = np.asarray(bundle["item_terms"])
        first = np.searchsorted(numbers, wanted, side="left")
        end = np.searchsorted(numbers, wanted, side="right")
        held = {}
        if bundle["slots"] is not None and len(bundle["slots"]):
            slots = np.asarray(bundle["slots"])
            edges = np.flatnonzero(np.diff(slots)) + 1
            held = {int(slots[g[0]]): g for g in np.split(np.arange(len(slots)), edges)}
        old_places, old_scores = np.asarray(bundle["places"]), np.asarray(bundle["scores"])
        least = dict(zip(bundle["least_slots"], bundle["least_scores"])) \
            if bundle["least_slots"] is not None else {}
        later = dict(zip(bundle["later_slots"], bundle["later_bounds"])) \
            if bundle["later_slots"] is not None else {}
        terms_of: dict[int, list[int]] = {}
        for k in np.flatnonzero(end > first):
            terms_of.setdefault(int(slot[k]), []).append(k)
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        best: list[tuple[int, np.ndarray]] = []
        score = np.zeros(1 << BLOCK_BITS, dtype=np.int64)
        for item in sorted(held.keys() | terms_of.keys()):
            if item in held:
                score[old_places[held[item]]] = old_scores[held[item]]
            for k in terms_of.get(item, ()):
                part = slice(first[k], end[k])
                score[places[part]] += times[k] * gains[part]
            found = np.flatnonzero(score)
            leading = _top_slots(score, found, top)
            bound = least.get(item, 1)
            if len(leading) == top:
                bound = max(bound, int(score[leading[-1]]))
            if last:
                keep = leading[score[leading] >= bound]
            else:
                keep = found[score[found] + later.get(item, 0) >= bound]
                best.append((item, score[leading]))
            if len(keep):
                out.append((item, keep.astype(np.int32), score[keep]))
            score[found] = 0

        def flat(parts: list, repeat: list, kind) -> tuple[np.ndarray, np.ndarray]:
            if not parts:
                return np.empty(0, np.int32), np.empty(0, kind)
            return (np.repeat(np.array(repeat, np.int32), [len(p) for p in parts]),
                    np.concatenate(parts).astype(kind))

        out_slots, out_places = flat([p for _, p, _ in out], [i for i, _, _ in out], np.int32)
        _, out_scores = flat([s for _, _, s in out], [i for i, _, _ in out], np.int64)
        best_slots, best_scores = flat([s for _, s in best], [i for i, _ in best], np.int64)
        return pd.DataFrame({
            "bundle": [bundle["bundle"]], "block": [bundle["block"]], "slots": [out_slots],
            "places": [out_places], "scores": [out_scores], "best_slots": [best_slots],
            "best_scores": [best_scores]})

    return advance


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` documents of every item with a score above 0.

    ``documents`` has doc_id and text, ``items`` item_id and text. Defined cases: NULL and empty
    texts have no terms, count in no statistic and are never found; an item without terms that occur
    has no rows; repeated documents are ranked one by one, equal scores by doc_id with NULL last;
    repeated items are answered one by one; empty tables give an empty result; further columns are
    ignored.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    folder = scratch_dir(spark, "lexical")

    asked = write_and_read(
        items.select("item_id", _counted(F.col("text"), None).alias("c")).select("item_id", "c.*"),
        f"{folder}/items")
    numbered, total = with_positions(
        asked.where(F.size("terms") > 0).select("item_id", "terms", "tfs"),
        ["item_id", "terms"], 1 + asked.rdd.getNumPartitions(), "lexical/items")
    numbered = write_and_read(numbered.select(
        "item_id", "terms", "tfs",
        F.floor(F.col("position") / BUNDLE_ITEMS).cast("int").alias("bundle"),
        (F.col("position") % BUNDLE_ITEMS).cast("int").alias("slot")), f"{folder}/numbered")
    pairs = F.explode(F.arrays_zip("terms", "tfs")).alias("p")
    wanted = numbered.select("bundle", "slot", pairs).select(
        "bundle", "slot", F.col("p.terms").alias("term"), F.col("p.tfs").alias("times"))

    # Rows of one partition follow doc_id, so a place in a block says which of two equal scores
    # comes first; once written, the numbers do not change when a task is repeated.
    counted = _counted(F.col("text"), _filter_of(wanted))
    held = write_and_read(
        documents.select("doc_id", counted.alias("c")).select("doc_id", "c.*")
        .sortWithinPartitions(F.asc_nulls_last("doc_id"))
        .withColumn("row", F.monotonically_increasing_id()), f"{folder}/documents")
    n_documents, n_terms = held.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    posted = held.select("row", "n", pairs).select(
        "row", "n", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))

    frequencies = posted.groupBy("term").agg(F.count("*").alias("df")).join(
        wanted.select("term").distinct(), "term", "left_semi")
    weighed = write_and_read(frequencies.withColumn("weight", F.floor(F.lit(1000.0) * F.log(
        F.lit(2.0 * n_documents + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long"))
        .where(F.col("weight") > 0).withColumn("term_no", F.monotonically_increasing_id()),
        f"{folder}/terms")
    owned = write_and_read(weighed.withColumn("stage", _owners(weighed)), f"{folder}/owned")

    # Terms of each bundle, and postings with their contribution. The term side is repeated for
    # every salt, so that the postings of one term are joined in many tasks.
    chosen = wanted.join(owned, "term")
    routes = (
        chosen.select("bundle", "term", "term_no", "weight", "stage").distinct()
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    m = F.expr(f"25 + (75 * n * {n_documents or 0}L) div {n_terms or 1}L")
    gains = (
        posted.withColumn("m", m).withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
        .join(routes, ["term", "salt"])
        .select("bundle", F.shiftright("row", BLOCK_BITS).alias("block"), "stage", "term_no",
                F.col("row").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("place"),
                F.expr("weight * ((1000000000L * tf) div (1000L * tf + 8L * m))").alias("gain")))

    # No document adds more to an item than its weights times one million per repeat.
    limits = chosen.groupBy("bundle", "slot", "stage").agg(
        F.sum(F.col("weight") * F.col("times") * 1_000_000).alias("limit"))
    blocks = held.select(F.shiftright("row", BLOCK_BITS).alias("block")).distinct()
    every = F.explode(F.sequence(F.lit(0), F.lit(max(total - 1, 0) // BUNDLE_ITEMS))).alias("bundle")
    state = blocks.select("block", every).select(
        "bundle", "block", *[F.lit(None).cast(f"array<{kind}>").alias(name) for name, kind in (
            ("slots", "int"), ("places", "int"), ("scores", "long"))])
    least = None
    stages = len(STAGE_SHARES) + 1
    for stage in range(stages):
        terms = chosen.where(F.col("stage") == stage).groupBy("bundle").agg(
            F.collect_list(F.struct("slot", "term_no", "times")).alias("t")).select(
            "bundle", F.col("t.slot").alias("item_slots"), F.col("t.term_no").alias("item_terms"),
            F.col("t.times").alias("item_times"))
        later = limits.where(F.col("stage") > stage).groupBy("bundle", "slot").agg(
            F.sum("limit").alias("limit")).groupBy("bundle").agg(
            F.collect_list(F.struct("slot", "limit")).alias("t")).select(
            "bundle", F.col("t.slot").alias("later_slots"), F.col("t.limit").alias("later_bounds"))
        floors = (least if least is not None else limits.select("bundle", "slot").where("false")
                  .withColumn("score", F.lit(0).cast("long"))).groupBy("bundle").agg(
            F.collect_list(F.struct("slot", "score")).alias("t")).select(
            "bundle", F.col("t.slot").alias("least_slots"), F.col("t.score").alias("least_scores"))
        # One row per bundle on the right: what a bundle carries besides its accumulators.
        carried = state.join(terms, "bundle", "left").join(later, "bundle", "left").join(
            floors, "bundle", "left")
        for name, kind in (("item_slots", "int"), ("item_terms", "long"), ("item_times", "long"),
                           ("places", "int"), ("scores", "long")):
            carried = carried.withColumn(name, F.coalesce(name, F.array().cast(f"array<{kind}>")))
        here = gains.where(F.col("stage") == stage).drop("stage")
        moved = write_and_read(
            carried.groupBy("bundle", "block").cogroup(here.groupBy("bundle", "block"))
            .applyInPandas(_advance(stage == stages - 1, top), ACCUMULATORS),
            f"{folder}/stage{stage}")
        state = moved.select("bundle", "block", "slots", "places", "scores")
        if stage < stages - 1:
            best = moved.select("bundle", F.explode(F.arrays_zip("best_slots", "best_scores"))
                                .alias("b")).select("bundle", F.col("b.best_slots").alias("slot"),
                                                    F.col("b.best_scores").alias("score"))
            least = _ranked(best, ["bundle", "slot"], [F.desc("score")]).where(
                F.col("rank") == top).select("bundle", "slot", "score")

    found = state.select("bundle", "block", F.explode(F.arrays_zip("slots", "places", "scores"))
                         .alias("a")).select(
        "bundle", F.col("a.slots").alias("slot"), F.col("a.scores").alias("score"),
        (F.shiftleft("block", BLOCK_BITS) + F.col("a.places")).alias("row"))
    named = found.join(held.select("row", "doc_id"), "row")
    ranked = _ranked(named, ["bundle", "slot"],
                     [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")])
    return ranked.where(F.col("rank") <= top).join(
        numbered.select("bundle", "slot", "item_id"), ["bundle", "slot"]).select(
        "item_id", "rank", "doc_id", "score")


def _ranked(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
