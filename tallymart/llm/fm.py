"""A second-order factorisation machine over sparse text features.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The last term is the sum-of-squares form of all pairwise interactions <v_i, v_j> x_i x_j; it costs
time linear in the features that a document has.

Features of a document: every distinct word, hashed into ``2**hash_bits`` buckets (weight 1 if
present; with ``affix`` also its first and last bytes, so that inflected forms share a term), and
one bucket per structure statistic or metadata field, the statistic being cut into
bins at quantiles of the fitting sample. Buckets enter the model when enough sampled documents hold
them and their document frequencies differ between the classes by more than chance
(``min_documents``, ``min_z``), or when they are one of the ``pair_terms`` buckets of the strongest
pairs: pairs that occur together in one class more than in the other beyond what each does alone
(``min_pair_z``), among the ``pair_candidates`` buckets whose presence varies most. All other buckets
weigh nothing.

Fitting uses a sample bounded by ``FmConfig.sample_rows`` labelled rows (the smallest hashes of the
row); features are extracted where the documents lie, and one task fits the model on them. Scoring
covers whole texts of all rows in Arrow batches, with the model broadcast: its size is bounded by
``hash_bits``, ``rank`` and ``max_terms``, not by the data.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Terms and rows of the blocks in which pairs are screened: they bound the memory of a fit.
PAIR_BLOCK, PAIR_ROWS = 256, 2048
# From whole text in UTF-8 and its words to one value per structure statistic.
Statistics = Callable[[bytes, list[bytes]], list[float]]


@dataclass(frozen=True)
class FmConfig:
    """``sample_rows`` bounds the labelled rows that the model is fitted on."""

    sample_rows: int = 10_000
    hash_bits: int = 20
    affix: int = 0  # bytes of a word's beginning and ending that are terms too; 0: none
    rank: int = 4
    bins: int = 8
    max_terms: int = 4096
    min_documents: int = 5
    min_z: float = 5.0  # chance alone reaches this in less than one of 2**20 buckets
    pair_candidates: int = 2048
    pair_terms: int = 256
    min_pair_z: float = 8.0
    epochs: int = 250
    learning_rate: float = 0.05
    l2_linear: float = 1e-4
    l2_factors: float = 1e-3
    seed: int = 7


@dataclass
class FmModel:
    """Weights of the buckets that entered the model; row 0 of each array is the bias or zero."""

    config: FmConfig
    terms: np.ndarray  # bucket -> row, 0 for buckets without weight
    cuts: list[np.ndarray]  # per statistic, the inner bin edges
    first_bin: np.ndarray  # per statistic, the row of its first bin
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows_of(self, buckets: np.ndarray, statistics: Sequence[float]) -> np.ndarray:
        rows = self.terms[buckets]
        rows = rows[rows > 0]
        bins = [
            first + (len(cut) + 1 if np.isnan(x) else int(np.searchsorted(cut, x, side="right")))
            for cut, first, x in zip(self.cuts, self.first_bin, statistics)
        ]
        return np.concatenate([rows, np.array(bins, dtype=rows.dtype)])

    def score_rows(self, rows: np.ndarray) -> float:
        """One document, all features having the value 1."""
        v = self.factors[rows]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        logit = self.bias + float(self.linear[rows].sum()) + pairs
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))))


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A to Z only); every byte beyond ASCII counts as a letter."""
    return WORD.findall(text.lower())


def buckets_of(words: list[bytes], config: FmConfig) -> np.ndarray:
    """Distinct hash buckets of the words and, if asked for, of their beginnings and endings."""
    terms = set(words)
    if config.affix:
        k = config.affix
        longer = [w for w in terms if len(w) > k]
        terms.update([b"^" + w[:k] for w in longer])
        terms.update([b"$" + w[-k:] for w in longer])
    hashed = np.fromiter(map(zlib.crc32, terms), dtype=np.int64, count=len(terms))
    return np.unique(hashed & ((1 << config.hash_bits) - 1))


def _encode(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def _number(value) -> float:
    return float("nan") if value is None else float(value)


def features(texts: pd.Series, metadata: Sequence[pd.Series], statistics: Statistics,
             config: FmConfig) -> Iterator[tuple[np.ndarray, list[float]]]:
    """Buckets and statistics (metadata last) of each row."""
    columns = [series.astype("float64", copy=False).tolist() for series in metadata]
    for i, text in enumerate(texts):
        raw = _encode(text)
        words = words_of(raw)
        yield (buckets_of(words, config),
               statistics(raw, words) + [_number(c[i]) for c in columns])


def paired_terms(labels: np.ndarray, buckets: list[np.ndarray], in_all: np.ndarray,
                 config: FmConfig) -> np.ndarray:
    """Buckets of the pairs whose covariance differs most between the classes, strongest first."""
    n, ones = len(labels), int((labels != 0).sum())
    share = in_all / max(n, 1)
    varies = np.where(in_all >= max(config.min_documents, 1), share * (1 - share), 0.0)
    terms = np.argsort(-varies, kind="stable")[: config.pair_candidates]
    terms = terms[varies[terms] > 0]
    if len(terms) < 2 or ones in (0, n):
        return terms[:0]
    column = np.full(len(in_all), -1)
    column[terms] = np.arange(len(terms))
    present = np.zeros((n, len(terms)), dtype=np.uint8)
    for row, found in enumerate(buckets):
        known = column[found]
        present[row, known[known >= 0]] = 1
    classes = [np.flatnonzero(labels != 0), np.flatnonzero(labels == 0)]
    shares = [present[rows].mean(axis=0, dtype=np.float64) for rows in classes]
    # A pair counts by what it tells beyond the better one of its terms.
    alone = np.abs(shares[0] - shares[1]) / np.sqrt(varies[terms] * (1 / ones + 1 / (n - ones)))
    expected = share[terms]
    strongest = np.zeros(len(terms))
    blocks = [slice(at, min(at + PAIR_BLOCK, len(terms)))
              for at in range(0, len(terms), PAIR_BLOCK)]
    for i, left in enumerate(blocks):
        for right in blocks[i:]:
            difference, variance = 0.0, 0.0
            for sign, rows, p in zip((1, -1), classes, shares):
                a, b, size = p[left], p[right], len(rows)
                both = _together(present, rows, left, right) / size
                covariance, rest_a, rest_b = both - np.outer(a, b), 1 - 2 * a, 1 - 2 * b
                square = np.outer(a * a, b * b) + np.outer(a * a, rest_b * b)
                square += np.outer(rest_a * a, b * b)
                square += np.outer(rest_a, rest_b) * both  # mean of the squared centred products
                independent = np.outer(a * (1 - a), b * (1 - b))
                difference = difference + sign * covariance
                variance = variance + np.maximum(square - covariance ** 2, independent) / size
            z = np.abs(difference) / np.sqrt(np.maximum(variance, 1e-12))
            z -= np.maximum.outer(alone[left], alone[right])
            hardly = n * np.outer(expected[left], expected[right]) < config.min_documents
            z[hardly] = 0.0
            if left == right:
                np.fill_diagonal(z, 0.0)
            strongest[left] = np.maximum(strongest[left], z.max(axis=1))
            strongest[right] = np.maximum(strongest[right], z.max(axis=0))
    order = np.argsort(-strongest, kind="stable")[: config.pair_terms]
    return terms[order[strongest[order] >= config.min_pair_z]]


def _together(present: np.ndarray, rows: np.ndarray, left: slice, right: slice) -> np.ndarray:
    """In how many of the rows each pair of columns is present, from a few rows at a time."""
    counts = np.zeros((left.stop - left.start, right.stop - right.start))
    for at in range(0, len(rows), PAIR_ROWS):
        some = rows[at:at + PAIR_ROWS]
        counts += present[some, left].astype(np.float32).T @ present[some, right].astype(np.float32)
    return counts


def fit_arrays(labels: np.ndarray, buckets: list[np.ndarray], statistics: np.ndarray,
               config: FmConfig) -> FmModel:
    """Fit on documents held in memory; ``statistics`` has one row per document."""
    n = len(labels)
    size = 1 << config.hash_bits
    y = labels.astype(np.float64)
    positive = max(y.sum(), 1e-9)
    negative = max(n - y.sum(), 1e-9)
    in_one, in_all = np.zeros(size), np.zeros(size)
    for label, found in zip(y, buckets):
        in_all[found] += 1
        if label:
            in_one[found] += 1
    share = in_all / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share) * (1 / positive + 1 / negative), 1e-18))
    z = (in_one / positive - (in_all - in_one) / negative) / spread
    z[in_all < config.min_documents] = 0.0
    chosen = np.flatnonzero(np.abs(z) >= config.min_z)
    chosen = chosen[np.argsort(-np.abs(z[chosen]), kind="stable")]
    paired = paired_terms(labels, buckets, in_all, config)[: config.max_terms]
    alone = chosen[~np.isin(chosen, paired)][: config.max_terms - len(paired)]
    chosen = np.sort(np.concatenate([alone, paired]))
    terms = np.zeros(size, dtype=np.int32)
    terms[chosen] = np.arange(1, len(chosen) + 1, dtype=np.int32)

    cuts, first_bin, width = [], [], 1 + len(chosen)
    grid = np.linspace(0, 1, config.bins + 1)[1:-1]
    for column in statistics.T:
        known = column[~np.isnan(column)]
        cut = np.unique(np.quantile(known, grid)) if len(known) else np.empty(0)
        cuts.append(cut)
        first_bin.append(width)
        width += len(cut) + 2  # the last bin is for missing values
    rng = np.random.default_rng(config.seed)
    model = FmModel(config, terms, cuts, np.array(first_bin, dtype=np.int64), 0.0,
                    np.zeros(width), rng.normal(0, 0.05, (width, config.rank)))
    if n == 0 or y.sum() in (0, n):  # nothing to tell apart: the smoothed share of ones
        model.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        model.factors[:] = 0.0
        return model

    rows = [model.rows_of(found, x) for found, x in zip(buckets, statistics)]
    flat = np.concatenate(rows)
    document = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    model.bias = float(np.log(positive / negative))
    parameters = [np.array([model.bias]), model.linear, model.factors]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]])
    del rows
    for step in range(1, config.epochs + 1):
        # One factor at a time: what is held grows with the features, not with features x rank.
        logit = parameters[0][0] + np.add.reduceat(model.linear[flat], starts)
        summed = []
        for f in range(config.rank):
            v = model.factors[flat, f]
            summed.append(np.add.reduceat(v, starts))
            v *= v
            logit += 0.5 * (summed[f] ** 2 - np.add.reduceat(v, starts))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n
        per_feature = error[document]
        by_factor = [
            np.bincount(flat, per_feature * (summed[f][document] - model.factors[flat, f]), width)
            for f in range(config.rank)]
        gradient = [
            np.array([error.sum()]),
            np.bincount(flat, per_feature, width) + config.l2_linear * model.linear,
            np.stack(by_factor, 1) + config.l2_factors * model.factors,
        ]
        for p, g, (mean, square) in zip(parameters, gradient, moments):  # Adam
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            p -= (config.learning_rate * (mean / (1 - 0.9 ** step))
                  / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8))
    model.bias = float(parameters[0][0])
    unseen = np.bincount(flat, minlength=width) == 0  # bins without a row keep no random weights
    model.linear[unseen] = 0.0
    model.factors[unseen] = 0.0
    return model


MODEL_FIELDS = ("terms binary, cuts array<array<double>>, first_bin array<bigint>, bias double, "
                "linear binary, factors binary")


def fit(documents: DataFrame, labels: DataFrame, label: str, learn_from: Column,
        statistics: Statistics, metadata: Sequence[str] = (),
        config: FmConfig = FmConfig()) -> FmModel:
    """Fit on labelled documents.

    ``labels`` has ``doc_id`` and the 0/1 column ``label``; rows with a NULL id or label teach
    nothing, and a document that is labelled twice counts twice. ``learn_from`` is a condition on
    ``doc_id``: only rows where it is true are seen at all. Without any such row the model scores
    every document 0.5.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    order = F.xxhash64("doc_id", "label")
    sample = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(learn_from & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .orderBy(order, "doc_id", "label").limit(config.sample_rows)
    )
    # The sample is bounded by sample_rows, so it may be broadcast; repeated document rows are
    # bounded once more after the join.
    columns = documents.select("doc_id", "text", *metadata)
    matched = (
        columns.join(F.broadcast(sample), "doc_id")
        .select("label", F.xxhash64("doc_id", "text").alias("key"), "text", *metadata)
    )
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = features(batch["text"], [batch[m] for m in metadata], statistics, config)
            rows = [(b.astype("<i4").tobytes(), s) for b, s in found]
            yield pd.DataFrame({
                "key": batch["key"], "label": batch["label"],
                "buckets": [b for b, _ in rows], "statistics": [s for _, s in rows],
            })

    drawn = (
        matched.mapInPandas(extract, "key long, label int, buckets binary, "
                                     "statistics array<double>")
        .orderBy("key", "label").limit(config.sample_rows)
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b for b in batches] or [pd.DataFrame(
            {"key": [], "label": [], "buckets": [], "statistics": []})])
        rows = rows.sort_values(["key", "label"], kind="stable")
        buckets = [np.frombuffer(b, "<i4").astype(np.int64) for b in rows["buckets"]]
        stats = np.array([list(s) for s in rows["statistics"]], dtype=np.float64)
        width = len(statistics(b"", [])) + len(metadata)
        model = fit_arrays(rows["label"].to_numpy(dtype=np.int64), buckets,
                           stats.reshape(len(rows), width), config)
        yield pd.DataFrame({
            "terms": [model.terms.astype("<i4").tobytes()],
            "cuts": [[c.tolist() for c in model.cuts]],
            "first_bin": [model.first_bin.tolist()], "bias": [model.bias],
            "linear": [model.linear.tobytes()], "factors": [model.factors.tobytes()],
        })

    [row] = drawn.repartition(1).mapInPandas(learn, MODEL_FIELDS).collect()
    return FmModel(
        config, np.frombuffer(row["terms"], "<i4"), [np.array(c) for c in row["cuts"]],
        np.array(row["first_bin"], dtype=np.int64), row["bias"],
        np.frombuffer(row["linear"]), np.frombuffer(row["factors"]).reshape(-1, config.rank),
    )


def score(documents: DataFrame, model: FmModel, statistics: Statistics,
          metadata: Sequence[str] = ()) -> Column:
    """Score of each row of ``documents`` as a column over ``text`` and the metadata columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def fm_score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        known = shared.value
        for batch in batches:
            found = features(batch["text"], [batch[m] for m in metadata], statistics, known.config)
            yield pd.Series([known.score_rows(known.rows_of(b, s)) for b, s in found],
                            dtype="float64")

    return fm_score(F.struct("text", *metadata))
