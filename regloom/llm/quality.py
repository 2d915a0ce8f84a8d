"""Quality rules: exact base rules, and robust multivariate outliers for each language and source.

The statistics of a text are transformed to a short vector. For each (language, source) a minimum-covariance-determinant
estimate is found over all rows that pass the base rules. Three starts (spreads of the coordinates alone, the covariance of
all rows, that of squashed coordinates) take concentration steps: distances under the present estimate, the central three
quarters, their mean and covariance. The start with the smallest determinant goes on until it falls no more. A document
whose Mahalanobis distance under the final estimate is beyond the cut is rejected. All steps are aggregates; only one row
for each (language, source) is ever gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, staged

SYMBOLS = "#*$%&|<>"
FEATURES = ("x0", "x1", "x2", "x3", "x4")
#: Smallest standard deviation of each feature that counts: log words, log mean word length, and square roots of the
#: shares of symbols, of repeated lines and of repeated words.
FLOORS = (0.25, 0.05, 0.05, 0.1, 0.1)
CENTRAL = 0.75
#: Concentration steps of every start, and of the best one at most; these end when no determinant falls by FALL any more.
STEPS, MORE_STEPS, FALL = 2, 6, 1e-6
#: Smallest eigenvalue of a correlation matrix that counts: rows on a line or a plane still have an inverse.
LEAST_EIGEN = 0.02
#: Estimates of so many groups are sent to all tasks; more are joined by shuffle.
FEW_GROUPS = 10_000
#: Median of chi-square with 5 degrees of freedom: the scale at which the central part of a normal sample lies.
MEDIAN = 4.3515
#: Squared distance beyond which a document is an outlier; chi-square with 5 degrees of freedom exceeds it once in 10^9.
CUT = 50.0
#: Groups with fewer rows take the estimate of their language, or else of all rows.
FEWEST = 60

_WORDS = re.compile(WORD)
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def text_statistics(text: str) -> tuple[int, int, int, int, int, int]:
    words = _WORDS.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if _WORDS.search(x)]
    repeated = 0
    if n >= 4:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        grams = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] * np.uint64(0x165667B19E3779F9)
        order = np.argsort(grams, kind="stable")
        same = grams[order[1:]] == grams[order[:-1]]
        if same.any():
            twice = np.zeros(n - 2, dtype=bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            hit = np.zeros(n, dtype=bool)
            for k in range(3):
                hit[k : n - 2 + k] |= twice
            repeated = int(hit.sum())
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in STATS.split(", ")]
    for batch in batches:
        rows = [text_statistics(t or "") for t in batch.column(3).to_pylist()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.record_batch([*batch.columns[:3], *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "lang", "source", *names])


def _vector() -> list[Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [
        F.log1p("n_words").alias("x0"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("x1"),
        share("n_symbols", "word_chars").alias("x2"),
        share("n_dup_lines", "n_lines").alias("x3"),
        share("n_repeat_words", "n_words").alias("x4"),
    ]


_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def _inverses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Covariances c_ij to entries c_ij of the inverse, and the logarithm of the determinant.

    Variances below their floor are raised to it, and eigenvalues of the correlation matrix to LEAST_EIGEN, so singular
    covariances (two repeated texts, say) have a positive definite inverse too.
    """
    n = len(FEATURES)
    for f in frames:
        out = f.copy()
        for row in range(len(f)):
            m = np.zeros((n, n))
            for i, j in _PAIRS:
                m[i, j] = m[j, i] = f[f"c{i}{j}"].iloc[row] or 0.0
            m = np.nan_to_num(m)
            sd = np.maximum(np.sqrt(np.maximum(np.diag(m), 0.0)), FLOORS)
            r = m / np.outer(sd, sd)
            r[np.diag_indices(n)] = 1.0
            value, vector = np.linalg.eigh(r)
            value = np.maximum(value, LEAST_EIGEN)
            inverse = (vector / value) @ vector.T / np.outer(sd, sd)
            for i, j in _PAIRS:
                out.loc[out.index[row], f"c{i}{j}"] = inverse[i, j]
            out.loc[out.index[row], "det"] = np.log(value).sum() + 2 * np.log(sd).sum()
        yield out


_MEANS = [f"m{i}" for i in range(len(FEATURES))]
_COVS = [f"c{i}{j}" for i, j in _PAIRS]


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(FEATURES)],
        *[F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i, j in _PAIRS],
    )


def _small(estimates: DataFrame) -> DataFrame:
    """One row for each group, to be joined: sent to all tasks after its size was checked."""
    return F.broadcast(estimates) if estimates.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else estimates


def _distance() -> Column:
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(FEATURES)]
    return F.greatest(F.lit(0.0), sum((F.col(f"c{i}{j}") * d[i] * d[j] * (1 if i == j else 2) for i, j in _PAIRS), F.lit(0.0)))


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """rows once for each estimate of their group, with d2, the squared Mahalanobis distance under it."""
    return rows.join(_small(estimate), "g").select("g", "start", *FEATURES, _distance().alias("d2"))


def _starts(rows: DataFrame) -> DataFrame:
    quart = rows.groupBy("g").agg(*[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, x in enumerate(FEATURES)])
    sd = lambda i: F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i]))
    centre = staged(quart.select("g", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(len(FEATURES))], *[sd(i).alias(f"s{i}") for i in range(len(FEATURES))]), "mcd-centres")
    spreads = centre.select("g", F.lit(0).alias("start"), *_MEANS, *[(F.pow(f"s{i}", F.lit(2)) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    whole = _moments(rows, "g").select("g", F.lit(1).alias("start"), *_MEANS, *_COVS)
    squashed = rows.join(_small(centre), "g").select("g", *[F.tanh((F.col(x) - F.col(f"m{i}")) / F.col(f"s{i}")).alias(x) for i, x in enumerate(FEATURES)])
    scaled = _moments(squashed, "g").select("g", *_COVS).join(centre, "g")
    scaled = scaled.select("g", F.lit(2).alias("start"), *_MEANS, *[(F.col(f"c{i}{j}") * F.col(f"s{i}") * F.col(f"s{j}")).alias(f"c{i}{j}") for i, j in _PAIRS])
    return spreads.unionByName(whole).unionByName(scaled)


def _inverted(estimate: DataFrame, name: str) -> DataFrame:
    estimate = estimate.withColumn("det", F.lit(0.0)).select("g", "start", *_MEANS, *_COVS, "det")
    return staged(estimate.mapInPandas(_inverses, estimate.schema), name)


def _concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    near = _distances(rows, estimate)
    cut = near.groupBy("g", "start").agg(F.percentile_approx("d2", CENTRAL, 1000).alias("cut"))
    central = near.join(_small(staged(cut, "mcd-cuts")), ["g", "start"]).where(F.col("d2") <= F.col("cut"))
    return _inverted(_moments(central, "g", "start"), "mcd-step")


def robust_estimates(rows: DataFrame, steps: int = STEPS, more: int = MORE_STEPS) -> DataFrame:
    """(g, m_i, inverse c_ij, det, scale) of the rows (g, x_i): the minimum-covariance-determinant estimate of each g.

    det is the logarithm of the determinant of the central rows' covariance, floors included; scale brings the median
    distance to that of a normal sample. Quantiles are approximate to a thousandth. Of equal determinants the first
    start's stays. No rows give no estimates.
    """
    estimate = _inverted(_starts(rows), "mcd-starts")
    for _ in range(steps):
        estimate = _concentrated(rows, estimate)
    best = estimate.groupBy("g").agg(F.min(F.struct("det", "start"))["start"].alias("start"))
    estimate = staged(estimate.join(best, ["g", "start"]), "mcd-best").select(estimate.columns)
    for _ in range(more):
        after = _concentrated(rows, estimate)
        both = estimate.alias("e").join(after.alias("a"), "g")
        fall = both.agg(F.max(F.col("e.det") - F.col("a.det"))).first()[0]
        # a group whose determinant does not fall has arrived
        keep = [F.when(F.col("a.det") < F.col("e.det"), F.col(f"a.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in estimate.columns if c != "g"]
        estimate = staged(both.select("g", *keep), "mcd-better")
        if fall is None or fall <= FALL:
            break
    scale = _distances(rows, estimate).groupBy("g").agg(F.greatest(F.percentile_approx("d2", 0.5, 1000) / MEDIAN, F.lit(1.0)).alias("scale"))
    return staged(estimate.join(scale, "g"), "mcd")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cut: float = CUT) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept for every document, with distance (null where base_failed).

    A null text has no words; null languages and sources are groups like others; repeated rows and null ids are rows of
    their own, and count as often in the estimates; rows at the same distance share one verdict; texts of any length are
    read whole; other columns are not read; an empty table gives an empty result.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    stats = staged(read.mapInArrow(_statistics, f"doc_id {kind}, lang string, source string, {STATS}"), "quality-stats")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stats.withColumn("base_failed", failed).select("*", *_vector())
    good = rows.where(~F.col("base_failed"))
    # The estimate that a (language, source) takes: its own, its language's or that of all rows.
    name = lambda *c: F.to_json(F.struct(*[F.col(x) for x in c]), {"ignoreNullFields": "false"})
    sizes = good.groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("in_lang", F.sum("n").over(W.partitionBy("lang")))
    own = F.when(F.col("n") >= FEWEST, name("lang", "source")).when(F.col("in_lang") >= FEWEST, name("lang")).otherwise(F.lit("all"))
    groups = staged(sizes.select("lang", "source", own.alias("g")), "quality-groups")
    wanted = groups.select("g").distinct()
    levels = good.select(F.explode(F.array(name("lang", "source"), name("lang"), F.lit("all"))).alias("g"), *FEATURES)
    estimates = robust_estimates(levels.join(_small(wanted), "g", "left_semi"))
    r = rows.alias("r")
    placed = r.join(_small(groups).alias("g"), F.col("r.lang").eqNullSafe(F.col("g.lang")) & F.col("r.source").eqNullSafe(F.col("g.source")), "left")
    placed = placed.select("r.*", F.col("g.g").alias("g"))
    far = F.when(~F.col("base_failed"), _distance() / F.col("scale"))
    return placed.join(_small(estimates), "g", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce(far, F.lit(0.0)) <= cut)).alias("kept"), far.alias("distance"),
    )
