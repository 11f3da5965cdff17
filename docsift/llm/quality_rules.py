"""Quality rules: plain limits, then robust multivariate outliers per language and source.

One pass over the texts leaves a narrow table of statistics. Rows that pass the limits
become vectors of ``FEATURES`` transformed statistics, on a fine grid of whole numbers.
The rows of one language and source are a *group*; groups of fewer than ``LEAST`` such
rows share one per language, and languages whose shared group is still too small share
one over all.

Each group gets minimum-covariance-determinant estimates, over all of its rows:

* centre and scale: median and median deviation of each feature, from histograms;
* three starts: these, the mean and covariance, and those of the vectors cut to
  ``CUT`` scales;
* concentration: with the distances under an estimate, the rows at the smallest
  distances, ``SHARE`` of the group at least, give the next estimate, until the
  determinant falls no more. The start that ends at the least determinant wins.

The covariance is kept regular by ``RIDGE`` parts of a unit matrix, in robust scales
(many statistics are zero in most texts). A distance is measured so that the median row
of the group lies where the chi-square distribution has its median, and a row beyond the
quantile ``1 - tail`` is rejected.

A step is one pass over the narrow table: rows are counted and summed by group, start and
distance bucket (1/``FINE`` wide, ``BUCKETS`` at most), so each task sends at most that
many rows a group, whatever the size of the group. All sums are of whole numbers, so
they do not depend on how the rows are dealt to tasks. The driver sees how many starts
still go on, and nothing else.

Defined cases: null text has no words and fails the limits; null language or source is a
value of its own; a null doc_id and repeated rows are rows like any other; other columns
are never read; where all rows together are too few, the limits alone decide; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.hashing import text_slices
from docsift.llm.words import small, utf8
from docsift.session import materialize

SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
LEAST_WORDS = 50
BLOCK = 1 << 20              # bytes of a text split at a time
STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"

GRID = 1024                  # steps to a unit of a transformed statistic
#: least scale of each feature, in units; the ridge makes a deviation of it times sqrt(RIDGE) the least one
LEAST_SCALES = (1.0, 0.15, 0.25, 0.45, 1.5)
FEATURES = len(LEAST_SCALES)
LEAST = 100                  # rows of a group
SHARE = 0.75
CUT = 1.5
RIDGE = 0.05
FINE, BUCKETS = 64, 8192
TAIL = 1e-15                 # statistics of texts have longer tails than the normal distribution
STARTS = ("median", "mean", "cut")
_PAIRS = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
_U = [f"u{i}" for i in range(FEATURES)]


# ---- statistics of texts ----------------------------------------------------------------------------------

def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``BLOCK`` bytes of it at a time."""
    start = 0
    while start < len(text):
        end = min(start + BLOCK, len(text))
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[start:end].split()
        start = end


def _packed(a: np.ndarray, b: np.ndarray, n_b: int) -> np.ndarray:
    """One number for each pair; ``a`` is renumbered where the product would not fit."""
    if len(a) and int(a.max()) >= (1 << 62) // n_b:
        a = np.unique(a, return_inverse=True)[1]
    return a * n_b + b


def repeated_words(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text, how many of its words lie in a window of three that the text holds twice or more.

    ``words``: numbers of the words of all texts, one after another; ``ends``: where each text ends in it.
    """
    n, at = int(words.max()) + 1 if len(words) else 1, np.arange(max(len(words) - 2, 0))
    text = np.searchsorted(ends, at, "right")
    at = at[whole := at + 2 < ends[text]] if len(at) else at
    text = text[whole] if len(text) else text
    key = _packed(_packed(_packed(words[at], words[at + 1], n), words[at + 2], n), text, len(ends) + 1)
    _, number, counts = np.unique(key, return_inverse=True, return_counts=True)
    again, inside = at[counts[number] > 1], np.zeros(len(words), np.int64)
    for k in range(3):
        inside[again + k] = 1
    return np.diff(np.concatenate([[0], np.cumsum(inside)])[ends], prepend=0)


def _repeated_lines(text: bytes) -> int:
    seen, n = set(), 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                n += 1
            elif line and not line.isspace():
                seen.add(line)
    return n


def _statistics(texts: list[bytes]) -> list[np.ndarray]:
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    words, sizes = [], []
    for text in texts:
        sizes.append(0)
        for part in _words(text):
            words.append(np.fromiter(map(number.__getitem__, part), np.int64, len(part)))
            sizes[-1] += len(part)
    ends = np.cumsum(sizes, dtype=np.int64)
    repeats = repeated_words(np.concatenate(words) if words else np.zeros(0, np.int64), ends)
    chars = [np.count_nonzero(np.frombuffer(t.translate(None, SPACES), np.uint8) & 0xC0 != 0x80) for t in texts]
    symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
    return [np.array(x, np.int64) for x in (sizes, chars, symbols, list(map(_repeated_lines, texts)), repeats)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and ``STATISTICS`` for every row of ``docs(doc_id, text, lang, source)``."""
    names = [c.split()[0] for c in STATISTICS.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at = 0
            for texts in text_slices(utf8(batch["text"]), BLOCK):
                rows = slice(at, at + len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c][rows] for c in ("doc_id", "lang", "source")), *map(pa.array, _statistics(texts))],
                    ["doc_id", "lang", "source", *names])

    given = docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    return given.mapInArrow(count, "doc_id bigint, lang string, source string, " + STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed() -> list[Column]:
    """Size and word length as logarithms, shares as angles, repeated lines as a logarithm; in steps of the grid."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    units = [F.log(words), F.log(chars / words), F.asin(F.sqrt(F.col("n_symbols") / chars)),
             F.asin(F.sqrt(F.col("n_repeat_words") / words)), F.log(F.col("n_dup_lines") + F.lit(1))]
    return [F.floor(u * GRID + 0.5) for u in units]


# ---- groups -----------------------------------------------------------------------------------------------

def _groups(passed: DataFrame) -> DataFrame:
    """g_lang, g_source, group: the group that each language and source belongs to; null where all are too few."""
    counts = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    few = F.col("n") < LEAST
    counts = materialize(counts.withColumn("n_few", F.sum(F.when(few, F.col("n"))).over(Window.partitionBy("lang"))), "counts")
    rest = few & (F.col("n_few") < LEAST)
    enough = (counts.filter(rest).agg(F.sum("n")).first()[0] or 0) >= LEAST
    return counts.select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
        F.when(~few, F.concat(F.lit("s"), F.to_json(F.struct("lang", "source"))))
        .when(~rest, F.concat(F.lit("l"), F.to_json(F.struct("lang"))))
        .when(F.lit(enough), F.lit("a")).alias("group"))


def _median(counts: DataFrame, value: str, name: str) -> DataFrame:
    """group, feature, ``name``: the lower median of ``value`` by its counts ``n``."""
    w = Window.partitionBy("group", "feature")
    below = F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return (counts.withColumns({"below": below, "all": F.sum("n").over(w)})
            .filter(F.col("below") * 2 >= F.col("all")).groupBy("group", "feature").agg(F.min(value).alias(name)))


def _centres(vectors: DataFrame) -> DataFrame:
    """group, centre (steps), scale (steps): arrays over the features."""
    cells = vectors.select("group", F.posexplode(F.array(*[f"q{i}" for i in range(FEATURES)])).alias("feature", "q"))
    counts = materialize(cells.groupBy("group", "feature", "q").agg(F.count("*").alias("n")), "histograms")
    centres = _median(counts, "q", "centre")
    away = (counts.join(centres, ["group", "feature"])
            .groupBy("group", "feature", F.abs(F.col("q") - F.col("centre")).alias("away")).agg(F.sum("n").alias("n")))
    both = centres.join(_median(away, "away", "deviation"), ["group", "feature"])
    least = F.element_at(F.array(*[F.lit(s * GRID) for s in LEAST_SCALES]), F.col("feature") + 1)
    sides = F.array_sort(F.collect_list(F.struct(
        "feature", "centre", F.greatest(F.col("deviation") * 1.4826, least).alias("scale"))))      # FEATURES entries
    return both.groupBy("group").agg(sides.alias("s")).select(
        "group", F.col("s.centre").alias("centre"), F.col("s.scale").alias("scale"))


# ---- estimates --------------------------------------------------------------------------------------------

def regular(n: float, sums: np.ndarray, products: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, inverse covariance with the ridge, and logarithm of its determinant, in robust scales."""
    mean = sums / n
    square = np.zeros((FEATURES, FEATURES))
    for (i, j), p in zip(_PAIRS, products):
        square[i, j] = square[j, i] = (p / n - mean[i] * mean[j]) / (scale[i] * scale[j])
    return _regular(mean / scale, square)


def _regular(mean: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    square = (1 - RIDGE) * square + RIDGE * np.eye(FEATURES)
    inverse = np.linalg.inv(square)
    return mean, (inverse + inverse.T) / 2, float(np.linalg.slogdet(square)[1])


ESTIMATE = "group string, start string, scale array<double>, mean array<double>, inverse array<double>, log_det double"


def _estimate(group: str, start: str, scale: np.ndarray, found: tuple) -> dict:
    mean, inverse, log_det = found
    return {"group": group, "start": start, "scale": scale.tolist(), "mean": mean.tolist(),
            "inverse": [float(inverse[i, j]) for i, j in _PAIRS], "log_det": log_det}


def _sums(columns: list[str], name: str) -> list[Column]:
    return ([F.sum(c).alias(f"{name}_s{i}") for i, c in enumerate(columns)]
            + [F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"{name}_p{i}{j}") for i, j in _PAIRS])


def _sum_names(name: str) -> tuple[list[str], list[str]]:
    return [f"{name}_s{i}" for i in range(FEATURES)], [f"{name}_p{i}{j}" for i, j in _PAIRS]


def _starts(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """``ESTIMATE``: the three first estimates of each group."""
    limit = [F.floor(F.get("scale", F.lit(i)) * CUT) for i in range(FEATURES)]
    cut = [F.greatest(F.least(F.col(u), k), -k).alias(f"c{u}") for u, k in zip(_U, limit)]
    rows = vectors.join(centres.select("group", "scale"), "group").select("group", *_U, *cut)
    sums = rows.groupBy("group").agg(F.count("*").alias("n"), *_sums(_U, "u"), *_sums([f"c{u}" for u in _U], "c"))

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                scale = np.array(row["scale"], float)
                out.append(_estimate(row["group"], "median", scale, _regular(np.zeros(FEATURES), np.eye(FEATURES))))
                for start, name in (("mean", "u"), ("cut", "c")):
                    s, p = (np.array([row[c] for c in cols], float) for cols in _sum_names(name))
                    out.append(_estimate(row["group"], start, scale, regular(row["n"], s, p, scale)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ESTIMATE.split(", ")])

    return sums.join(centres.select("group", "scale"), "group").mapInPandas(first, ESTIMATE)


def distance() -> Column:
    """Squared Mahalanobis distance of a row's ``_U`` from the estimate beside it."""
    z = [F.col(u) / F.get("scale", F.lit(i)) - F.get("mean", F.lit(i)) for i, u in enumerate(_U)]
    terms = [F.get("inverse", F.lit(k)) * z[i] * z[j] * (1.0 if i == j else 2.0) for k, (i, j) in enumerate(_PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def _bucket() -> Column:
    return F.least(F.floor(F.sqrt(distance()) * FINE), F.lit(BUCKETS - 1)).cast("int")


def _concentrated(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """The next estimates: of each group and start, from the rows at the smallest distances."""
    cells = vectors.join(estimates, "group").withColumn("bucket", _bucket()).groupBy("group", "start", "bucket").agg(
        F.count("*").alias("n"), F.first("scale").alias("scale"), *_sums(_U, "u"))

    def step(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("bucket")
        until = cells["n"].cumsum().to_numpy()
        inner = cells.iloc[:int(np.searchsorted(until, math.ceil(SHARE * int(until[-1])))) + 1]
        s, p = (np.array([sum(map(int, inner[c])) for c in cols], float) for cols in _sum_names("u"))
        scale = np.array(cells["scale"].iloc[0], float)
        found = regular(float(inner["n"].sum()), s, p, scale)
        return pd.DataFrame([_estimate(cells["group"].iloc[0], cells["start"].iloc[0], scale, found)])

    return cells.groupBy("group", "start").applyInPandas(step, ESTIMATE)


def above(x: float) -> float:
    """Chance that a sum of ``FEATURES`` (an odd number of) squared standard normal variables is above ``x``."""
    total = math.erfc(math.sqrt(x / 2))
    for k in range(1, FEATURES, 2):
        total += (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
    return total


def quantile(tail: float) -> float:
    """Where the distribution leaves ``tail`` above."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > tail else (low, middle)
    return high


def estimates(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """``ESTIMATE`` and ``unit``: each group's estimate of least determinant, and its median squared distance by chi-square's."""
    going = materialize(_starts(vectors, centres), "estimates")
    settled = None
    while not going.isEmpty():
        new = materialize(_concentrated(vectors, going), "estimates")
        old = going.select("group", "start", *[F.col(c).alias(f"old_{c}") for c in ("mean", "inverse", "log_det")])
        # a first estimate is not that of SHARE rows, so its determinant says nothing
        falls = F.col("log_det") < F.col("old_log_det") - 1e-6
        both = new.join(old, ["group", "start"]).withColumn("falls", falls if settled is not None else F.lit(True))
        names = [c.split()[0] for c in ESTIMATE.split(", ")]
        kept = [F.col(f"old_{c}").alias(c) if c in ("mean", "inverse", "log_det") else F.col(c) for c in names]
        ended = both.filter("NOT falls").select(*kept)
        settled = ended if settled is None else settled.unionByName(ended)
        going = materialize(both.filter("falls").select(*names), "estimates")
    settled = going if settled is None else settled              # no group at all: no estimates
    place = F.element_at(F.create_map(*[F.lit(x) for i, s in enumerate(STARTS) for x in (s, i)]), F.col("start"))
    order = F.struct("log_det", place)
    best = materialize(settled.groupBy("group").agg(F.min_by(F.struct("*"), order).alias("e")).select("e.*"), "best")
    counts = vectors.join(best, "group").groupBy("group", _bucket().alias("bucket")).agg(F.count("*").alias("n"))
    middle = _median(counts.withColumn("feature", F.lit(0)), "bucket", "bucket").select(
        "group", F.pow((F.col("bucket") + 0.5) / FINE, F.lit(2.0)).alias("middle"))
    unit = F.greatest(F.col("middle"), F.lit(RIDGE)) / quantile(0.5)
    return best.join(middle, "group").withColumn("unit", unit).drop("middle")


def _centred() -> list[Column]:
    return [(F.col(f"q{i}") - F.get("centre", F.lit(i))).alias(u) for i, u in enumerate(_U)]


# ---- the whole --------------------------------------------------------------------------------------------

def quality_rules(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """doc_id, ``STATISTICS``, base_failed, kept, and the squared distance (null without one) for every row of
    ``docs(doc_id, text, lang, source)``."""
    rows = materialize(statistics(docs), "statistics").withColumn("base_failed", base_failed())
    passed = rows.filter(~F.col("base_failed"))
    groups = materialize(_groups(passed), "groups")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    grid = [q.alias(f"q{i}") for i, q in enumerate(transformed())]
    vectors = materialize(passed.join(groups, same).filter(F.col("group").isNotNull())
                          .select("group", *grid), "vectors")
    centres = materialize(_centres(vectors), "centres")
    centred = materialize(vectors.join(centres, "group").select("group", *_centred()), "centred")
    found = estimates(centred, centres).join(centres.select("group", "centre"), "group")
    found = materialize(found.drop("start", "log_det"), "found")
    statistic = [c.split()[0] for c in STATISTICS.split(", ")]
    judged = rows.join(groups, same, "left").select(
        "doc_id", *statistic, "base_failed", F.when(~F.col("base_failed"), F.col("group")).alias("group"), *grid)
    measured = judged.join(found, "group", "left").select("*", *_centred())
    far = F.when(F.col("unit").isNotNull(), distance() / F.col("unit"))
    return measured.withColumn("distance", far).select(
        "doc_id", *statistic, "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= quantile(tail), F.lit(True))).alias("kept"), "distance")
