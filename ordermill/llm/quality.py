"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector for all
grades and ordered thresholds.  x holds hashed words and their letter
four-grams (present or not) and binned shape features (capitals, symbols,
repetition) of the whole text.

Fitting uses a bounded, documented sample of labelled documents: at most
about ``FIT_DOCS``, chosen by hash of the id.  Features whose documents are
graded like the others are left out first (likelihood ratio test, and some
grade at least three times as frequent).  Rare grades weigh more in the fit, so
they are not given up for common ones.  Scoring is one streaming pass
over every document.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import id_text, staged

BUCKETS = 1 << 18
FIT_DOCS = 12_000
LEAST_DOCS, LEAST_G, LEAST_LIFT = 5, 30.0, 3.0
STEPS, RATE, RIDGE = 1000, 0.05, 3e-5
KEEP_SHARE, TAIL_RANGE = 0.995, (0.5, 0.9)
WORD = re.compile(r"[^\W\d_]+")
BINS = np.array([0.0005, 0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])
CACHE_WORDS, CACHE_CHARS = 400_000, 200


def bucket(name: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(name) % BUCKETS


def shape(text: str) -> list[str]:
    """Names of the binned shape features of a text."""
    words = text.split()
    n = len(words)
    if not n:
        return ["shape:empty"]
    counts = Counter(words)
    shares = {
        "same": sum(a == b for a, b in zip(words, words[1:])) / n,
        "caps": sum(w.isupper() and len(w) > 1 for w in words) / n,
        "tail": sum(not w[-1].isalnum() and w[-1] not in ".,;:!?)\"'" for w in words) / n,
        "shout": sum(w.endswith("!!") for w in words) / n,
        "lone": sum(len(w) == 1 and not w.isalnum() for w in words) / n,
        "digit": sum(c.isdigit() for w in counts for c in w[:1]) / len(counts),
        "most": (max(counts.values()) / n) if n >= 30 else 0.0,
        "again": 1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2) if n > 2 else 0.0,
    }
    return [f"shape:{k}:{int(np.searchsorted(BINS, v, side='right'))}" for k, v in shares.items()]


def word_names(word: str) -> list[str]:
    """A word and its four-grams, its start marked."""
    marked = "^" + word
    return [word, *(f"4:{marked[i:i + 4]}" for i in range(max(1, len(marked) - 3)))]


class Features(dict):
    """Buckets of each word (only ``wanted`` ones, if given), remembered up to a bound;
    words longer than ``CACHE_CHARS`` are not."""

    def __init__(self, wanted=None):
        super().__init__()
        self.wanted = wanted

    def choose(self, names) -> tuple[int, ...]:
        codes = (bucket(n) for n in names)
        return tuple(codes) if self.wanted is None else tuple(c for c in codes if c in self.wanted)

    def long(self, word) -> set[int]:
        """Buckets of ``word_names(word)``, in slices that overlap by three letters."""
        marked, found = "^" + word, set(self.choose([word]))
        for lo in range(0, len(marked) - 3, CACHE_CHARS):
            part = marked[lo: lo + CACHE_CHARS + 3]
            found.update(self.choose({f"4:{part[i:i + 4]}" for i in range(len(part) - 3)}))
        return found

    def __missing__(self, word):
        if len(word) > CACHE_CHARS:
            return self.long(word)
        codes = self.choose(word_names(word))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = codes
        return codes

    def of(self, text: str) -> set[int]:
        words = set(WORD.findall(text.lower()))
        return set().union(*map(self.__getitem__, words), self.choose(shape(text)))


class Model:
    """Weights of the chosen buckets, ordered thresholds, and the tail probability
    from which a document is kept."""

    def __init__(self, weights: dict[int, float], thresholds: list[float], keep_tail: float = 0.5):
        self.weights, self.thresholds, self.keep_tail = weights, thresholds, keep_tail

    def judge(self, buckets) -> tuple[float, float]:
        """(expected grade, probability of the top grade)."""
        if not self.thresholds:
            return 0.0, 1.0
        get = self.weights.get
        eta = sum(get(b, 0.0) for b in sorted(buckets))
        above = [1 / (1 + np.exp(np.clip(t - eta, -60, 60))) for t in self.thresholds]
        return float(sum(above)), float(above[-1])


def choose(buckets: np.ndarray, grades: np.ndarray, docs: np.ndarray, of_grade: np.ndarray) -> np.ndarray:
    """Buckets that tell grades apart, from ``docs``: how many documents of a
    grade have a bucket; ``of_grade``: documents of each grade (0 .. n - 1)."""
    levels, n = len(of_grade), of_grade.sum()
    seen = np.zeros((levels, BUCKETS))
    np.add.at(seen, (grades, buckets), docs)
    df = seen.sum(axis=0)
    share = of_grade / n
    ratio = np.zeros(BUCKETS)                   # likelihood ratio of "grades depend on the feature"
    for k in range(levels):
        for count, size in ((seen[k], df), (of_grade[k] - seen[k], n - df)):
            ratio += 2 * count * np.log(np.maximum(count, 1) / np.maximum(size * share[k], 1e-9))
    lift = (seen / np.maximum(df, 1) / share[:, None]).max(axis=0)
    return np.flatnonzero((df >= LEAST_DOCS) & (df < n) & (ratio >= LEAST_G) & (lift >= LEAST_LIFT))


def train(y: np.ndarray, docs: list[np.ndarray], chosen: np.ndarray) -> Model:
    """Cumulative-link fit by Adam; ``y`` 0 .. n - 1, documents as rows of chosen buckets."""
    kinds = np.unique(y)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    col = np.searchsorted(chosen, np.concatenate(docs))
    levels = len(kinds) - 1
    below = np.array([(y <= k).mean() for k in range(levels)])
    cut = np.log(below / (1 - below))
    # thresholds as a first value and log gaps, so they stay ordered
    theta = np.r_[cut[0], np.log(np.maximum(np.diff(cut), 1e-3)), np.zeros(len(chosen))]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(len(y))
    weight = (1 / np.bincount(y)[y]) ** 0.75
    weight = weight / weight.mean()
    for step in range(1, STEPS + 1):
        cut = np.cumsum(np.r_[theta[0], np.exp(theta[1:levels])])
        w = theta[levels:]
        eta = np.bincount(row, weights=w[col], minlength=len(y))
        cdf = np.c_[np.zeros(len(y)), 1 / (1 + np.exp(np.clip(eta[:, None] - cut, -60, 60))), np.ones(len(y))]
        p = np.maximum(cdf[rows, y + 1] - cdf[rows, y], 1e-12)
        slope = cdf * (1 - cdf)
        up, low = weight * slope[rows, y + 1] / p, weight * slope[rows, y] / p
        g_eta = up - low                                        # of the negative log likelihood
        g_cut = np.zeros(levels)
        np.add.at(g_cut, y[y < levels], -up[y < levels])
        np.add.at(g_cut, y[y > 0] - 1, low[y > 0])
        g_theta = np.cumsum(g_cut[::-1])[::-1].copy()
        g_theta[1:] *= np.exp(theta[1:levels])
        grad = np.r_[g_theta, np.bincount(col, weights=g_eta[row], minlength=len(chosen))] / len(y)
        grad[levels:] += RIDGE * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cut = np.cumsum(np.r_[theta[0], np.exp(theta[1:levels])])
    # selection: KEEP_SHARE of the top-graded documents of the sample pass, within a range (whose
    # low end gives way where weak features leave the typical top-graded document below it)
    eta = np.bincount(row, weights=theta[levels:][col], minlength=len(y))
    tail = 1 / (1 + np.exp(np.clip(cut[-1] - eta[y == levels], -60, 60)))
    low, high = min(TAIL_RANGE[0], float(np.median(tail))), TAIL_RANGE[1]
    keep_tail = float(np.clip(np.quantile(tail, 1 - KEEP_SHARE), low, high))
    return Model({int(b): round(float(x), 6) for b, x in zip(chosen, theta[levels:])},
                 [round(float(c), 6) for c in cut],
                 round(keep_tail - 0.002, 4))      # equal documents share a tail: stay below it


def passage(text: str) -> str:
    """The five-word passage of a text with the smallest hash: near copies mostly share it."""
    import xxhash
    w = text.split()
    return min((" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))), key=xxhash.xxh64_intdigest)


def _sample(batches):
    names = Features()
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            texts = part.column("text").to_pylist()
            found = [np.array(sorted(names.of(t)), "<i4").tobytes() for t in texts]
            yield pa.record_batch([part.column("grade"), pa.array(map(passage, texts), pa.string()),
                                   pa.array(found, pa.binary())], names=["grade", "passage", "buckets"])


def _counts(batches):
    for b in batches:
        flat = [np.frombuffer(x, "<i4") for x in b.column("buckets").to_pylist()]
        grade = np.repeat(b.column("grade").to_numpy(), [len(x) for x in flat]).astype(np.int64)
        key, n = np.unique(grade * BUCKETS + np.concatenate(flat), return_counts=True) if flat else (np.zeros(0, int),) * 2
        yield pa.record_batch([pa.array(key // BUCKETS, pa.int32()), pa.array(key % BUCKETS, pa.int32()),
                               pa.array(n, pa.int64())], names=["grade", "bucket", "n"])


def _only(chosen):
    def run(batches):
        for b in batches:
            rows = [np.intersect1d(np.frombuffer(x, "<i4"), chosen).astype("<i4").tobytes()
                    for x in b.column("buckets").to_pylist()]
            yield pa.record_batch([b.column("grade"), pa.array(rows, pa.binary())], names=["grade", "buckets"])
    return run


def fit(docs: DataFrame, ratings: DataFrame, id_col="doc_id", text_col="text", fit_docs: int = FIT_DOCS) -> Model:
    """Model from ``ratings(doc_id, grade)``; several ratings of a document count as their lowest."""
    r = (ratings.where("doc_id is not null and grade is not null")
         .groupBy(F.col("doc_id").cast("long").alias("rated")).agg(F.min("grade").cast("int").alias("grade")))
    share = min(1.0, fit_docs / max(r.count(), 1))
    r = r.where(F.pmod(F.xxhash64("rated", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    d = id_text(docs, id_col, text_col)
    # the sample has about ``fit_docs`` rows of two numbers
    sample = (d.join(F.broadcast(r), d.doc_id == r.rated).select("grade", "text")
              .mapInArrow(_sample, "grade int, passage string, buckets binary"))
    # copies are no independent evidence: of equal passages one document counts, of the lowest grade
    first = F.row_number().over(Window.partitionBy("passage").orderBy("grade", "buckets"))
    sample = staged(sample.withColumn("_n", first).where("_n = 1").select("grade", "buckets"), "ratings")
    # counts per bucket and grade, then the few chosen buckets of each document
    counts = sample.mapInArrow(_counts, "grade int, bucket int, n long").groupBy("grade", "bucket").agg(F.sum("n").alias("n"))
    counts = counts.toArrow()
    totals = sorted((g["grade"], g["n"]) for g in sample.groupBy("grade").agg(F.count("*").alias("n")).collect())
    kinds = np.array([g for g, _ in totals])
    if len(kinds) < 2:
        return Model({}, [])                    # nothing to tell apart: everything is kept
    chosen = choose(counts.column("bucket").to_numpy(), np.searchsorted(kinds, counts.column("grade").to_numpy()),
                    counts.column("n").to_numpy(), np.array([n for _, n in totals]))
    rows = sample.mapInArrow(_only(chosen), "grade int, buckets binary").toArrow().sort_by(
        [("grade", "ascending"), ("buckets", "ascending")])
    return train(np.searchsorted(kinds, rows.column("grade").to_numpy()),
                 [np.frombuffer(x, "<i4") for x in rows.column("buckets").to_pylist()], chosen)


def _score(model, names):
    weights = model.weights
    schema_tail = ["expected_grade", "tail_probability", "keep"]

    def run(batches):
        feats = Features(weights.keys())
        for b in batches:
            got = [model.judge(feats.of(t)) for t in b.column(names[0]).to_pylist()]
            cols = [b.column(i) for i in range(1, b.num_columns)]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array([round(g, 6) for g, _ in got], pa.float64()),
                        pa.array([round(p, 6) for _, p in got], pa.float64()),
                        pa.array([p >= model.keep_tail for _, p in got], pa.bool_())],
                names=list(names[1:]) + schema_tail)
    return run


def rate(docs: DataFrame, ratings: DataFrame, id_col="doc_id", text_col="text", extra: tuple = (),
         fit_docs: int = FIT_DOCS) -> DataFrame:
    """``id_col`` and ``extra`` columns of every document with expected_grade (0 is
    the lowest), tail_probability (top grade) and keep (tail at least the model's
    ``keep_tail``).

    Null text is rated as empty text.  Ratings of one grade only, or none,
    tell nothing apart: every document is kept, with tail 1."""
    model = fit(docs, ratings, id_col, text_col, fit_docs)
    cols = [id_col, *extra]
    d = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text_"), *cols)
    kept = ", ".join(f"`{c}` {t}" for c, t in d.select(*cols).dtypes)
    return d.mapInArrow(_score(model, ["_text_", *cols]),
                        kept + ", expected_grade double, tail_probability double, keep boolean")


def grades(labels: DataFrame) -> DataFrame:
    """Ratings from quality and toxic marks: 0 low quality, 1 toxic, 2 neither."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))
