"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it learns from, with an estimate of the share
of positives in that text. The model adds up one weight for each feature's quantile bin (an
additive model over text statistics, language independent) and minimises the non-negative
unbiased risk  pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])  with the logistic loss; where
the second term falls below zero, the step goes the other way on it.

Fitting reads about ``FIT_ROWS`` positives and as many unlabelled rows (or all, when there are
fewer); only their statistics come to the driver. Scoring is one pass over every whole text
without a shuffle. Null texts count as empty and get a score like any other; null ids, ties and
repeated rows are kept. Without positives, or without text, every score is the prior."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.common import bounded_rows, bounded_sample, ship_package

FIT_ROWS = 20_000
BINS = 16
NAMES = (
    "log_words", "word_bytes", "distinct", "same_next", "repeat8", "words_a_line",
    "upper", "digits", "marks", "symbols", "stops", "spaces", "wide",
)
_CLASSES = {
    "upper": [*range(65, 91)], "digits": [*range(48, 58)], "marks": [33, 63], "symbols": [*b"#*$%&|<>~^=_{}[]@\\/"],
    "stops": [*b".,;:"], "spaces": [32, 9, 10, 11, 12, 13], "wide": [*range(128, 256)], "lines": [10],
}
_LUT = np.zeros(256, np.uint8)
for _k, _v in enumerate(_CLASSES.values()):
    _LUT[_v] |= np.uint8(1 << _k)


def _repeats(doc: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """Distinct values of ``h`` in each text (by 40 bits of the hash)."""
    key = (doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
    key.sort()
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=size)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of statistics (``NAMES``) for each text."""
    size = len(off) - 1
    w = textkit.Words(data, off)
    doc = w.doc()
    n_words = np.diff(w.off)
    n_bytes = np.maximum(np.diff(off), 1)
    code = _LUT[data]
    count = {}
    for k, name in enumerate(_CLASSES):
        sums = np.concatenate([[0], np.cumsum((code >> k) & 1, dtype=np.int64)])
        count[name] = sums[off[1:]] - sums[off[:-1]]
    some = np.maximum(n_words, 1)
    same = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, bool)
    at, win = w.windows(8)
    n_win = np.bincount(doc[at], minlength=size) if len(at) else np.zeros(size)
    out = {
        "log_words": np.log1p(n_words),
        "word_bytes": np.bincount(doc, weights=w.end - w.start, minlength=size) / some,
        "distinct": _repeats(doc, w.hash, size) / some,
        "same_next": np.bincount(doc[1:][same], minlength=size) / some if len(doc) else np.zeros(size),
        "repeat8": 1 - _repeats(doc[at], win, size) / np.maximum(n_win, 1) * (n_win > 0) - (n_win == 0),
        "words_a_line": n_words / (count["lines"] + 1),
    }
    out |= {k: count[k] / n_bytes for k in ("upper", "digits", "marks", "symbols", "stops", "spaces", "wide")}
    return np.stack([np.asarray(out[k], float) for k in NAMES], 1) if size else np.zeros((0, len(NAMES)))


class Model:
    def __init__(self, cuts: list[np.ndarray], weight: np.ndarray, bias: float):
        self.cuts, self.weight, self.bias = cuts, weight, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Index of every feature's bin in the weight vector."""
        return np.stack([np.searchsorted(c, x[:, k], "right") + k * (BINS + 1) for k, c in enumerate(self.cuts)], 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.weight[self.bins(x)].sum(1) + self.bias if len(x) else np.zeros(0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Full-batch Adam on the non-negative risk."""
    prior = float(np.clip(prior, 0.01, 0.99))
    if not len(positive) or not len(unlabelled):
        return Model([np.zeros(0)] * len(NAMES), np.zeros(len(NAMES) * (BINS + 1)), float(np.log(prior / (1 - prior))))
    # Cuts from the two ends as well, where junk text lies.
    q = np.unique(np.concatenate([np.linspace(0, 1, BINS - 5)[1:-1], [0.005, 0.02, 0.05, 0.95, 0.98, 0.995]]))
    cuts = [np.unique(np.quantile(unlabelled[:, k], q))[:BINS] for k in range(len(NAMES))]
    model = Model(cuts, np.zeros(len(NAMES) * (BINS + 1)), 0.0)
    p, u = model.bins(positive), model.bins(unlabelled)
    size = len(model.weight)
    theta = np.append(model.weight, np.log(prior / (1 - prior)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def spread_back(b: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Gradient over the weights and the bias from that over the rows' outputs."""
        return np.append(np.bincount(b.ravel(), weights=np.repeat(g, b.shape[1]), minlength=size), g.sum())

    for t in range(1, steps + 1):
        fp, fu = theta[:size][p].sum(1) + theta[size], theta[:size][u].sum(1) + theta[size]
        good = spread_back(p, -prior * sig(-fp) / len(p))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        bad = spread_back(u, sig(fu) / len(u)) - spread_back(p, prior * sig(fp) / len(p))
        grad = (good + bad if negative >= 0 else -bad) + decay * np.append(theta[:size], 0) / 10
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model = Model(cuts, theta[:size], float(theta[size]))
    model.bias -= _cut(model.logit(unlabelled), prior)
    return model


def _cut(f: np.ndarray, prior: float, slack: float = 0.02) -> float:
    """Where the unlabelled outputs part into the estimated shares: the middle of the widest gap
    within ``slack`` of the prior's quantile, which becomes score 0.5."""
    f = np.sort(f)
    at = int((1 - prior) * len(f))
    lo, hi = max(0, at - int(slack * len(f)) - 1), min(len(f) - 1, at + int(slack * len(f)) + 1)
    k = lo + int(np.diff(f[lo : hi + 1]).argmax()) if hi > lo else lo
    return float((f[k] + f[min(k + 1, len(f) - 1)]) / 2)


def _statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch):
                x = features(*textkit.text_buffer(part.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64()))], ["x"])

    return docs.select("text").mapInArrow(run, "x array<double>")


def _rows(docs: DataFrame) -> np.ndarray:
    x = np.array([r["x"] for r in _statistics(docs).collect()], float).reshape(-1, len(NAMES))
    return x[np.lexsort(x.T)]


def class_prior(labels: DataFrame) -> float:
    """The share of trusted positives among the judged rows: the estimate of their share in the
    web text the judged rows were drawn from. 0.5 without judged rows."""
    r = labels.agg(F.avg(F.col("quality").cast("double")).alias("p")).first()
    return 0.5 if r["p"] is None else float(r["p"])


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """``documents`` (doc_id, text) as unlabelled text; ``labels`` (doc_id, quality) for the
    positives and the prior. The chosen positive ids (at most about ``fit_rows``) are broadcast;
    of rows, too, at most about ``fit_rows`` a side are taken, whatever ids are null or repeated."""
    ship_package(documents.sparkSession)
    labels = labels.select(F.col("doc_id").alias("__id"), "quality").dropna()
    good = bounded_sample(labels.where("quality = 1").select("__id").distinct(), fit_rows, "__id")
    positive = documents.select("doc_id", "text").join(F.broadcast(good), F.col("doc_id") == F.col("__id"), "left_semi")
    positive = bounded_rows(positive, fit_rows, "doc_id", "text")
    web = bounded_rows(documents.select("doc_id", "text"), fit_rows, "doc_id", "text")
    return train(_rows(positive), _rows(web), class_prior(labels))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` (text may be one) with quality_score (0 to 1) after them."""
    ship_package(docs.sparkSession)
    keep = tuple(c for c in keep if c != "quality_score")
    source = docs.select(*keep, *([] if "text" in keep else ["text"])).withColumnRenamed("text", "__t")
    given = ["__t" if c == "text" else c for c in keep]
    schema = docs.select(*keep).schema.add("quality_score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "__t"):
                s = model.score(features(*textkit.text_buffer(part.column("__t"))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in given), pa.array(s)], [*keep, "quality_score"])

    return source.mapInArrow(run, schema)
