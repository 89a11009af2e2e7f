"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1; the unlabelled set is all documents of the training
folds, whatever their labels. With class prior pi, an additive model (binned features, logistic
loss l) minimises the non-negative unbiased risk

    pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)])

where a negative estimate of the second term reverses the step, as in non-negative PU learning. The
prior is the share of label 1 among the labelled training rows. Inputs are taken from the text alone.

Positives and unlabelled rows are samples of about MOST rows each, by hash of doc_id; scores and
everything else cover all rows.

Defined cases: null and empty texts have all features 0 and get a score like any other; rows
without doc_id are held out; labels that are null or repeated count once, by their smallest value;
without any positive every score is 0.5; repeated rows are scored alike, and so are ties of features;
an empty table gives no rows; other columns are ignored by ``scored`` and kept by ``accepted``,
whatever their names. ``features`` of a text without words are all 0.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_number, carried, cut, documents, unused

MOST, FOLDS, THRESHOLD = 10_000, 5, 0.3
BINS, STEPS, RATE, DECAY = 12, 1500, 0.1, 1e-5
TAILS = (0.0, 0.01, 0.99, 1.0)
FEATURES = ["length", "upper", "digit", "symbol", "bar", "shout", "distinct", "repeated", "word", "stop", "line", "other"]


def features(text: str | None) -> np.ndarray:
    """Twelve numbers of a text: its length, shares of kinds of bytes, and how its words repeat."""
    out = np.zeros(len(FEATURES))
    words = text.split() if text else []
    if not words:
        return out
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    n = np.bincount(raw, minlength=256)
    size, count = len(raw), len(words)
    letters = n[65:91].sum() + n[97:123].sum()
    symbols = n[35:39].sum() + n[42:43].sum() + n[64:65].sum() + n[94:97].sum() + n[126]
    out[:] = (
        np.log1p(count), n[65:91].sum() / max(1, letters), n[48:58].sum() / size, symbols / size, n[124] / count, text.count("!!") / count,
        len(set(words)) / count**0.9, sum(map(eq, words, words[1:])) / count, size / count, (n[46] + n[63]) / count, n[10] / count, n[192:256].sum() / size,
    )
    return out


def featured(df: DataFrame) -> DataFrame:
    """doc_id and x for every row of df (doc_id, text)."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "x": [features(t) for t in pdf.text]})

    return by_number(carried(df, "text").mapInPandas(run, "doc_id string, x array<double>"))


class Additive:
    """Sum of a weight per feature and bin; bins are quantiles of the unlabelled sample."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float):
        self.edges, self.weights, self.bias = edges, weights, bias

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") + k * (BINS + len(TAILS) + 1) for k, e in enumerate(self.edges)], axis=1)

    def raw(self, b: np.ndarray) -> np.ndarray:
        return self.weights[b].sum(axis=1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.binned(x)), -30, 30)))


def edges_of(positive: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Quantiles of the unlabelled sample, and where the positives' tails begin: what lies beyond is told apart from them."""
    inner = np.quantile(unlabelled, np.linspace(0, 1, BINS + 2)[1:-1])
    tails = np.quantile(positive, TAILS)
    tails = np.where(np.array(TAILS) < 0.5, np.nextafter(tails, -np.inf), tails)  # an edge belongs to the bin below it
    return np.unique(np.concatenate([inner, tails]))


def trained(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Additive | None:
    """The model of least non-negative risk, by Adam on whole samples."""
    if not len(positive) or not len(unlabelled):
        return None
    edges = [edges_of(positive[:, k], unlabelled[:, k]) for k in range(unlabelled.shape[1])]
    model = Additive(edges, np.zeros((BINS + len(TAILS) + 1) * len(edges)), 0.0)
    p, u = model.binned(positive), model.binned(unlabelled)
    size = len(model.weights)
    m, v = np.zeros(size + 1), np.zeros(size + 1)

    def pull(b: np.ndarray, g: np.ndarray) -> np.ndarray:
        sums = np.bincount(b.ravel(), np.repeat(g, b.shape[1]), minlength=size)
        return np.append(sums, g.sum()) / len(b)

    for step in range(1, STEPS + 1):
        fp, fu = model.raw(p), model.raw(u)
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        negative = pull(u, su) - prior * pull(p, sp)
        gradient = prior * pull(p, sp - 1) + negative if rest >= 0 else -negative
        gradient[:-1] += DECAY * model.weights
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= move[-1]
    return model


def scored(df: DataFrame, labels: DataFrame, most: int = MOST, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of df (doc_id, text); labels: (doc_id, quality)."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))
    rows = cut(featured(df).withColumn("held_out", held))
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    train = rows.where("not held_out")
    labelled = train.join(known, "doc_id")
    share = labelled.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]

    def sample(part: DataFrame) -> np.ndarray:
        """About ``most`` rows at most: those whose hash is below a cut that their number gives."""
        near = part.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / max(1, part.count())))
        got = near.select("x").limit(2 * most).toPandas()
        return np.stack(got.x) if len(got) else np.empty((0, len(FEATURES)))

    model = trained(sample(labelled.where("quality = 1")), sample(train), float(share)) if share else None

    def run(batches):
        for pdf in batches:
            score = model.score(np.stack(pdf.x)) if model is not None and len(pdf) else np.full(len(pdf), 0.5)
            yield pd.DataFrame({"doc_id": pdf.doc_id, "held_out": pdf.held_out, "score": score, "predicted": (score >= threshold).astype("int32")})

    return by_number(carried(rows, "held_out", "x").mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int"))


def accepted(df: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df that the classifier does not reject. Rows of one doc_id are judged by their best score."""
    id_ = unused(df, "_id")
    good = scored(df, labels, threshold=threshold).where("predicted = 1").select(F.col("doc_id").alias(id_)).distinct()
    return df.join(good, df["doc_id"].cast("long").eqNullSafe(good[id_]), "left_semi")


def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return scored(documents(spark, sf_dir), labels)


QUERIES = {"op8_quality_pu": op8_quality_pu}
SQL: dict[str, str] = {}
