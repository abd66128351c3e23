"""Document quality by a linear-chain conditional random field over lines.

Every line has measured features and those of its neighbours; the field labels each line good or bad, and forward-backward
gives each line's probability of being good given the whole document. The document's score is the mean of these weighted
by line length. In training a line has its document's label, as labels exist for documents only.

Training uses at most ``PER_LABEL`` learnable documents of each label, of at most ``TRAIN_LINES`` lines each; only their
features reach the driver. All documents are scored whole.

Defined cases: blank lines are left out; a text without words (or null) is one line whose features are all 0; null
labels and ids are never learned from, and of several labels of a document the smallest counts; without training rows
the weights are 0 and scores 0.5; repeated rows are rows of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.common import held_out, learnable, per_text

PER_LABEL = 800
TRAIN_LINES = 64
EPOCHS = 120
RATE = 0.1
L2 = 1e-3
THRESHOLD = 0.7
BLOCK_LINES = 20_000

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>!{}[]=~^_@\\"
_STOPS = b".,;:?"
N_OWN = 12


def line_features(line: str) -> list[float]:
    data = line.encode("utf-8", "surrogatepass")
    w = data.split()
    n, size = len(w), len(data)

    def count(which: bytes) -> int:
        return size - len(data.translate(None, which))

    upper, lower = count(_UPPER), count(_LOWER)
    same = sum(map(bytes.__eq__, w, w[1:]))
    pairs = set(zip(w, w[1:]))
    symbols = count(_SYMBOLS)
    return [
        1.0,
        np.log1p(n),
        upper / (upper + lower + 1),
        count(_DIGITS) / size,
        symbols / size,
        min(1.0, symbols / n),
        count(_STOPS) / size,
        1 - len(set(w)) / n,
        1 - (len(pairs) + 1) / n if n > 1 else 0.0,
        same / n,
        (size - n + 1) / n / 10,
        float(data.rstrip()[-1:] in (b".", b"!", b"?")),
    ]


def document_lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (own, previous, next) and lengths of the lines that have words."""
    lines = [x for x in (text or "").split("\n") if x.encode("utf-8", "surrogatepass").split()]
    if not lines:
        return np.zeros((1, 3 * N_OWN)), np.ones(1)
    own = np.array([line_features(x) for x in lines])
    none = np.zeros((1, N_OWN))
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none])]), np.array([len(x) for x in lines], float)


def _padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, docs))
    x = np.zeros((len(docs), longest, 3 * N_OWN))
    on = np.zeros((len(docs), longest), bool)
    for i, d in enumerate(docs):
        x[i, : len(d)] = d
        on[i, : len(d)] = True
    return x, on


def _sum_exp(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None]).sum(1))


class Crf:
    """Weights of the good label's score over the bad one's, and the scores of label pairs [previous, next]."""

    def __init__(self):
        self.w = np.zeros(3 * N_OWN)
        self.pairs = np.zeros((2, 2))
        self.scale = np.ones(3 * N_OWN)

    def marginals(self, x: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of good for each line, and of label pairs summed over each document's neighbouring lines."""
        n, t = on.shape
        emit = np.stack([np.zeros((n, t)), x @ (self.w / self.scale)], 2)
        forward, backward = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        forward[:, 0] = emit[:, 0]
        for k in range(1, t):
            now = np.stack([_sum_exp(forward[:, k - 1] + self.pairs[:, j]) for j in (0, 1)], 1) + emit[:, k]
            forward[:, k] = np.where(on[:, k, None], now, forward[:, k - 1])
        total = _sum_exp(forward[:, -1])
        for k in range(t - 2, -1, -1):
            later = emit[:, k + 1] + backward[:, k + 1]
            now = np.stack([_sum_exp(later + self.pairs[i]) for i in (0, 1)], 1)
            backward[:, k] = np.where(on[:, k + 1, None], now, 0.0)
        good = np.exp(np.minimum(0, forward[:, :, 1] + backward[:, :, 1] - total[:, None])) * on
        both = np.zeros((2, 2))
        if t > 1:
            for i in (0, 1):
                for j in (0, 1):
                    s = forward[:, :-1, i] + self.pairs[i, j] + emit[:, 1:, j] + backward[:, 1:, j] - total[:, None]
                    both[i, j] = (np.exp(np.minimum(0, s)) * on[:, 1:]).sum()
        return good, both

    def fit(self, docs: list[np.ndarray], labels: np.ndarray) -> Crf:
        """Maximum likelihood by Adam; both labels weigh the same."""
        x, on = _padded(docs)
        self.scale = np.maximum(1e-3, np.sqrt((x[on] ** 2).mean(0)))
        weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
        groups = [(labels == k, weight[labels == k].max()) for k in (0, 1) if (labels == k).any()]
        m, v = np.zeros(len(self.w) + 4), np.zeros(len(self.w) + 4)
        for step in range(1, EPOCHS + 1):
            grad_w, grad_p = -L2 * self.w, -L2 * self.pairs
            for own, share in groups:
                label = int(labels[own][0])
                good, both = self.marginals(x[own], on[own])
                grad_w = grad_w + share * np.einsum("ntf,nt->f", x[own], (label - good) * on[own]) / self.scale
                wanted = np.zeros((2, 2))
                wanted[label, label] = on[own][:, 1:].sum()
                grad_p = grad_p + share * (wanted - both)
            g = np.concatenate([grad_w, grad_p.ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            self.w = self.w + move[:-4]
            self.pairs = self.pairs + move[-4:].reshape(2, 2)
        return self

    def score(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted mean probability; documents of like numbers of lines go together."""
        out = np.zeros(len(docs))
        order = sorted(range(len(docs)), key=lambda i: len(docs[i][1]))
        at = 0
        while at < len(order):
            end = at + 1
            most = 2 * len(docs[order[at]][1])
            while end < len(order) and len(docs[order[end]][1]) <= most and (end - at) * most < BLOCK_LINES:
                end += 1
            x, on = _padded([docs[i][0] for i in order[at:end]])
            good, _ = self.marginals(x, on)
            for row, i in enumerate(order[at:end]):
                size = docs[i][1]
                out[i] = float(good[row, : len(size)] @ size / size.sum())
            at = end
        return np.clip(out, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL) -> Crf:
    """Fits the field on at most ``per_label`` documents of each label, the first by a hash of the id."""
    known = labels.where(learnable(F.col("doc_id")) & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("label"))
    mark = F.xxhash64("doc_id", F.lit("train"))
    share = known.groupBy("label").agg(F.count("*").alias("n"))
    # ids first: about twice as many as wanted, as documents may be missing or have too many lines; that bounds the
    # broadcast, and no text is moved but theirs
    near = known.join(share, "label").where(F.pmod(mark, F.lit(1 << 30)) * F.col("n") <= F.lit((1 << 30) * 2 * per_label))
    short = docs.where(F.col("text").isNotNull() & (F.regexp_count("text", F.lit("\n")) < TRAIN_LINES)).select("doc_id", "text")
    chosen = short.join(F.broadcast(near.select("doc_id", "label")), "doc_id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy(mark, F.xxhash64("text")))
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [document_lines(t)[0].astype(np.float32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "rank": batch["rank"], "x": x})

    rows = chosen.where(F.col("rank") <= per_label).select("label", "rank", "text").mapInPandas(features, "label int, rank int, x binary").collect()
    rows.sort(key=lambda r: (r["label"], r["rank"]))
    if not rows:
        return Crf()
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, 3 * N_OWN).astype(float) for r in rows]
    return Crf().fit(x, np.array([r["label"] for r in rows]))


def score_quality(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id and score (probability of good) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def predict(texts):
            parts = [texts[at : at + 1000] for at in range(0, len(texts), 1000)]
            return [np.concatenate([np.zeros(0)] + [shared.value.score([document_lines(t) for t in p]) for p in parts])]

        return predict

    return per_text(docs, make, {"score": ("double", pa.float64())}, ("doc_id",)).select("row.doc_id", "score")


def op7_quality_crf(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
