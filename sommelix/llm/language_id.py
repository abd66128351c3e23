"""Language identification by a string kernel.

A text's features are the n-grams (one to four letters, all else as blanks) that occur in it, hashed to ``DIMS`` places.
The kernel of two texts is the number of shared n-grams over the root of the product of their numbers. Nystrom landmarks
stand for the training texts, and ridge regression on them, one language against the rest, gives the weights. As the
landmarks' kernel is linear in a text's presence vector, landmarks and weights fold into one matrix of
DIMS x languages, and a block of texts is scored by one matrix product.

Training uses at most ``PER_LANGUAGE`` labelled texts of a language, chosen by a hash of the id; only their presence
bits (DIMS / 8 bytes each) reach the driver. All texts are scored whole.

Defined cases: texts that are null or have no letter get ``und`` and score 0; null or held-out labels are never learned
from; without any training rows everything is ``und``; repeated rows are rows of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.common import held_out, learnable, per_text

DIMS = 1 << 16
ORDERS = 4
PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 64
RIDGE = 1e-3
SHARPNESS = 8.0
BLOCK_ROWS = 64
PIECE_CHARS = 500_000

_letters: np.ndarray | None = None


def _code_points(text: str) -> np.ndarray:
    """Lower-cased code points; anything but a letter is a blank."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters[points], points, np.uint32(32))


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """rows x DIMS booleans, and whether each text has a letter. Long texts are taken in overlapping pieces."""
    out = np.zeros(len(texts) * DIMS, bool)
    lettered = np.zeros(len(texts), bool)
    pieces: list[np.ndarray] = []
    rows: list[int] = []
    held = 0

    def flush():
        nonlocal held
        if not pieces:
            return
        points = np.concatenate(pieces)
        sizes = np.array([len(p) for p in pieces])
        base = np.repeat(np.array(rows, np.int64) * DIMS, sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # code points up to the piece's end
        code = np.zeros(len(points), np.uint64)
        for n in range(1, ORDERS + 1):
            code = code[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
            place = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
            inside = left[: len(code)] >= n
            out[(base[: len(code)] + place)[inside]] = True
        pieces.clear()
        rows.clear()
        held = 0

    for row, text in enumerate(texts):
        if not text:
            continue
        points = _code_points(text)
        lettered[row] = bool((points != 32).any())
        for at in range(0, len(points), PIECE_CHARS):
            pieces.append(points[at : at + PIECE_CHARS + ORDERS - 1])
            rows.append(row)
            held += len(pieces[-1])
            if held >= PIECE_CHARS:
                flush()
    flush()
    return out.reshape(len(texts), DIMS), lettered


class Model:
    """languages in order, and weights of DIMS x languages."""

    def __init__(self, packed: np.ndarray, labels: np.ndarray, landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE):
        """packed: presence bits of the training texts, 8 places a byte. They are unpacked a few places at a time."""
        self.languages = sorted(set(labels))
        chosen = np.concatenate([np.flatnonzero(labels == c)[:landmarks] for c in self.languages])
        blocks = [slice(at, at + 512) for at in range(0, packed.shape[1], 512)]
        open_ = lambda rows, at: np.unpackbits(rows[:, at], axis=1).astype(np.float32)
        k_nm = np.zeros((len(packed), len(chosen)))
        size = np.zeros(len(packed))
        for at in blocks:
            x = open_(packed, at)
            k_nm += x @ x[chosen].T
            size += x.sum(1)
        root = np.sqrt(np.maximum(1, size))
        k_nm /= root[:, None] * root[chosen][None, :]
        k_mm = k_nm[chosen]
        y = np.where(labels[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        left = k_nm.T @ k_nm + ridge * len(packed) * k_mm + 1e-8 * len(packed) * np.eye(len(chosen))
        solved = np.linalg.solve(left, k_nm.T @ y) / root[chosen][:, None]
        self.weights = np.vstack([open_(packed[chosen], at).T @ solved for at in blocks]).astype(np.float32)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        bits, lettered = presence(texts)
        x = bits.astype(np.float32)
        f = (x @ self.weights) / np.sqrt(np.maximum(1, x.sum(1, keepdims=True)))
        p = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best, lettered)]
        return names, [float(p[i, b]) if lettered[i] else 0.0 for i, b in enumerate(best)]


def training_rows(docs: DataFrame, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` learnable rows of each label, the first by a hash of the id; a count by label comes first so
    that hardly more than the chosen rows' texts are moved."""
    known = docs.where(learnable(F.col("doc_id")) & F.col(label).isNotNull() & F.col("text").isNotNull())
    mark = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 40))
    share = known.groupBy(label).agg((F.lit(float(1 << 40)) * 2 * per_label / F.count("*")).alias("below"))
    near = known.select(label, "text", mark.alias("mark")).join(F.broadcast(share), label).where(F.col("mark") <= F.col("below"))
    order = Window.partitionBy(label).orderBy("mark", F.xxhash64("text"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_label).select(label, "text", "mark")


def train(docs: DataFrame, label: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at : at + BLOCK_ROWS]
                on, _ = presence(list(part["text"]))
                yield pd.DataFrame({"label": part[label].astype(str), "mark": part["mark"], "bits": [np.packbits(r).tobytes() for r in on]})

    rows = training_rows(docs, label, per_language).mapInPandas(bits, "label string, mark bigint, bits binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["label"], r["mark"], bytes(r["bits"])))
    packed = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), DIMS // 8)
    return Model(packed, np.array([r["label"] for r in rows]))


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """row (the kept columns), lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def predict(texts):
            names: list[str] = []
            scores: list[float] = []
            for at in range(0, len(texts), BLOCK_ROWS):
                part = texts[at : at + BLOCK_ROWS]
                n, s = shared.value(part) if shared.value else (["und"] * len(part), [0.0] * len(part))
                names += n
                scores += s
            return [names, scores]

        return predict

    return per_text(docs, make, {"lang_pred": ("string", pa.string()), "score": ("double", pa.float64())}, keep)


def op6_language_id(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, train(docs), ("doc_id",))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
