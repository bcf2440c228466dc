"""Quality by attention-based multiple-instance learning.

A document is a bag of passages, runs of `PASSAGE` words. Every passage is
encoded from counts of its characters and words; a gated attention layer,
tanh(VH) * sigmoid(UH), learns from document labels alone which passages
matter, and a logistic layer scores the attention-weighted mean of their codes.

Training, on the driver, takes at most `SAMPLE` labelled documents a class,
chosen by a hash of the id, as arrays of passage counts made on the executors
(documents of more than `LONGEST` passages are not sampled). Scoring reads whole
texts. A null or empty text is one passage without words. Documents without a
label are scored like others; rows with null or repeated ids each get their
score; an empty table gives an empty result. Without labels of both classes
every score is the share of label 1 (0.5 with none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table
from .labelled import fold, sample

PASSAGE = 64
SAMPLE = {0: 3000, 1: 5000}
LONGEST = 2000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
HIDDEN, GATE = 24, 16
EPOCHS, BATCH, RATE, DECAY = 60, 256, 0.01, 1e-4

#: Character classes by byte; the shares of each class are features.
CLASSES = ("upper", "lower", "digit", "space", "stop", "quote", "exclaim", "symbol", "lead", "follow", "other")


def _classes() -> np.ndarray:
    of = np.full(256, CLASSES.index("other"), dtype=np.uint8)
    for name, members in (
        ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("lower", b"abcdefghijklmnopqrstuvwxyz"),
        ("digit", b"0123456789"),
        ("space", b" "),
        ("stop", b".,;:?"),
        ("quote", b"\"'()-"),
        ("exclaim", b"!"),
        ("symbol", b"#*$%&|<>@[]{}=_~^\\/+`"),
        ("lead", bytes(range(0xC0, 0x100))),
        ("follow", bytes(range(0x80, 0xC0))),
    ):
        of[list(members)] = CLASSES.index(name)
    return of


CLASS_OF = _classes()
N_FEATURES = len(CLASSES) + 6


def encode(text: str | None) -> np.ndarray:
    """Features of each passage of a text: float32, passages x N_FEATURES."""
    words = (text or "").split()
    rows = []
    for i in range(0, max(1, len(words)), PASSAGE):
        part = words[i : i + PASSAGE]
        raw = np.frombuffer(" ".join(part).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        n, size = max(1, len(part)), max(1, len(raw))
        shares = np.bincount(CLASS_OF[raw], minlength=len(CLASSES)) / size
        steps = sum(a == b for a, b in zip(part, part[1:], strict=False))
        pairs = len(set(zip(part, part[1:], strict=False)))
        longest = max(map(len, part), default=0)
        rows.append([*shares, len(set(part)) / n, pairs / n, steps / n, np.log1p(size / n), np.log1p(longest), np.log1p(len(part))])
    return np.array(rows, dtype=np.float32)


@dataclass
class Model:
    """Weights; `w` is empty where there was nothing to learn from."""

    w: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not self.w:
            return np.full(len(bags), self.prior)
        if not bags:
            return np.zeros(0)
        x, first, seg = _stack(bags, self.mean, self.scale)
        return _forward(self.w, x, first, seg)["p"]


def _stack(bags: list[np.ndarray], mean: np.ndarray, scale: np.ndarray):
    sizes = np.array([len(b) for b in bags])
    first = np.cumsum(sizes) - sizes
    return (np.concatenate(bags).astype(np.float64) - mean) / scale, first, np.repeat(np.arange(len(bags)), sizes)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, seg: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["w1"] + w["b1"])
    t, s = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    e = (t * s) @ w["g"]
    e = np.exp(e - np.maximum.reduceat(e, first)[seg])
    a = e / np.add.reduceat(e, first)[seg]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["b"])}


def _gradient(w, x, first, seg, y) -> dict[str, np.ndarray]:
    f = _forward(w, x, first, seg)
    h, t, s, a = f["h"], f["t"], f["s"], f["a"]
    d = (f["p"] - y) / len(y)
    dz = (d[:, None] * w["c"])[seg]
    da = (dz * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, first)[seg])
    dt, ds = de[:, None] * w["g"] * s * (1 - t * t), de[:, None] * w["g"] * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ w["v"].T + ds @ w["u"].T) * (1 - h * h)
    return {"c": f["z"].T @ d, "b": d.sum(keepdims=True), "g": (t * s).T @ de, "v": h.T @ dt, "u": h.T @ ds, "w1": x.T @ dh, "b1": dh.sum(0)}


def train(bags: list[np.ndarray], labels: list[int], seed: int = 11) -> Model:
    """Fit by Adam on the cross entropy of document labels."""
    y = np.array(labels, dtype=np.float64)
    prior = float(y.mean()) if len(y) else 0.5
    if len(y) < 20 or y.min() == y.max():
        return Model({}, np.zeros(N_FEATURES), np.ones(N_FEATURES), prior)
    rows = np.concatenate(bags).astype(np.float64)
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    w = {"w1": normal(N_FEATURES, HIDDEN), "b1": np.zeros(HIDDEN), "v": normal(HIDDEN, GATE), "u": normal(HIDDEN, GATE), "g": normal(GATE), "c": normal(HIDDEN), "b": np.zeros(1)}
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            part = order[i : i + BATCH]
            grad = _gradient(w, *_stack([bags[j] for j in part], mean, scale), y[part])
            step += 1
            for k in w:
                g = grad[k] + DECAY * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(w, mean, scale, prior)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on the bounded sample; rows of the held-out fold are never read."""
    chosen = sample(docs, labels, "quality", fold(F.col(id_col), FOLDS) != HELD_OUT, SAMPLE, id_col, text_col)
    kind = dict(chosen.dtypes)["doc_id"]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        bags = [encode(t) for t in b.column(1).to_pylist()]
        raw = [x.tobytes() if len(x) <= LONGEST else None for x in bags]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(raw, pa.binary())], ["doc_id", "label", "bag"])

    rows = map_arrow(chosen, batch, f"doc_id {kind}, label int, bag binary", rows=200).where("bag IS NOT NULL").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["bag"])))
    return train([np.frombuffer(r["bag"], dtype=np.float32).reshape(-1, N_FEATURES) for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row of `docs`."""
    kind = dict(docs.dtypes)[id_col]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score([encode(t) for t in b.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return map_arrow(docs.select(id_col, text_col), batch, f"doc_id {kind}, score double", rows=200)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
ORACLES: dict[str, str] = {}
