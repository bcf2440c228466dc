"""Toxicity by compression distance.

Two zstandard dictionaries, one for toxic and one for ordinary text, compress
short windows of a document; a window that the toxic dictionary makes shorter
speaks for toxic content. Calibrated thresholds on the lengths saved turn a
document's windows into a score.

Training, on a bounded sample of labelled rows (`SAMPLE` documents a class, of
at most `LONGEST` characters; equal texts count once):

1. The sample is dealt in two: of each class, one in `PARTS` documents calibrates
   and the others train the dictionaries, so lengths are never calibrated on text
   that a dictionary has seen. (A class too small to be dealt does both.)
2. Each class has its dictionary, trained by zstandard on windows of its own text.
   What both classes say alike tells nothing, and a dictionary of toxic text would
   hold little else, as toxic documents are mostly ordinary prose; so toxic texts
   are first thinned to words that are `RATIO` times as frequent in them as in
   ordinary documents and are used by `LEAST` of them. Where nothing is left
   (small samples) whole windows are trained on, and text too little to train on
   is its own dictionary.
3. Both stand behind one common ground, trained on ordinary text as well, and are
   of equal length: general text is matched alike by both, and lengths differ by
   what marks toxic text.
4. On the calibrating documents, the evidence of a window is the log-likelihood
   ratio of its saving in toxic and ordinary documents. One logistic regression
   takes a document's shares of windows over thresholds of saving, its mean and its
   summed evidence. Shares dilute one toxic passage in a long text, so another
   takes the largest summed evidence over a run of at most `RUN` neighbouring
   windows, less the logarithm of the number of windows, as chance runs of
   log-likelihood ratios grow by that with the length; here the ratio is that of
   toxic windows, which the savings of toxic documents hold beside ordinary ones. The greater of the two is
   calibrated once more, and the intercept is moved from the sample's share of
   toxic documents to that of all labels. Texts in ASCII and others are calibrated
   apart, as chance matches of syllables differ.

Scoring reads whole texts, window by window, in bounded memory. A null or
empty text has no windows and no savings and is scored from that alone.
Documents without a label are scored like others; rows with null or repeated
ids each get their score; an empty table gives an empty result. Without labels
of both classes, or without any text in one, all scores are the share of toxic
labels (0.5 with none).
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table
from .labelled import fold, sample

WINDOW = 36
#: Bytes of the common ground, of each class's own content, and of the head that a trained dictionary has before its content. They fit a window of 2 ** 14.
GROUND, OWN, HEAD = 12_288, 1024, 512
SAMPLE = {0: 4000, 1: 4000}
LONGEST = 60_000
#: A word marks toxic text if it is so many times as frequent there, and used by that share of the toxic documents (and by `FEW` at least).
RATIO, LEAST, FEW = 8.0, 0.01, 4
PARTS = 6
#: Windows that a toxic passage is looked for in.
RUN = 8
#: Savings beyond these count as these.
LOW, HIGH = -8, 15
THRESHOLD = 0.5
#: Texts of another form (letters beyond ASCII) are matched by chance more often, so each is calibrated by itself where it has `ENOUGH` documents of both classes.
FORMS, OTHER, ENOUGH = 2, 0.02, 20
FOLDS, HELD_OUT = 5, 0

_BEYOND = bytes(range(128, 256))
_WORD = re.compile(r"\w+")
#: Short matches count: most of what marks a class is words.
_PARAMETERS = {"window_log": 14, "chain_log": 14, "hash_log": 14, "search_log": 6, "min_match": 4, "target_length": 32, "strategy": zstandard.STRATEGY_LAZY}


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """Lower-cased UTF-8 in runs of at most `size` bytes, cut at spaces where there are any."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    out, at, n = [], 0, len(raw)
    while at < n:
        end = at + size
        if end < n:
            space = raw.rfind(b" ", at + 1, end)
            end = space if space > at else end
        out.append(raw[at:end])
        at = end
    return out


def form(text: str | None) -> int:
    """0: nearly all ASCII; 1: more than `OTHER` of the bytes beyond it."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return int(len(raw) - len(raw.translate(None, _BEYOND)) > OTHER * len(raw))


def contrasted(own: list[str], other: list[str]) -> list[bytes]:
    """Windows of the texts `own`, thinned to words that mark them against `other`, each once a text."""
    mine, theirs = ([dict.fromkeys(_WORD.findall(t.lower())) for t in texts] for texts in (own, other))
    a, b = Counter(w for t in mine for w in t), Counter(w for t in theirs for w in t)
    least = max(FEW, LEAST * len(own))
    marks = {w for w, n in a.items() if n >= least and n * len(other) >= RATIO * (b[w] + 0.5) * len(own)}
    return [b" " + w + b" " for t in mine for w in windows(" ".join(w for w in t if w in marks), 64)]


def _trained(size: int, parts: list[bytes]) -> bytes:
    """A trained dictionary, or the last of the text itself where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[-size:]


def dictionaries(own: list[str], other: list[str], seed: int = 7) -> tuple[bytes, bytes]:
    """(toxic, ordinary) dictionaries of equal length from texts of both classes."""
    order = random.Random(seed)

    def mixed(parts: list[bytes]) -> list[bytes]:
        order.shuffle(parts)
        return parts

    plain = mixed([w for t in other for w in windows(t, 256)])
    ground, ordinary = _trained(GROUND, plain), _trained(OWN + HEAD, plain)
    toxic = _trained(OWN + HEAD, mixed(contrasted(own, other)) or mixed([w for t in own for w in windows(t, 256)]))
    size = min(OWN, len(toxic), len(ordinary))
    return (ground + toxic[-size:], ground + ordinary[-size:]) if size else (b"", b"")


def compressors(toxic: bytes, ordinary: bytes) -> list:
    """Functions from bytes to their compressed form under the ordinary and the toxic dictionary."""
    made = []
    for raw in (ordinary, toxic):
        p = zstandard.ZstdCompressionParameters(**_PARAMETERS, write_content_size=False, write_checksum=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO)
        d.precompute_compress(compression_params=p)
        made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
    return made


@dataclass
class Calibration:
    """From savings to log-odds. evidence and sharp: by saving, of a toxic document's window and of a toxic window; weights, passage and joint: regressions, intercept first."""

    evidence: np.ndarray
    sharp: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    passage: np.ndarray
    joint: np.ndarray

    def greater(self, x: np.ndarray) -> np.ndarray:
        whole = (x[:, :-1] - self.mean) / self.scale @ self.weights[1:] + self.weights[0]
        return np.maximum(whole, x[:, -1] * self.passage[1] + self.passage[0])

    def log_odds(self, gain: np.ndarray) -> float:
        return float(self.greater(np.array([all_features(gain, self.evidence, self.sharp)]))[0] * self.joint[1] + self.joint[0])


@dataclass
class Model:
    """Two dictionaries and a calibration for each form of text; no dictionaries where there was nothing to learn from."""

    toxic: bytes
    ordinary: bytes
    forms: tuple[Calibration, ...]
    prior: float

    def scorer(self):
        """A function from texts to scores."""
        if not self.toxic:
            return lambda texts: np.full(len(texts), self.prior)
        pair = compressors(self.toxic, self.ordinary)
        odds = lambda t: self.forms[form(t)].log_odds(savings(t, *pair))
        return lambda texts: 1 / (1 + np.exp(-np.clip(np.array([odds(t) for t in texts], dtype=np.float64), -30, 30)))


#: Savings whose shares are features, what is added to a share before its logarithm, and the most that summed evidence counts.
LARGE, FLOOR, MOST = (3, 4, 5, 6), 0.003, 12.0
N_FEATURES = len(LARGE) + 3


def savings(text: str | None, ordinary, toxic) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each window of a text."""
    return np.clip(np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], dtype=np.int64), LOW, HIGH)


def features(gain: np.ndarray, evidence: np.ndarray) -> list[float]:
    """What the savings of a document's windows amount to."""
    if not len(gain):
        return [math.log(FLOOR)] * len(LARGE) + [0.0, 0.0, 0.0]
    each = evidence[gain - LOW]
    return [*[math.log((gain >= k).mean() + FLOOR) for k in LARGE], each.mean(), np.maximum(each, 0).mean(), min(MOST, max(-MOST, each.sum()))]


def densest(gain: np.ndarray, evidence: np.ndarray) -> float:
    """The largest evidence of a run of neighbouring windows, less what length alone adds to it."""
    if not len(gain):
        return 0.0
    total = np.concatenate([[0.0], np.cumsum(evidence[gain - LOW])])
    return max(float((total[n:] - total[:-n]).max()) for n in range(1, min(RUN, len(gain)) + 1)) - math.log(len(gain))


def all_features(gain: np.ndarray, evidence: np.ndarray, sharp: np.ndarray) -> list[float]:
    return [*features(gain, evidence), densest(gain, sharp)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(a.shape[1])
        step = np.linalg.solve(h, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _log_odds(p: float) -> float:
    return math.log(p / (1 - p))


def calibrate(gains: list[np.ndarray], y: np.ndarray, common: Calibration | None = None) -> Calibration:
    """Fit on savings of documents that trained no dictionary, and their labels. A common calibration gives what concerns passages."""
    seen = np.full((2, HIGH - LOW + 1), 0.5)
    for gain, k in zip(gains, y, strict=True):
        np.add.at(seen[int(k)], gain - LOW, 1)
    often = seen / seen.sum(1, keepdims=True)
    evidence = np.log(often[1] / often[0])
    if common:
        sharp = common.sharp
    else:
        # most windows of a toxic document are ordinary; what is more than those explain is the toxic ones'
        nothing = slice(0, 1 - LOW)
        toxic = min(0.9, max(0.02, 1 - often[1][nothing].sum() / often[0][nothing].sum()))
        own = np.maximum(often[1] - (1 - toxic) * often[0], 0.02 * toxic * often[1])
        sharp = np.log(own / own.sum() / often[0])
    raw = np.array([all_features(g, evidence, sharp) for g in gains])
    mean, scale = raw[:, :-1].mean(0), raw[:, :-1].std(0) + 1e-6
    passage = common.passage if common else _logistic(raw[:, -1:], y)
    out = Calibration(evidence, sharp, mean, scale, _logistic((raw[:, :-1] - mean) / scale, y), passage, np.zeros(2))
    out.joint = _logistic(out.greater(raw)[:, None], y, ridge=1e-3)
    return out


def train(texts: list[str], labels: list[int], share: float | None = None, seed: int = 7) -> Model:
    """Dictionaries and calibration from labelled texts; `share` of the corpus's labels are toxic, if known."""
    prior = float(np.mean(labels)) if labels else 0.5
    none = Model(b"", b"", (), prior)
    if not 0 < prior < 1:
        return none
    classes = [list(dict.fromkeys(t for t, v in zip(texts, labels, strict=True) if v == k)) for k in (0, 1)]
    dealt = [(c[::PARTS], [t for i, t in enumerate(c) if i % PARTS]) if len(c) > PARTS else (c, c) for c in classes]
    toxic, ordinary = dictionaries(dealt[1][1], dealt[0][1], seed)
    if not toxic:
        return none
    pair = compressors(toxic, ordinary)
    gains = [savings(t, *pair) for calibrating, _ in dealt for t in calibrating]
    kinds = np.array([form(t) for calibrating, _ in dealt for t in calibrating])
    y = np.repeat([0.0, 1.0], [len(calibrating) for calibrating, _ in dealt])
    whole = calibrate(gains, y)
    forms = []
    for k in range(FORMS):
        mine = np.flatnonzero(kinds == k)
        enough = all((y[mine] == c).sum() >= ENOUGH for c in (0, 1))
        forms.append(calibrate([gains[i] for i in mine], y[mine], whole) if enough else replace(whole, joint=whole.joint.copy()))
        if share and share < 1:
            forms[-1].joint[0] += _log_odds(share) - _log_odds(float(y.mean()))
    return Model(toxic, ordinary, tuple(forms), prior)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on the bounded sample; rows of the held-out fold are never read."""
    usable = fold(F.col(id_col), FOLDS) != HELD_OUT
    short = docs.where(F.length(text_col) <= LONGEST)
    rows = sample(short, labels, "toxic", usable, SAMPLE, id_col, text_col).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["text"]))
    share = labels.where(usable).agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return train([r["text"] for r in rows], [r["label"] for r in rows], share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row of `docs`."""
    kind = dict(docs.dtypes)[id_col]
    made: list = []

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(model.scorer())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(made[0](b.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return map_arrow(docs.select(id_col, text_col), batch, f"doc_id {kind}, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLES: dict[str, str] = {}
