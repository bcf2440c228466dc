import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from citeloom.llm import quality_classifier as q
from citeloom.llm import toxicity as t
from citeloom.llm.labelled import sample

LARGE = "/root/testdata/sf0.1"


def labelled(label):
    rows = duckdb.sql(f"SELECT doc_id, text, {label} FROM '{LARGE}/documents.parquet' JOIN '{LARGE}/labels.parquet' USING (doc_id)").fetchall()
    return {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}


@pytest.mark.parametrize(("op", "label", "folds", "held", "cut", "least"), [(q.op5_quality_classifier, "quality", 4, 2, 0.7, 0.98), (t.op8_toxicity, "toxic", 5, 0, 0.5, 0.91)])
def test_held_out_accuracy(spark, op, label, folds, held, cut, least):
    texts, labels = labelled(label)
    rows = op(spark, LARGE).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    out = [(r.predicted, labels[r.doc_id], r.doc_id) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b, _ in out]) >= least
    if label == "toxic":
        plain = [r for r in rows if r.held_out and labels.get(r.doc_id) == 0]
        assert np.mean([r.predicted for r in plain]) < 0.02


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    shapes = {"w1": (q.N_FEATURES, q.HIDDEN), "b1": (q.HIDDEN,), "v": (q.HIDDEN, q.GATE), "u": (q.HIDDEN, q.GATE), "g": (q.GATE,), "c": (q.HIDDEN,), "b": (1,)}
    w = {k: rng.normal(size=s) * 0.3 for k, s in shapes.items()}
    bags = [rng.normal(size=(n, q.N_FEATURES)) for n in (1, 4, 2)]
    x = q._stack(bags, np.zeros(q.N_FEATURES), np.ones(q.N_FEATURES))
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        p = q._forward(w, *x)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grad = q._gradient(w, *x, y)
    for k in w:
        at = tuple(0 for _ in w[k].shape)
        w[k][at] += 1e-5
        up = loss()
        w[k][at] -= 2e-5
        down = loss()
        w[k][at] += 1e-5
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-9)


def test_attention_finds_the_passage():
    """Only one passage of a good document tells; its weight is the largest."""
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(400):
        bag = rng.normal(size=(6, q.N_FEATURES)).astype(np.float32)
        if i % 2:
            bag[i % 6, :3] += 4
        bags.append(bag)
        labels.append(i % 2)
    model = q.train(bags, labels)
    assert np.mean((model.score(bags) > 0.5) == np.array(labels)) > 0.95
    x = q._stack(bags, model.mean, model.scale)
    weights = q._forward(model.w, *x)["a"].reshape(-1, 6)
    assert np.mean([weights[i].argmax() == i % 6 for i in range(1, 400, 2)]) > 0.9


def odd(spark):
    rows = [(None, None, 1), (1, "", 1), (2, "word " * 50_000, 1), (2, "word " * 50_000, 1), (3, "plain text", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score int"), spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module", [q, t])
def test_odd_rows_and_no_labels(spark, module):
    docs, labels = odd(spark)
    model = module.fit(docs, labels)
    rows = module.score(docs, model).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5}
    assert module.score(docs.where("false"), model).count() == 0


def test_trained_models_take_odd_rows(spark):
    docs, _ = odd(spark)
    texts, labels = labelled("toxic")
    some = sorted(texts)[:1200]
    tox = t.train([texts[i] for i in some], [labels[i] for i in some])
    _, good = labelled("quality")
    qual = q.train([q.encode(texts[i]) for i in some], [good[i] for i in some])
    for module, model in ((t, tox), (q, qual)):
        rows = module.score(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)


def marked(own, other, most=None):
    """The words that the toxic dictionary is trained on, those of most documents first."""
    often = Counter(w for part in t.contrasted(own, other) for w in part.decode().split())
    return [w for w, _ in sorted(often.items(), key=lambda x: (-x[1], x[0]))[:most]]


def test_toxic_text_is_thinned_and_windows_lose_nothing():
    own = [f"some filler{i} vile text here filler{i * 3}" for i in range(60)]
    other = [f"some filler{i} nice text here filler{i * 5}" for i in range(60)]
    assert marked(own, other) == ["vile"] and t.contrasted(own, own) == []
    parts = t.windows("ÄB " + "x" * 200 + " end")
    assert b"".join(parts).decode() == "äb " + "x" * 200 + " end" and max(map(len, parts)) <= t.WINDOW
    assert t.windows(None) == t.windows("") == []
    assert [t.form(x) for x in ("", None, "plain", "naïve " + "x" * 200, "für größere Häuser")] == [0, 0, 0, 0, 1]


def test_savings_are_differences_of_compressed_lengths():
    """Against compression of each window by hand, and decompression with the same dictionary."""
    texts, labels = labelled("toxic")
    some = sorted(texts)[:1500]
    model = t.train([texts[i] for i in some], [labels[i] for i in some])
    assert len(model.toxic) == len(model.ordinary) and model.toxic[: t.GROUND] == model.ordinary[: t.GROUND]
    for i in some[:40]:
        lengths = []
        for raw in (model.ordinary, model.toxic):
            dictionary = zstandard.ZstdCompressionDict(raw)
            p = zstandard.ZstdCompressionParameters(**t._PARAMETERS, write_content_size=False, write_dict_id=False)
            packed = [zstandard.ZstdCompressor(dict_data=dictionary, compression_params=p).compress(w) for w in t.windows(texts[i])]
            back = zstandard.ZstdDecompressor(dict_data=dictionary)
            assert b"".join(back.decompress(x, max_output_size=t.WINDOW) for x in packed) == texts[i].lower().encode()
            lengths.append([len(x) for x in packed])
        by_hand = np.clip(np.array(lengths[0], dtype=int) - np.array(lengths[1], dtype=int), t.LOW, t.HIGH)
        assert (t.savings(texts[i], *t.compressors(model.toxic, model.ordinary)) == by_hand).all()


def test_one_toxic_passage_in_a_long_text_is_found():
    texts, labels = labelled("toxic")
    some = [i for i in sorted(texts) if len(texts[i]) <= t.LONGEST and zlib.crc32(str(i).encode()) % t.FOLDS != t.HELD_OUT]
    rnd = random.Random(3)
    own, other = [texts[i] for i in some if labels[i]], [texts[i] for i in some if not labels[i]]
    score = t.train(own + other, [1] * len(own) + [0] * len(other), len(own) / len(some)).scorer()
    marks = marked(own, other, 10)
    held = [texts[i] for i in sorted(texts) if zlib.crc32(str(i).encode()) % t.FOLDS == t.HELD_OUT and not labels[i]]
    words = [w for x in held for w in x.split() if w.lower() not in marks]
    for n in (500, 3000, 8000, 20_000):
        for toxic in (10, 20):
            plain, planted = [], []
            for _ in range(10):
                at, where = rnd.randrange(len(words) - n), rnd.randrange(n - 50)
                text = words[at : at + n]
                passage = rnd.choices(marks, k=toxic) + rnd.choices(words, k=50 - toxic)
                rnd.shuffle(passage)
                plain.append(" ".join(text))
                planted.append(" ".join(text[:where] + passage + text[where + 50 :]))
            caught, flagged = (score(planted) >= t.THRESHOLD).mean(), (score(plain) >= t.THRESHOLD).mean()
            # a word of five letters saves hardly more than a chance match, so ten words of fifty drown in very long texts
            assert caught >= (0.9 if toxic == 20 else 0.7 if n <= 3000 else 0.3) and flagged <= 0.1, (n, toxic)


def test_small_label_sets_are_trained_on_text():
    own, other = ["vile filth and scorn"] * 3, ["a calm day by the lake"] * 3
    assert t.contrasted(own, other) == []
    bad, good = t.train(own + other, [1] * 3 + [0] * 3).scorer()(["vile filth and scorn", "a calm day by the lake"])
    assert bad > good
    assert set(t.train(own + [""], [1] * 3 + [0]).scorer()(["vile", "calm"])) == {0.75}


def test_dictionaries_see_all_windows_of_their_texts(monkeypatch):
    seen, real = [], t._trained
    monkeypatch.setattr(t, "_trained", lambda size, parts: seen.append(len(parts)) or real(size, parts[:2000]))
    other = [" ".join(f"plain{i % 7}x{j}" for j in range(28_000)) for i in range(40)]
    assert sum(len(t.windows(x, 256)) for x in other) > 40_000
    t.dictionaries(["vile filth"] * 4, other)
    assert seen[:2] == [sum(len(t.windows(x, 256)) for x in other)] * 2


def test_a_repeated_id_does_not_escape_the_bound_of_the_sample(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(2, "b"), (3, None), (None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (None, 1)], "doc_id long, y int")
    got = sample(docs, labels, "y", F.lit(True), {0: 2, 1: 3}).collect()
    assert sorted((r.doc_id, r.label) for r in got) == [(1, 1)] * 3 + [(2, 0), (3, 0)]
