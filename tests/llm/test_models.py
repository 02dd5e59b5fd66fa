import zlib

import numpy as np
import pyarrow as pa
import pytest
from settleflow.llm import langid, quality, toxicity
from settleflow.llm.langid import identify
from settleflow.llm.quality import score_quality
from settleflow.llm.tables import labelled_sample
from settleflow.llm.toxicity import score_toxicity
from settleflow.llm.words import pieces

SMALL = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score double, HELD_OUT boolean, predicted int"


def fold(i, folds):
    return 0 if i is None else zlib.crc32(str(i).encode()) % folds


def auc(score, truth):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = truth.sum()
    return (rank[truth == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(truth) - ones))


@pytest.mark.parametrize(
    "scored, label, folds, held, least", [(score_toxicity, "toxic", 4, 2, 0.75), (score_quality, "quality", 5, 0, 0.97)]
)
def test_held_out_labels_are_told_apart(spark, scored, label, folds, held, least):
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    rows = scored(docs, labels).collect()
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (fold(r["doc_id"], folds) == held) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    out = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert auc(np.array([r["score"] for r in out]), np.array([truth[r["doc_id"]] for r in out])) > least


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    out = [r for r in identify(docs).collect() if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in out)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.95


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, "you utter fool " * 4 if i % 2 else "a kind and gentle word " * 4, "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, " 12 -- \n", "en"), (103, "fool " * 40_000, "de"), (None, "kind", "en"), (1, rows[1][1], "en")]
    rows += [(104, "π" * 5, None), (105, "x", None)]
    labels = [(i, i % 2, i % 2) for i in range(40)] + [(100, 1, 1), (3, 1, None), (None, 0, 0), (104, None, 7)]
    docs = spark.createDataFrame([(*r, 0.5, True, 3) for r in rows], DOCS)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("scored", [score_toxicity, score_quality])
def test_odd_texts_are_scored(spark, odd, scored):
    docs, labels = odd
    rows = scored(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (100, 101)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    of = {r["doc_id"]: r["score"] for r in rows}
    assert of[1] > 0.5 > of[2]
    assert scored(docs.limit(0), labels).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 1 AND quality = 1")):
        assert len({r["score"] for r in scored(docs, few).collect()}) == 1


@pytest.mark.parametrize("scored", [score_toxicity, score_quality])
def test_a_class_of_long_texts_only_is_learned(spark, scored):
    rows = [(i, "you utter fool " * 4000 if i % 2 else "a kind and gentle word " * 4) for i in range(40)]
    docs = spark.createDataFrame([*rows, (100, "utter fool you " * 5)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    of = {r["doc_id"]: r["score"] for r in scored(docs, labels).collect()}
    assert of[1] > 0.5 and of[100] > 0.5 > of[2]


def test_sample_is_bounded_by_all_characters_not_by_length(spark):
    long = "".join(f"{i:05} " for i in range(10_000))
    docs = spark.createDataFrame([(1, long), (3, "ab " * 100), (4, "cd"), (5, long), (6, ""), (7, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, toxic int")
    held = [i for i in (1, 3, 4, 5) if fold(i, 4) == 2]
    sample = lambda total: [(r["_text"], r["_label"]) for r in labelled_sample(docs, labels, "toxic", 4, 2, 100, total).collect()]
    whole = sample(200_000)
    assert sorted(map(len, (t for t, _ in whole))) == sorted(n for i, n in ((1, 60_000), (3, 300), (4, 2), (5, 60_000)) if i not in held)
    some = sample(12_000)
    assert len(some) == len(whole) and sum(len(t) for t, _ in some) <= 12_000
    for text, _ in some:
        if len(text) > 300:
            windows = text.split("\n")
            assert len(windows) == 16 and all(w in long for w in windows)
            assert all(i * 3750 <= long.index(w) <= (i + 1) * 3750 - len(w) for i, w in enumerate(windows))


def test_odd_texts_have_a_language(spark, odd):
    docs, _ = odd
    rows = {r["doc_id"]: r for r in identify(docs).collect()}
    assert {rows[i]["lang_pred"] for i in (100, 101, 102)} == {"und"}
    assert rows[100]["score"] == 0 and rows[104]["lang_pred"] in ("en", "de")
    assert identify(docs.limit(0)).count() == 0
    nothing = identify(docs.withColumn("lang", docs["lang"].substr(0, 0)).where("lang IS NULL"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_every_language_is_learned(spark):
    """More than 64 languages, rare ones, one of long texts only, one that shares its ids, one mostly of one repeated id."""
    word = lambda n: chr(0x4E00 + 7 * n) + chr(0x4E01 + 7 * n)
    rows = [(100 * n + i, f"{word(n)} " * 20, f"l{n:02}") for n in range(70) for i in range(12 if n < 64 else 4)]
    rows += [(10_000 + i, "ab cd " * 5_000, "long") for i in range(8)]
    rows += [(100 + i, "xyz zyx " * 20, "shared") for i in range(12)]
    repeated = next(i for i in range(20_000, 20_100) if fold(i, 4) != 2)
    rows += [(repeated, "qq ww " * 20, "again")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.learn(docs, 4, 2)
    assert set(net.names) == {lang for i, _, lang in rows if fold(i, 4) != 2}
    assert len(net.names) > 64 and {"long", "shared", "again"} < set(net.names)


def test_rows_per_language_shrink_as_languages_grow(spark, monkeypatch):
    monkeypatch.setattr(langid, "TOTAL_ROWS", 60)
    usable = spark.range(4000).selectExpr("id AS _id", "IF(id < 3000, 'a', IF(id < 3010, 'b', 'c')) AS _label")
    found = langid._chosen(usable)
    assert sorted(label for _, label in found) == ["a"] * 20 + ["b"] * 10 + ["c"] * 20
    hashes = {row[0]: row[1] for row in usable.selectExpr("_id", "xxhash64(_id)").collect()}
    for label, ids in (("a", range(3000)), ("b", range(3000, 3010)), ("c", range(3010, 4000))):
        assert {i for i, of in found if of == label} == set(sorted(ids, key=hashes.get)[:20])


def test_windows_learned_from_are_spread_over_the_text():
    (texts,) = pieces(pa.array(["a" * 300, "".join(chr(97 + i // 6000) for i in range(36_000)), ""]))
    short, long, none = langid.excerpts(texts)
    assert [len(w) for w in short] == [131, 131, 44] and none == []
    assert [w[:1] for w in long] == [bytes([97 + i]) for i in range(6)]


def test_gradients_of_the_recurrent_network():
    rng = np.random.default_rng(0)
    net = toxicity.Network(np.zeros(0, np.uint64), np.zeros((1, toxicity.WORD)), np.zeros((4, toxicity.CHAR)), rng)
    net.p = {name: value.astype(np.float64) for name, value in net.p.items()}
    x = rng.normal(size=(5, 3, toxicity.WORD + toxicity.CHAR))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    y, share = np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss():
        p = toxicity._sigmoid(net.forward(x, mask).astype(np.float64))
        return -(share * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / share.sum()

    grads, dx = net.gradients(x, mask, y, share)
    for name in ("in_f", "in_b", "state_f", "state_b", "bias_f", "attend", "query", "out", "out_bias"):
        at = tuple(rng.integers(n) for n in net.p[name].shape)
        keep, step = net.p[name][at], 3e-3
        net.p[name][at] = keep + step
        up = loss()
        net.p[name][at] = keep - step
        down = loss()
        net.p[name][at] = keep
        assert abs((up - down) / (2 * step) - grads[name][at]) < 2e-3, name
    keep, step = x[1, 1, 2], 3e-3
    x[1, 1, 2] = keep + step
    up = loss()
    x[1, 1, 2] = keep - step
    assert abs((up - loss()) / (2 * step) - dx[1, 1, 2]) < 2e-3


def plain_toxicity(net, text):
    """The score of one text, window by window and word by word."""
    p = {name: value.astype(np.float64) for name, value in net.p.items()}
    squash = lambda v: 1 / (1 + np.exp(-v))
    (alone,) = pieces(pa.array([text]))
    words, _, grams, first = toxicity.read_words(alone)
    ends = [*first[1:].tolist(), len(grams)] if len(words) else []
    known = {int(word): i + 1 for i, word in enumerate(net.vocabulary)}
    x = []
    for word, begin, end in zip(words, first, ends):
        x.append(np.concatenate([p["word"][known.get(int(word), 0)], np.mean([p["char"][g] for g in grams[begin:end]], axis=0)]))
    starts = [0]
    while starts[-1] + toxicity.WINDOW < len(x):
        starts.append(starts[-1] + toxicity.STRIDE)
    best, size = -np.inf, toxicity.STATE
    for start in starts:
        window = x[start : start + toxicity.WINDOW]
        sides = {}
        for side, order in (("f", list(range(len(window)))), ("b", list(range(len(window)))[::-1])):
            h, sides[side] = np.zeros(size), {}
            for t in order:
                enter, back = p[f"in_{side}"] @ window[t] + p[f"bias_{side}"], p[f"state_{side}"] @ h
                keep = squash(enter[:size] + back[:size])
                reset = squash(enter[size : 2 * size] + back[size : 2 * size])
                fresh = np.tanh(enter[2 * size :] + reset * back[2 * size :])
                h = sides[side][t] = keep * h + (1 - keep) * fresh
        states = [np.concatenate([sides["f"][t], sides["b"][t]]) for t in range(len(window))]
        look = [np.exp(p["query"] @ np.tanh(p["attend"] @ h)) for h in states]
        pooled = sum((w / sum(look) * h for w, h in zip(look, states)), np.zeros(2 * size))
        best = max(best, squash(p["out"] @ pooled + p["out_bias"][0]))
    return best


def test_toxicity_is_that_of_a_plain_loop():
    rng = np.random.default_rng(3)
    vocabulary = ["you", "fool", "kind", "river", "stone", "blue", "walks", "idiot"]
    sample = [(" ".join(rng.choice(vocabulary, 12)), 0) for _ in range(20)]
    net = toxicity.train([(text, int("fool" in text)) for text, _ in sample], steps=6)
    assert isinstance(net, toxicity.Network)
    long = [" ".join(rng.choice([*vocabulary, "unseen", "wörter"], n)) for n in (1, 2, toxicity.WINDOW, toxicity.WINDOW + 1, 300)]
    texts = ["", " .,! ", "fool", *long, "fool " * 500]
    (together,) = pieces(pa.array(texts))
    assert np.allclose(net.score(together), [plain_toxicity(net, text) for text in texts], atol=1e-4)


def test_windows_cover_every_word_and_byte():
    bounds = np.array([0, 0, 5, 40, 140])
    index, row = toxicity.window_index(bounds)
    for i in range(len(bounds) - 1):
        seen = set(index[row == i].ravel().tolist()) - {-1}
        assert seen == set(range(bounds[i], bounds[i + 1]))
    (texts,) = pieces(pa.array(["", "ab", "c" * 300]))
    begin, row = langid.window_starts(texts)
    x = langid.windows(texts, np.arange(256, dtype=np.int16)[texts.data], begin, row)
    assert [int((x[row == i][:, : langid.WINDOW] > 0).sum()) for i in range(3)] == [0, 2, 300]


def test_prepared_filters_give_the_same_responses():
    samples = [("der die das und ist", "de"), ("the and of to in", "en")] * 6
    net = langid.train(samples, epochs=2)
    (texts,) = pieces(pa.array(["the und of das " * 30]))
    begin, row = langid.window_starts(texts)
    x = langid.windows(texts, net.classes[texts.data], begin, row)
    pooled = np.concatenate([np.maximum(r.max(axis=1), 0) for r in langid.responses(net, x)], axis=1)
    expected = np.log(langid._softmax(pooled @ net.out + net.out_bias))
    assert np.allclose(langid.Scorer(net).log_probabilities(x), expected, atol=1e-4)


def test_votes_are_those_of_the_nearest_vectors():
    rng = np.random.default_rng(1)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    labelled, texts = unit(rng.normal(size=(300, 8))), unit(rng.normal(size=(700, 8)))
    space = quality.Space(np.zeros(0), np.zeros(0), labelled, rng.integers(0, 2, 300).astype(np.float32), 0.5)
    got = quality.vote(space, texts)
    for i in range(0, 700, 37):
        cosine = labelled @ texts[i]
        best = np.argsort(cosine)[-quality.NEIGHBOURS :]
        weight = np.maximum(cosine[best], 0) ** quality.SHARPNESS
        assert abs(got[i] - ((weight * space.labels[best]).sum() + 0.01) / (weight.sum() + 0.02)) < 1e-6
