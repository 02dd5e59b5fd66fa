import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from settleflow.llm import divergence, ranking
from settleflow.llm.divergence import partial_divergences, source_divergence
from settleflow.llm.ranking import Tile, _Best, impacts, item_tiles, rank_documents, tile_scores

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LETTER = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked_plainly(docs, items, k=10):
    words = [(i, TERM.findall(lowered(t))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for i, w in words:
            m, tf, score = 10 + 90 * len(w) * n // total, Counter(w), 0
            for t in set(TERM.findall(lowered(text))):
                if t in tf:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def some_docs(rng, count):
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "ßx9", "日本", "Zz"]
    docs = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 60))))) for i in range(count)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)]  # ties
    return docs + [(2000, None), (2001, ""), (2002, "... --"), (None, docs[3][1]), (2003, "w1 " * 300_000 + "w2")]


def test_ranking_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    docs = some_docs(rng, 120)
    items = [(i, " ".join(rng.choice([f"W{j}" for j in range(60)], 8))) for i in range(70)]
    items += [(900, docs[3][1]), (901, None), (902, ""), (903, "nothing here"), (None, "w1 ßX9"), (904, "w1 " * 50_000 + "日本")]
    table = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, _doc string, Score int").repartition(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in rank_documents(table, bench).collect()), key=repr)
    assert got == ranked_plainly(docs, items)


def test_ranking_in_several_groups_tiles_and_products(spark, monkeypatch):
    monkeypatch.setattr(ranking, "GROUP_BYTES", 600)
    rng = np.random.default_rng(2)
    docs = some_docs(rng, 60)[:-1]
    items = [(i, " ".join(rng.choice([f"w{j}" for j in range(60)], 12))) for i in range(25)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = rank_documents(table, spark.createDataFrame(items, "item_id long, text string"), k=4).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == ranked_plainly(docs, items, 4)


def test_ranking_of_empty_tables_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "b"), (5, "b")], "item_id long, text string")
    assert rank_documents(docs.limit(0), items).count() == 0
    assert rank_documents(docs, items.limit(0)).count() == 0
    rows = rank_documents(docs, items).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"]) for r in rows) == [(5, 1, 1), (5, 1, 1), (5, 2, 1), (5, 2, 1)]


def test_products_are_cut_before_a_sum_loses_a_unit(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(ranking, "TILE_TERMS", 50)
    codes = [np.unique(rng.integers(0, 400, 120)) for _ in range(40)]
    weight = rng.integers(1 << 28, 1 << 30, 400).astype(np.float64)
    row = np.repeat(np.arange(6), 90)
    code = np.concatenate([rng.choice(400, 90, replace=False) for _ in range(6)])
    impact = rng.integers(1 << 18, 1 << 20, len(code))
    tiles = item_tiles(codes, weight)
    assert [len(t.items) for t in tiles] == [32, 8]
    for tile in tiles:
        got = tile_scores(tile, row, code, impact, 6, np.full(400, -1))
        for d in range(6):
            held = dict(zip(code[row == d].tolist(), impact[row == d].tolist()))
            assert got[d].tolist() == [sum(int(weight[c]) * held[c] for c in codes[i] if c in held) for i in tile.items]
    assert impacts(np.array([3]), np.array([1 << 40]), 1 << 40, 1 << 41).tolist() == [3 * 10**9 // (3000 + 8 * (10 + 90 * (1 << 39)))]


def test_the_best_are_kept_through_cuts_and_ties(monkeypatch):
    monkeypatch.setattr(ranking, "BUFFER", 50)
    rng = np.random.default_rng(4)
    scores = rng.integers(0, 4, (400, 3))
    best = _Best(3, 5, pa.int64())
    for at in range(0, 400, 40):
        best.add(np.arange(3), scores[at : at + 40], pa.array(np.arange(400)[::-1][at : at + 40]))
    table = best.cut().to_pylist()
    for item in range(3):
        expected = sorted((-s, 399 - i) for i, s in enumerate(scores[:, item].tolist()) if s > 0)[:5]
        assert [(-r["score"], r["doc"]) for r in table if r["item"] == item] == expected
    assert Tile(np.zeros(0), np.zeros(0), np.zeros((0, 0))).weights.max(initial=0) == 0


def diverging_plainly(docs, least, top):
    words = [(lang or "", source or "", LETTER.findall(lowered(text))) for lang, source, text in docs]
    out = []
    for lang in {x[0] for x in words}:
        mine = [x for x in words if x[0] == lang]
        seen = Counter(t for _, _, w in mine for t in set(w))
        kept = sorted(t for t, n in seen.items() if n >= least)
        whole = Counter(t for _, _, w in mine for t in w)
        counts = {s: Counter(t for _, x, w in mine if x == s for t in w) for s in {x[1] for x in mine}}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}  # noqa: B023, E731
        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = sorted((-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o.encode(), o) for o in counts if o != s)
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(pairs, 1)]
            more = sorted((q[t] - shares[s][t], t.encode(), t) for t in kept if counts[s][t] and shares[s][t] > q[t])
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(more[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("groups, terms", [(64, 2048), (3, 4)])
def test_divergence_matches_brute_force(spark, monkeypatch, groups, terms):
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "TERMS", terms)
    rng = np.random.default_rng(5)
    vocabulary = [f"a{chr(97 + i)}" for i in range(20)] + ["é", "ß", "日本", "É"]
    docs = []
    for lang, sources in (("en", 8), ("de", 2), ("one", 1), (None, 4), ("", 2)):
        for _ in range(60):
            source = f"s{rng.integers(0, sources)}" if lang != "" else [None, ""][int(rng.integers(0, 2))]
            text = "1".join(rng.choice(vocabulary, int(rng.integers(0, 12)), p=np.arange(1, 25) / 300))
            docs.append((lang, source, text.title() if lang == "de" else text))
    docs += docs[:15] + [("en", "only null", None), ("en", "empty", ""), ("fr", "a", "x"), ("fr", "b", "x y"), ("en", "s1", "aa " * 400_000)]
    table = spark.createDataFrame([(i, *d, 1) for i, d in enumerate(docs)], "doc_id long, lang string, source string, text string, _term int").repartition(6)
    got = source_divergence(table, least=9, top=5)
    assert sorted(tuple(r) for r in got.collect()) == diverging_plainly(docs, 9, 5)


def test_divergence_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, source string, text string")
    assert source_divergence(empty).collect() == []


def test_a_cell_counts_terms_neither_group_has():
    group, term = np.array([0, 1, -2, 0]), np.array([-1, -1, 3, 2])
    share = np.array([10, 25, 0, 100])
    (found,) = partial_divergences(group, term, share, 0, 0)
    assert (found[0], found[1].tolist(), found[2].tolist()) == (0, [1], [15 + 15 + 75])
