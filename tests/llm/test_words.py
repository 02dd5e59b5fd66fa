import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from settleflow.llm.substring import anchors, levels
from settleflow.llm.words import Runs, hashed, pieces, sequence_keys, shingles

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b\x1cß", max_size=30)), max_size=8)


def words_of(text):
    return (text or "").encode().split()


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_runs_between_ascii_space(texts, limit):
    seen, rows = {}, 0
    for part in pieces(pa.array(texts, pa.string()), limit):
        for lower in (False, True):
            words, bounds = hashed(part, lower)
            for i in range(len(bounds) - 1):
                expected = words_of(texts[part.first + i])
                assert bounds[i + 1] - bounds[i] == len(expected)
                for word, value in zip(expected, words[bounds[i] : bounds[i + 1]].tolist()):
                    key = word.lower() if lower else word
                    assert seen.setdefault(key, value) == value
        rows += len(part.offsets) - 1
    assert rows == len(texts)
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingles_are_distinct_runs_of_five(texts):
    seen = {}
    for part in pieces(pa.array(texts, pa.string())):
        words, bounds = hashed(part, lower=True)
        values, of = shingles(words, bounds, 5)
        for i in range(len(of) - 1):
            w = [x.lower() for x in words_of(texts[part.first + i])]
            expected = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
            assert of[i + 1] - of[i] == len(expected)
            seen.setdefault(frozenset(expected), set()).add(frozenset(values[of[i] : of[i + 1]].tolist()))
    assert all(len(found) == 1 for found in seen.values())


def test_a_slice_of_a_column_is_read_from_its_start():
    column = pa.array(["zero", "one two", None, "three"]).slice(1)
    (part,) = pieces(column)
    words, bounds = hashed(part, lower=False)
    assert bounds.tolist() == [0, 2, 2, 3]


def test_every_long_window_has_an_anchor_that_depends_on_its_words_only():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    one = np.concatenate([rng.integers(0, 1 << 60, 13).astype(np.uint64), shared])
    two = np.concatenate([shared, rng.integers(0, 1 << 60, 9).astype(np.uint64)])
    found = []
    for words, start in ((one, 13), (two, 0)):
        places, of_window, has = anchors(words, np.array([0, len(words)]), 18, 35)
        assert has.sum() == len(words) - 34
        assert set(of_window[has].tolist()) <= set(places.tolist())
        found.append(of_window[start : start + 6].tolist())
    assert found[0] == found[1]
    assert len(Runs(one).of(np.arange(3), 35)) == 3


def test_lengths_double_up_to_the_target():
    assert levels(35) == [18, 35]
    assert levels(100) == [25, 50, 100]
    assert levels(4) == [2, 4]
    for length in range(2, 300):
        steps = levels(length)
        assert steps[-1] == length and len(steps) > 1
        assert all(a < b <= 2 * a for a, b in zip(steps, steps[1:]))


def alternating(rounds, one, two):
    """Letters or words in Thue-Morse order, and the same with both exchanged."""
    order = [bin(i).count("1") % 2 for i in range(1 << rounds)]
    return [one if x == 0 else two for x in order], [two if x == 0 else one for x in order]


def test_regular_arrangements_do_not_collide():
    for rounds in range(2, 14):
        a, b = ("".join(x) for x in alternating(rounds, "a", "b"))
        (part,) = pieces(pa.array([a, b]))
        for seed in (0, 1):
            words, _ = hashed(part, lower=True, seed=seed)
            assert words[0] != words[1]
        c, d = (" ".join(x) for x in alternating(rounds, "one", "two"))
        (part,) = pieces(pa.array([c, d]))
        words, bounds = hashed(part, lower=True)
        runs = Runs(words).of(bounds[:-1], 1 << rounds)
        assert runs[0] != runs[1]
        for shift in (8, 20, 40):  # nor in some of their bits, of which ranges and filters are made
            assert runs[0] >> np.uint64(shift) != runs[1] >> np.uint64(shift)
    # Every arrangement of two letters, and of two words.
    (part,) = pieces(pa.array([format(i, "016b") for i in range(1 << 16)]))
    assert len(np.unique(hashed(part, lower=False)[0])) == 1 << 16
    words, bounds = hashed(next(pieces(pa.array([" ".join(format(i, "012b")) for i in range(1 << 12)]))), lower=False)
    assert len(np.unique(Runs(words).of(bounds[:-1], 12))) == 1 << 12


def test_words_of_every_length_differ_and_seeds_are_independent():
    texts = [chr(97 + n % 26) * n for n in range(1, 80)] + ["a" * n for n in range(1, 80)] + ["a" * n + "\0" for n in range(40)]
    (part,) = pieces(pa.array(texts))
    one, two = (hashed(part, lower=False, seed=seed)[0] for seed in (0, 1))
    assert len(np.unique(one)) == len(set(texts)) == len(np.unique(two))
    assert not set(one.tolist()) & set(two.tolist())


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_sequence_keys_are_equal_for_equal_words_only(texts, limit):
    seen = {}
    for part in pieces(pa.array(texts, pa.string()), limit):
        keys = sequence_keys(part, lower=True).to_pylist()
        for i, key in enumerate(keys):
            words = tuple(w.lower() for w in words_of(texts[part.first + i]))
            assert (key is None) == (not words)
            assert seen.setdefault(words, key) == key
    assert len(set(seen.values())) == len(seen)
