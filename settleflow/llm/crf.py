"""A linear-chain conditional random field over three tags in numpy: training, and decoding in blocks."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: Score of what must not happen: a secret that goes on without having begun.
NEVER = -1e9


class Field(NamedTuple):
    """Weights of hashed features (feature, tag), of a tag after a tag, and of a tag at the start."""

    weights: np.ndarray
    after: np.ndarray
    start: np.ndarray


def _allowed(after: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    after, start = after.copy(), start.copy()
    after[OUTSIDE, INSIDE] = start[INSIDE] = NEVER
    return after, start


def _add(scores: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of a sum of exponentials."""
    top = scores.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(scores - top).sum(axis=axis))


def likelihood(emit: np.ndarray, tags: np.ndarray, length: np.ndarray, after: np.ndarray, start: np.ndarray):
    """Of padded sequences (sequence, place, tag): the log likelihood and its gradients by emissions, ``after`` and ``start``.

    Forward and backward sums over all sequences at once; a place behind the end of a sequence counts for nothing.
    """
    count, most, _ = emit.shape
    forward, backward = np.empty_like(emit), np.zeros_like(emit)
    real = np.arange(most)[None, :] < length[:, None]
    forward[:, 0] = start + emit[:, 0]
    for t in range(1, most):
        forward[:, t] = _add(forward[:, t - 1, :, None] + after, 1) + emit[:, t]
    for t in range(most - 2, -1, -1):
        onward = _add(after + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(real[:, t + 1, None], onward, 0)
    total = _add(forward[np.arange(count), length - 1], 1)
    expected = np.exp(np.where(real[:, :, None], forward + backward - total[:, None, None], -np.inf))
    gold = (tags[:, :, None] == np.arange(3)) * real[:, :, None]
    both = forward[:, :-1, :, None] + after + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
    both = np.exp(np.where(real[:, 1:, None, None], both, -np.inf)).sum(axis=(0, 1))
    pair = np.zeros((3, 3))
    np.add.at(pair, (tags[:, :-1][real[:, 1:]], tags[:, 1:][real[:, 1:]]), 1)
    score = (emit * gold).sum() + (after * pair).sum() + start[tags[:, 0]].sum()
    return score - total.sum(), gold - expected, pair - both, gold[:, 0].sum(axis=0) - expected[:, 0].sum(axis=0)


def train(
    features: list[np.ndarray],
    joined: list[np.ndarray],
    tags: list[np.ndarray],
    size: int,
    loose: list[int],
    steps: int = 80,
    rate: float = 0.15,
    decay: float = 1e-4,
    seed: int = 7,
) -> Field:
    """Fit by gradient steps with momentum and running scales on all sequences together.

    ``features`` are hashed ids (place, kind) of every sequence, ``joined`` says which places may be inside. In every step each place forgets the kinds in ``loose`` (feature
    0 takes their place) three times in ten, so that what a secret looks like counts without its neighbours too.
    """
    rng = np.random.default_rng(seed)
    field = Field(np.zeros((size, 3)), np.zeros((3, 3)), np.zeros(3))
    if not features:
        return Field(field.weights, *_allowed(field.after, field.start))
    length = np.array([len(x) for x in features])
    ids, kinds = np.concatenate(features).astype(np.int64), features[0].shape[1]
    apart = ~np.concatenate(joined)
    real = np.arange(int(length.max()))[None, :] < length[:, None]
    gold = np.zeros(real.shape, np.int64)
    gold[real] = np.concatenate(tags)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in field]
    for step in range(1, steps + 1):
        seen = ids.copy()
        forgotten = np.flatnonzero(rng.random(len(ids)) < 0.3)
        seen[forgotten[:, None], loose] = 0
        after, start = _allowed(field.after, field.start)
        at_place = sum(np.take(field.weights, seen[:, kind], axis=0) for kind in range(kinds))
        at_place[apart, INSIDE] = NEVER
        emit = np.zeros((*real.shape, 3))
        emit[real] = at_place
        _, by_emit, by_after, by_start = likelihood(emit, gold, length, after, start)
        by_weight, by_place = np.empty_like(field.weights), by_emit[real]
        for tag in range(3):
            by_weight[:, tag] = np.bincount(seen.ravel(), weights=np.repeat(by_place[:, tag], kinds), minlength=size)
        scale = 1 / len(features)
        for p, gradient, (m, v) in zip(field, (by_weight, by_after, by_start), moments):
            gradient = gradient * scale - decay * p
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient * gradient - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-4)
    return Field(field.weights.astype(np.float32), *_allowed(field.after, field.start))


def viterbi(emit: np.ndarray, first: np.ndarray, after: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best tags of sequences that lie one behind the other; ``first`` marks the first place of each.

    The chain is cut into blocks of about as many places as there are blocks. All blocks together, place by place, get the best
    scores from every tag they may begin with; the blocks are then passed through one after the other, and walked back
    again. The result is that of one walk over every sequence: a first place takes ``start`` whatever came before.
    """
    places = len(emit)
    if not places:
        return np.zeros(0, np.int8)
    width = max(8, int(np.sqrt(places)))
    blocks = -(-places // width)
    # By place in the block, then tag, then block: every step below is on whole rows of blocks.
    padded = np.zeros((blocks * width, 3))
    padded[:places] = emit
    emits = np.ascontiguousarray(padded.reshape(blocks, width, 3).transpose(1, 2, 0))
    starts = np.zeros(blocks * width, bool)
    starts[:places] = first
    starts = starts.reshape(blocks, width).T
    real = blocks - 1, places - (blocks - 1) * width  # the last block is filled up by places that keep the tag
    keep = np.where(np.eye(3, dtype=bool), 0.0, NEVER)

    def steps(t: int) -> np.ndarray:
        """Scores (tag before, tag, block) of place ``t``."""
        found = after[:, :, None] + emits[t]
        here = np.flatnonzero(starts[t])
        found[:, :, here] = start[:, None] + emits[t][:, here]
        if t >= real[1]:
            found[:, :, real[0]] = keep
        return found

    through = np.repeat(np.where(np.eye(3, dtype=bool), 0.0, 2 * NEVER * width)[:, :, None], blocks, axis=2)
    for t in range(width):
        options = through[:, :, None, :] + steps(t)
        through = np.maximum(np.maximum(options[:, 0], options[:, 1]), options[:, 2])
    begin, now = np.empty((3, blocks)), np.zeros(3)
    for b in range(blocks):
        begin[:, b] = now
        now = (now[:, None] + through[:, :, b]).max(axis=0)
        now -= now.max()
    back, best = np.empty((width, 3, blocks), np.int8), begin
    for t in range(width):
        options = best[:, None, :] + steps(t)
        second = options[1] > options[0]
        best = np.where(second, options[1], options[0])
        third = options[2] > best
        best = np.where(third, options[2], best)
        back[t] = np.where(third, 2, second)
    block = np.arange(blocks)
    origin = np.repeat(np.arange(3)[:, None], blocks, axis=1)
    for t in range(width - 1, -1, -1):
        origin = back[t][origin, block]
    last = np.empty(blocks, np.int8)
    tag = int(best[:, -1].argmax())
    for b in range(blocks - 1, -1, -1):
        last[b] = tag
        tag = int(origin[tag, b])
    out = np.empty((width, blocks), np.int8)
    at = last
    for t in range(width - 1, -1, -1):
        out[t] = at
        at = back[t][at, block]
    return out.T.reshape(-1)[:places]
