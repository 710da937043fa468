"""A small causal self-attention language model in numpy: training and batched scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Positions of a window, positions by which windows advance, width, hidden units, learned distributions.
CONTEXT, STRIDE, WIDTH, HIDDEN, TABLES = 32, 24, 16, 32, 12
#: Absolute discount of successor counts, and the count added to every id.
DISCOUNT, ADDED = 0.7, 0.1


@dataclass
class CorpusCounts:
    """What the corpus says about ids: smoothed frequencies and discounted successors.

    ``unigram`` covers the whole vocabulary, so every text has a probability. ``pairs`` are sorted
    keys previous * size + next with their discounted probability; ``rest`` is what each previous id
    leaves to the unigram, so the mix sums to one. Where ``pairs`` are only some of the successors,
    ``kinds`` (distinct successors of each previous id) says what all of them leave.
    """

    unigram: np.ndarray
    pairs: np.ndarray
    pair_prob: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, size: int, previous: np.ndarray, following: np.ndarray, n: np.ndarray, totals: np.ndarray, ids: np.ndarray, kinds: np.ndarray | None = None) -> CorpusCounts:
        unigram = ids + ADDED
        unigram = (unigram / unigram.sum()).astype(np.float32)
        keys = previous.astype(np.int64) * size + following
        order = np.argsort(keys)
        prob = np.maximum(n - DISCOUNT, 0.0) / np.maximum(totals[previous], 1)
        left = 1.0 - np.bincount(previous, prob, minlength=size) if kinds is None else np.where(totals > 0, DISCOUNT * kinds / np.maximum(totals, 1), 1.0)
        rest = np.maximum(left, 1e-6)
        return cls(unigram, keys[order], prob[order].astype(np.float32), rest.astype(np.float32))

    def find(self, previous: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the pairs, their places in ``pairs`` and whether they are there."""
        keys = previous.astype(np.int64) * len(self.unigram) + following
        if not len(self.pairs):
            return keys, np.zeros(keys.shape, np.int64), np.zeros(keys.shape, bool)
        # In ascending order the searches stay in the caches.
        order = np.argsort(keys, axis=None)
        ascending = keys.reshape(-1)[order]
        found = np.minimum(np.searchsorted(self.pairs, ascending), len(self.pairs) - 1)
        at, known = np.empty(keys.size, np.int64), np.empty(keys.size, bool)
        at[order], known[order] = found, self.pairs[found] == ascending
        return keys, at.reshape(keys.shape), known.reshape(keys.shape)

    def successor(self, previous: np.ndarray, following: np.ndarray) -> np.ndarray:
        _, at, known = self.find(previous, following)
        return self.mixed(previous, following, at, known)

    def mixed(self, previous: np.ndarray, following: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Probability of ``following`` by the successor counts, for pairs that ``find`` has sought."""
        base = self.rest[previous] * self.unigram[following]
        return base + np.where(known, self.pair_prob[at], np.float32(0)) if len(self.pairs) else base


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _sums_by_id(ids: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each id (size x width)."""
    found, at = np.unique(ids, return_inverse=True)
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[found] = np.stack([np.bincount(at.reshape(-1), column, len(found)) for column in rows.T], axis=1)
    return out


_CAUSAL = np.tril(np.ones((CONTEXT, CONTEXT), np.float32))
_MASK = np.where(np.tril(np.ones((CONTEXT, CONTEXT), bool)), np.float32(0), np.float32(-1e9))


class AttentionModel:
    """One attention layer whose state mixes distributions over the next id.

    The next id's probability is a sum over experts: the successor counts of the previous
    id, the unigram, and TABLES learned distributions. The weights come from the state at that
    position: embedding plus masked self-attention over the window, then one hidden layer.
    """

    def __init__(self, size: int, counts: CorpusCounts, seed: int = 5):
        rng = np.random.default_rng(seed)
        init = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.counts, self.size = counts, size
        self.w = {
            "embed": init(size, WIDTH, scale=0.3), "place": init(CONTEXT, WIDTH, scale=0.1), "q": init(WIDTH, WIDTH, scale=0.25), "k": init(WIDTH, WIDTH, scale=0.25), "v": init(WIDTH, WIDTH, scale=0.25),
            "h": init(2 * WIDTH, HIDDEN, scale=0.2), "hb": np.zeros(HIDDEN, np.float32), "g": init(HIDDEN, TABLES + 2, scale=0.2), "gb": np.array([2.0, 0.0] + [0.0] * TABLES, np.float32),
            "table": np.log(counts.unigram)[:, None] + init(size, TABLES, scale=0.3),
        }
        self.freeze()

    def freeze(self) -> None:
        """Learned distributions as probabilities; call after the weights change."""
        e = np.exp(self.w["table"] - self.w["table"].max(axis=0))
        self.table = (e / e.sum(axis=0)).astype(np.float32)

    def _state(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        x = w["embed"][inputs] + w["place"]
        q, k, v = ((x.reshape(-1, WIDTH) @ w[name]).reshape(x.shape) for name in "qkv")
        a = _softmax(q @ k.transpose(0, 2, 1) * np.float32(WIDTH**-0.5) + _MASK)
        c = np.concatenate([x, a @ v], axis=-1)
        h = np.tanh(c.reshape(-1, 2 * WIDTH) @ w["h"] + w["hb"]).reshape(*inputs.shape, HIDDEN)
        return {"x": x, "q": q, "k": k, "v": v, "a": a, "c": c, "h": h, "gate": _softmax(h @ w["g"] + w["gb"])}

    def _experts(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        two = np.stack([self.counts.successor(inputs, targets), self.counts.unigram[targets]], axis=-1)
        return np.concatenate([two, self.table[targets]], axis=-1)

    def probabilities(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Probability of each target after the inputs up to its position (windows x CONTEXT)."""
        return (self._state(inputs)["gate"] * self._experts(inputs, targets)).sum(axis=-1)

    def train(self, inputs: np.ndarray, targets: np.ndarray, epochs: int = 3, batch: int = 128, rate: float = 0.01, seed: int = 11, real: np.ndarray | None = None) -> None:
        """Adam on the mean negative log probability of windows, at their ``real`` positions; the order of windows is seeded."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, steps = 0, max(1, epochs * -(-len(inputs) // batch))
        for _ in range(epochs):
            order = rng.permutation(len(inputs))
            for at in range(0, len(order), batch):
                step += 1
                some = order[at : at + batch]
                grads = self._gradients(inputs[some], targets[some], None if real is None else real[some])
                pace = rate * min(1.0, step / 20) * (1.0 - 0.9 * step / steps)
                for name, g in grads.items():
                    m[name] += 0.1 * (g - m[name])
                    s[name] += 0.01 * (g * g - s[name])
                    self.w[name] -= (pace * m[name] / (1 - 0.9**step) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
                self.freeze()

    def _gradients(self, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray | None = None) -> dict[str, np.ndarray]:
        w, st, ex = self.w, self._state(inputs), self._experts(inputs, targets)
        flat = lambda x: x.reshape(-1, x.shape[-1])
        counted = np.ones(inputs.size, np.float32) if real is None else real.reshape(-1).astype(np.float32)
        counted = (counted / np.float32(max(counted.sum(), 1)))[:, None]
        gate, h, c, x = flat(st["gate"]), flat(st["h"]), flat(st["c"]), flat(st["x"])
        share = gate * flat(ex)  # each expert's part of the target's probability
        share /= share @ np.ones((share.shape[1], 1), share.dtype)
        d_gate = (gate - share) * counted
        out = {"g": h.T @ d_gate, "gb": d_gate.sum(axis=0)}
        part = share[:, 2:] * counted
        out["table"] = self.table * part.sum(axis=0) - _sums_by_id(targets, part, self.size)
        d_h = (d_gate @ w["g"].T) * (1 - h * h)
        out["h"], out["hb"] = c.T @ d_h, d_h.sum(axis=0)
        d_c = d_h @ w["h"].T
        d_x, d_o = d_c[:, :WIDTH].copy(), d_c[:, WIDTH:].reshape(*inputs.shape, WIDTH)
        d_a, d_v = d_o @ st["v"].transpose(0, 2, 1), st["a"].transpose(0, 2, 1) @ d_o
        d_a *= st["a"]
        d_s = (d_a - st["a"] * d_a.sum(axis=-1, keepdims=True)) * np.float32(WIDTH**-0.5)
        d_q, d_k = d_s @ st["k"], d_s.transpose(0, 2, 1) @ st["q"]
        for name, d in (("q", flat(d_q)), ("k", flat(d_k)), ("v", flat(d_v))):
            out[name] = x.T @ d
            d_x += d @ w[name].T
        out["place"] = d_x.reshape(*inputs.shape, WIDTH).sum(axis=0)
        out["embed"] = _sums_by_id(inputs, d_x, self.size)
        return out

    def _mix(self, inputs: np.ndarray, start: int) -> np.ndarray:
        """Weights of the experts, not yet divided by their sum, at the positions from ``start`` of each window."""
        w, n = self.w, len(inputs)
        x = w["embed"][inputs] + w["place"]
        qkv = x.reshape(-1, WIDTH) @ np.concatenate([w["q"] * np.float32(WIDTH**-0.5), w["k"], w["v"]], axis=1)
        qkv = qkv.reshape(n, CONTEXT, 3 * WIDTH)
        q, k = np.ascontiguousarray(qkv[:, start:, :WIDTH]), np.ascontiguousarray(qkv[:, :, WIDTH : 2 * WIDTH])
        # A column of ones beside the values sums the attention up.
        v = np.concatenate([qkv[:, :, 2 * WIDTH :], np.ones((n, CONTEXT, 1), np.float32)], axis=2)
        a = q @ k.transpose(0, 2, 1)
        np.exp(np.minimum(a, np.float32(60), out=a), out=a)
        a *= _CAUSAL[start:]
        seen = a @ v
        c = np.concatenate([x[:, start:], seen[..., :WIDTH] / seen[..., WIDTH:]], axis=2)
        h = np.tanh(c.reshape(-1, 2 * WIDTH) @ w["h"] + w["hb"])
        return np.exp(np.minimum(h @ w["g"] + w["gb"], np.float32(60))).reshape(n, CONTEXT - start, TABLES + 2)

    def score(self, ids: np.ndarray, sizes: np.ndarray, end: int, batch: int = 1024) -> np.ndarray:
        """log10 probability of each text, its end included; texts are runs of ``sizes`` ids.

        Windows overlap: each later window sees CONTEXT - STRIDE positions again as context and
        scores the next STRIDE, so every id is scored exactly once.
        """
        return self.score_parts(ids, sizes, end, batch, False)[0]

    def score_parts(self, ids: np.ndarray, sizes: np.ndarray, end: int, batch: int = 1024, rare: bool = True) -> tuple[np.ndarray, ...]:
        """``score`` without the positions whose pair is not in ``counts``, and those positions.

        Gives the sums, and for each such position its text, its pair's key, its probability as if
        the pair had no count, and the weight that the pair's probability has in it. Pairs are
        sought once a position; of a window only the positions that it scores are evaluated.
        """
        inputs, targets, first = flattened(ids, sizes, end)
        keys, at, known = self.counts.find(inputs, targets)
        successor, unigram = self.counts.mixed(inputs, targets, at, known), self.counts.unigram[targets]
        p, weight = np.empty(len(inputs), np.float32), np.empty(len(inputs), np.float32)
        owner, rank = window_ranks(sizes)
        begin, left = first[owner] + rank * STRIDE, sizes[owner] + 1 - rank * STRIDE
        for start, some in ((0, np.flatnonzero(rank == 0)), (CONTEXT - STRIDE, np.flatnonzero(rank > 0))):
            for a in range(0, len(some), batch):
                part = some[a : a + batch]
                place = begin[part][:, None] + np.arange(CONTEXT)
                real = np.arange(CONTEXT) < left[part][:, None]
                gate = self._mix(np.where(real, inputs[np.where(real, place, 0)], end), start)
                gate, to = gate[real[:, start:]], place[:, start:][real[:, start:]]
                total = gate @ np.ones(TABLES + 2, np.float32)
                learned = np.einsum("ij,ij->i", gate[:, 2:], self.table[targets[to]])
                p[to] = (gate[:, 0] * successor[to] + gate[:, 1] * unigram[to] + learned) / total
                weight[to] = gate[:, 0] / total
        logs = np.log10(np.maximum(p, 1e-30)).astype(np.float64)
        text = np.repeat(np.arange(len(sizes)), sizes + 1)
        if not rare:
            known = np.ones(len(p), bool)
        later = ~known
        return np.bincount(text, np.where(known, logs, 0.0), minlength=len(sizes)), text[later], keys[later], p[later], weight[later]


def flattened(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets of all positions of the texts, and each text's first: inputs are ``end`` and the ids, targets the ids and ``end``."""
    first = np.cumsum(sizes + 1) - sizes - 1
    targets = np.full(int((sizes + 1).sum()), end, np.int64)
    last = np.zeros(len(targets), bool)
    last[first + sizes] = True
    targets[~last] = ids
    return np.concatenate([[end], targets[:-1]])[: len(targets)], targets, first


def window_ranks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of each window and its rank in the text."""
    n = 1 + np.maximum(0, -(-(sizes + 1 - CONTEXT) // STRIDE))
    owner = np.repeat(np.arange(len(sizes)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def windows(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts: inputs, targets, the positions that each scores, and the text of each."""
    flat_inputs, flat_targets, first = flattened(ids, sizes, end)
    owner, rank = window_ranks(sizes)
    place = (rank * STRIDE)[:, None] + np.arange(CONTEXT)
    real = place < (sizes + 1)[owner][:, None]
    at = np.where(real, place + first[owner][:, None], 0)
    fresh = (rank[:, None] == 0) | (np.arange(CONTEXT) >= CONTEXT - STRIDE)
    return np.where(real, flat_inputs[at], end), np.where(real, flat_targets[at], end), real & fresh, owner
