"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax, carried state.

Words are known by their place in the order of frequency; the output first chooses a class of WIDTH
successive words, then a word of that class, so a token costs two small softmaxes instead of one over
all words. Documents run side by side, longest first; a window of STEPS tokens is run at a time and its last
state begins the next one, so a document's probability is that of all its tokens in a row. For training, documents
are cut into parts of PART tokens, each beginning with the token before it: as many of about one length run side by side as make
an update, and the longest documents don't leave the others' lanes empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HIDDEN, WIDTH, STEPS = 16, 64, 32
TOGETHER = 16_384                             # tokens whose softmaxes are held at once
RATE, PART, LANES = 0.02, 256, 224            # an update is made from LANES parts' windows
LEAST = 1e-20                                 # weight of a row of scores below which it is shifted by itself
END, UNKNOWN = 0, 1                           # ids; words follow, fewer than 2^16 in all

Parameters = dict[str, np.ndarray]


def start(counts: np.ndarray, seed: int = 0) -> Parameters:
    """Parameters that give each id its share of ``counts`` whatever the state is; counts must not rise beyond the first two."""
    rng, n = np.random.default_rng(seed), -(-len(counts) // WIDTH)
    share = np.zeros(n * WIDTH)
    share[:len(counts)] = (counts + 0.5) / (counts + 0.5).sum()
    by_class = share.reshape(n, WIDTH)
    with np.errstate(divide="ignore"):
        word = np.log(by_class) - np.log(by_class.sum(axis=1, keepdims=True))
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {"embed": small(n * WIDTH, HIDDEN), "w": small(HIDDEN, 3 * HIDDEN) * 3, "u": small(HIDDEN, 3 * HIDDEN) * 3, "b": np.zeros(3 * HIDDEN, np.float32),
            "cw": small(HIDDEN, n), "cb": np.log(by_class.sum(axis=1)).astype(np.float32),
            "ow": small(n, HIDDEN, WIDTH) * 0.1, "ob": np.maximum(word, -1e4).astype(np.float32)}


def _softmax(states: np.ndarray, w: np.ndarray, targets: np.ndarray, chances: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of each row's target under the scores ``states @ w``, and the probabilities of all less one at the target.

    The last state is always 1 and the last weights are the biases. The others lie between -1 and 1, so the weights bound the scores: all
    rows are shifted by that bound at once. Rows that it leaves with hardly any weight are shifted by their own largest score.
    """
    rows, ones, shifted = np.arange(len(targets)), np.ones(w.shape[1], w.dtype), w.copy()
    shifted[-1] -= (w[-1] + np.abs(w[:-1]).sum(axis=0)).max()
    x = states @ shifted
    wanted = x[rows, targets]
    np.exp(x, out=x)
    total = x @ ones
    low = np.flatnonzero(total < LEAST)
    if len(low):
        own = states[low] @ w
        own -= own.max(axis=1, keepdims=True)
        wanted[low] = own[np.arange(len(low)), targets[low]]
        x[low] = np.exp(own, out=own)
        total[low] = own @ ones
    logp = wanted - np.log(total)
    if not chances:
        return logp, None
    x *= (1 / total)[:, None]
    x[rows, targets] -= 1
    return logp, x


def _by_gate(m: np.ndarray) -> np.ndarray:
    """Rows that hold three gates one after the other, as three contiguous blocks of rows."""
    return np.ascontiguousarray(m.reshape(len(m), 3, HIDDEN).swapaxes(0, 1))


def _gates(p: Parameters) -> tuple[np.ndarray, np.ndarray]:
    """What each id adds to the gates, and the states' weights, by gate. Those of the two sigmoids are negated, as their exponential takes them."""
    table, u = _by_gate(p["embed"] @ p["w"] + p["b"]), _by_gate(p["u"])
    np.negative(table[:2], out=table[:2])
    np.negative(u[:2], out=u[:2])
    return table, u


def _run(gates: tuple[np.ndarray, np.ndarray], inputs: np.ndarray, alive: np.ndarray, h: np.ndarray, keep: list | None) -> np.ndarray:
    """States after each step of a window (steps x lanes). alive: the lanes, from the first, that still run at each step.

    Sigmoid and tanh are made of exponentials, which are twice as fast; one beyond the largest number leaves its limit.
    """
    table, u = gates
    states = np.zeros((len(inputs), *h.shape), np.float32)
    with np.errstate(over="ignore"):
        for t, a in enumerate(alive.tolist()):
            before, x = h[:a], table.take(inputs[t, :a], axis=1)
            hu = np.matmul(before, u)
            both = x[:2]
            both += hu[:2]
            np.exp(both, out=both)
            both += 1
            z, r = np.reciprocal(both, out=both)
            n = r * hu[2]
            n += x[2]
            n *= -2
            np.exp(n, out=n)
            n += 1
            np.divide(2, n, out=n)
            n -= 1
            h = states[t]                         # lanes that ended before are not looked at again
            new = np.subtract(before, n, out=h[:a])
            new *= z
            new += n
            if keep is not None:
                keep.append((before, z, r, n, hu[2]))
    return states


def _outputs(p: Parameters, states: np.ndarray, targets: np.ndarray, grads: Parameters | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of each target given its state; with grads, also adds to them and returns the loss's derivative by state."""
    train = grads is not None
    kind = (targets // WIDTH).astype(np.uint16)
    order = np.argsort(kind, kind="stable")   # by class, so that a class's rows are one block
    states, kind, word = np.concatenate([states[order], np.ones((len(order), 1), states.dtype)], axis=1), kind[order], targets[order] % WIDTH
    logp, dc = _softmax(states, np.concatenate([p["cw"], p["cb"][None]]), kind, train)
    d = None
    if train:
        sums = states.T @ dc
        grads["cw"] += sums[:-1]
        grads["cb"] += sums[-1]
        d = dc @ p["cw"].T
    edges = np.searchsorted(kind, np.arange(len(p["ob"]) + 1))
    for k in np.flatnonzero(np.diff(edges)):
        own = slice(edges[k], edges[k + 1])
        by_word, dw = _softmax(states[own], np.concatenate([p["ow"][k], p["ob"][k][None]]), word[own], train)
        logp[own] += by_word
        if train:
            sums = states[own].T @ dw
            grads["ow"][k] += sums[:-1]
            grads["ob"][k] += sums[-1]
            d[own] += dw @ p["ow"][k].T
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return logp[place], None if d is None else d[place]


def _windows(documents: list[np.ndarray], before: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Inputs and targets (steps x lanes) and the lanes alive, window by window. Documents come longest first; ``before`` is what stands before each (END)."""
    lengths = np.array([len(d) for d in documents])
    for lo in range(0, int(lengths[0]), STEPS):
        lanes = int((lengths > lo).sum())
        steps = min(STEPS, int(lengths[0]) - lo)
        targets, inputs = np.zeros((steps, lanes), np.int32), np.zeros((steps, lanes), np.int32)
        for i in range(lanes):
            own = documents[i][max(lo - 1, 0):lo + steps]
            if lo == 0:
                targets[:len(own), i], inputs[1:len(own), i] = own, own[:-1]
            else:
                targets[:len(own) - 1, i], inputs[:len(own) - 1, i] = own[1:], own[:-1]
        if lo == 0 and before is not None:
            inputs[0] = before
        yield inputs, targets, (lengths[:lanes] > lo + np.arange(steps)[:, None]).sum(axis=1)


def parts_of(documents: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Documents cut into parts of PART tokens, longest parts first, and the token before each."""
    found = [(d[i:i + PART], d[i - 1] if i else END) for d in documents for i in range(0, len(d), PART)]
    found.sort(key=lambda x: -len(x[0]))
    return [x for x, _ in found], np.array([b for _, b in found], np.int32)


def log_probabilities(p: Parameters, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document's ids."""
    if not documents:
        return np.zeros(0)
    order = np.argsort([-len(d) for d in documents], kind="stable")
    out, h = np.zeros(len(documents)), np.zeros((len(documents), HIDDEN), np.float32)
    gates = _gates(p)
    held, size = [], 0                        # windows of the few longest documents are small: their outputs wait for others

    def flush() -> None:
        found, wanted, lane = (np.concatenate(x) for x in zip(*held))
        logp = np.concatenate([_outputs(p, found[i:i + TOGETHER], wanted[i:i + TOGETHER], None)[0] for i in range(0, len(wanted), TOGETHER)])
        out[:] += np.bincount(lane, logp, len(out))
        held.clear()

    for inputs, targets, alive in _windows([documents[i] for i in order]):
        lanes = inputs.shape[1]
        states = _run(gates, inputs, alive, h[:lanes], None)
        on = np.arange(lanes) < alive[:, None]
        held.append((states[on], targets[on], np.broadcast_to(np.arange(lanes), on.shape)[on]))
        size += int(on.sum())
        if size >= TOGETHER:
            flush()
            size = 0
        h = states[-1]                        # lanes that go on have run every step
    if held:
        flush()
    result = np.empty(len(documents))
    result[order] = out
    return result


class Trainer:
    """Adam on the mean gradient of as many tokens as LANES full windows have at least; ``finish`` takes in what is left."""

    def __init__(self, parameters: Parameters) -> None:
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.grads, self.tokens, self.updates = {k: np.zeros_like(v) for k, v in self.p.items()}, 0, 0
        self.mean, self.square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))

    def learn(self, documents: list[np.ndarray]) -> None:
        parts, before = parts_of(documents)
        for lo in range(0, len(parts), LANES):
            some = parts[lo:lo + LANES]
            h = np.zeros((len(some), HIDDEN), np.float32)
            for inputs, targets, alive in _windows(some, before[lo:lo + LANES]):
                h = self._window(inputs, targets, alive, h[:inputs.shape[1]])

    def finish(self) -> None:
        if self.tokens:
            self._update()

    def _window(self, inputs: np.ndarray, targets: np.ndarray, alive: np.ndarray, h: np.ndarray) -> np.ndarray:
        p, g, kept = self.p, self.grads, []
        states = _run(_gates(p), inputs, alive, h, kept)
        on = np.arange(inputs.shape[1]) < alive[:, None]
        d_states = np.zeros_like(states)
        at = np.flatnonzero(on)
        d_states.reshape(-1, HIDDEN)[at] = _outputs(p, states.reshape(-1, HIDDEN)[at], targets.ravel()[at], g)[1]
        back, back_u = np.zeros_like(h), _by_gate(p["u"]).swapaxes(1, 2)
        d_x, d_h = np.zeros((3, *states.shape), np.float32), np.zeros_like(states)    # by what a gate gets in all, and its last by what the state adds
        for t in range(len(alive) - 1, -1, -1):
            a, (before, z, r, n, hn) = alive[t], kept[t]
            d, other = d_states[t, :a], 1 - z
            d += back[:a]
            dz, dr, dn = d_x[:, t, :a]
            np.multiply(n, n, out=dn)
            np.subtract(1, dn, out=dn)
            dn *= other
            dn *= d
            np.subtract(before, n, out=dz)
            dz *= z
            dz *= other
            dz *= d
            np.subtract(1, r, out=dr)
            dr *= r
            dr *= hn
            dr *= dn
            part = np.multiply(dn, r, out=d_h[t, :a])
            rest = np.multiply(d, z, out=back[:a])
            rest += dz @ back_u[0]
            rest += dr @ back_u[1]
            rest += part @ back_u[2]
        earlier = np.concatenate([h[None], states[:-1]]).reshape(-1, HIDDEN).T
        g["u"] += np.concatenate([earlier @ x.reshape(-1, HIDDEN) for x in (d_x[0], d_x[1], d_h)], axis=1)
        # Summed by input id first: the sums give the other gradients.
        used = inputs.ravel()[at].astype(np.uint16)
        order = np.argsort(used, kind="stable")
        by_id = np.zeros((len(p["embed"]), 3 * HIDDEN), np.float32)
        if len(used):
            rows = np.concatenate([x.reshape(-1, HIDDEN).take(at[order], axis=0) for x in d_x], axis=1)
            begin = np.flatnonzero(np.concatenate([[True], np.diff(used[order]) > 0]))
            by_id[used[order][begin]] = np.add.reduceat(rows, begin, axis=0)
        g["b"] += by_id.sum(axis=0)
        g["w"] += p["embed"].T @ by_id
        g["embed"] += by_id @ p["w"].T
        self.tokens += int(on.sum())
        if self.tokens >= LANES * STEPS // 2:
            self._update()
        return states[-1]

    def _update(self) -> None:
        self.updates += 1
        for k, g in self.grads.items():
            g /= self.tokens
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            step = self.mean[k] / (1 - 0.9 ** self.updates) / (np.sqrt(self.square[k] / (1 - 0.99 ** self.updates)) + 1e-6)
            self.p[k] -= np.float32(RATE) * step
            g[:] = 0
        self.tokens = 0


def flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflat(like: Parameters, values: np.ndarray) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at:at + like[k].size].astype(np.float32).reshape(like[k].shape)
        at += like[k].size
    return out
