"""A gated recurrent language model with a class-factored softmax, in numpy.

Symbols are grouped into classes of neighbouring numbers. The model predicts the class
of the next symbol and the symbol within its class. Training is truncated
backpropagation over windows of parallel streams; states are carried from window to
window and reset where a text begins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 24


@dataclass(frozen=True)
class Shape:
    """Number of symbols and the first symbol of each class (classes are runs)."""

    symbols: int
    class_starts: tuple[int, ...]

    @property
    def class_ends(self) -> tuple[int, ...]:
        return (*self.class_starts[1:], self.symbols)

    def class_of(self) -> np.ndarray:
        return np.searchsorted(np.array(self.class_starts), np.arange(self.symbols), side="right") - 1

    def sizes(self) -> list[tuple[str, tuple[int, ...]]]:
        h, c = HIDDEN, len(self.class_starts)
        return [
            ("input", (self.symbols, 3 * h)),
            ("gates", (h, 2 * h)),
            ("state", (h, h)),
            ("classes", (h, c)),
            ("class_bias", (c,)),
            ("words", (self.symbols, h)),
            ("word_bias", (self.symbols,)),
        ]


def unpack(vector: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, size in shape.sizes():
        n = int(np.prod(size))
        out[name] = vector[at : at + n].reshape(size)
        at += n
    return out


def initial(shape: Shape, counts: np.ndarray, seed: int = 11) -> np.ndarray:
    """Parameters that start from the symbols' frequencies."""
    rng = np.random.default_rng(seed)
    vector = np.zeros(sum(int(np.prod(s)) for _, s in shape.sizes()), np.float32)
    p = unpack(vector, shape)
    p["input"][:] = rng.normal(0, 0.1, p["input"].shape)
    p["gates"][:] = rng.normal(0, 1 / np.sqrt(HIDDEN), p["gates"].shape)
    p["state"][:] = rng.normal(0, 1 / np.sqrt(HIDDEN), p["state"].shape)
    weights = counts + 0.5
    p["word_bias"][:] = np.log(weights)
    p["class_bias"][:] = np.log(np.add.reduceat(weights, np.array(shape.class_starts)))
    return vector


class Room:
    """Arrays that are used again from window to window: fresh memory would cost more than the work in it."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def array(self, name: str, size: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        n = int(np.prod(size))
        if name not in self.held or self.held[name].size < n or self.held[name].dtype != dtype:
            self.held[name] = np.empty(n, dtype)
        return self.held[name][:n].reshape(size)


def _weights(p: dict[str, np.ndarray]) -> np.ndarray:
    """Weights of the last state: three square blocks, for the gates z and r and the new state."""
    return np.stack([p["gates"][:, :HIDDEN], p["gates"][:, HIDDEN:], p["state"]])


def _inputs(p: dict[str, np.ndarray], symbols: np.ndarray, room: Room) -> np.ndarray:
    """What the symbols add to z, r and the new state: three contiguous blocks, a row for each symbol."""
    table = p["input"].reshape(-1, HIDDEN)
    x = room.array("x", (3, len(symbols), HIDDEN), table.dtype)
    # With mode="raise" take would copy once more.
    return table.take(3 * symbols + np.arange(3)[:, None], axis=0, out=x, mode="clip")


def _class_logits(p: dict[str, np.ndarray], hs: np.ndarray, room: Room) -> np.ndarray:
    """A column of class logits for each state."""
    x = np.matmul(p["classes"].T, hs.T, out=room.array("logits", (p["classes"].shape[1], len(hs)), hs.dtype))
    x += p["class_bias"][:, None]
    return x


def _step(w: np.ndarray, x: np.ndarray, h: np.ndarray, gates: np.ndarray, u: np.ndarray, n: np.ndarray, after: np.ndarray) -> None:
    """The states `after` the symbols of `x`; fills the last four arrays."""
    half = np.float32(0.5)
    np.matmul(h, w[:2], out=gates)
    gates += x[:2]
    gates *= half
    np.tanh(gates, out=gates)
    gates *= half
    gates += half
    z, r = gates
    np.matmul(h, w[2], out=u)
    np.multiply(r, u, out=n)
    n += x[2]
    np.tanh(n, out=n)
    np.subtract(h, n, out=after)
    after *= z
    after += n


def _softmax(x: np.ndarray, weight: float) -> np.ndarray:
    """Softmax of each column times `weight`; changes x in place."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x *= x.dtype.type(weight) / x.sum(axis=0)
    return x


def _log_softmax_at(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Log of the softmax of each column at one place of the flat array; changes x."""
    x -= x.max(axis=0)
    at = x.ravel().take(places)
    return at - np.log(np.exp(x, out=x).sum(axis=0))


def _by_class(shape: Shape, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, slice]]]:
    """The order of the targets by class; the places of the ordered targets in the flat
    logits of all classes and in those of their class, a column for each target; and for
    each class of several symbols its first and last symbol and its part of that order."""
    classes = shape.class_of().astype(np.int16)[targets]
    order = np.argsort(classes, kind="stable")
    counts = np.bincount(classes, minlength=len(shape.class_starts))
    ends = np.cumsum(counts)
    classes, targets = classes[order], targets[order]
    column = np.arange(len(targets))
    among_classes = classes * np.int64(len(targets)) + column
    within = (targets - np.array(shape.class_starts)[classes]) * counts[classes] + column - (ends - counts)[classes]
    parts = zip(shape.class_starts, shape.class_ends, (ends - counts).tolist(), ends.tolist())
    return order, among_classes, within, [(b, e, slice(i, j)) for b, e, i, j in parts if e - b > 1 and j > i]


def log_likelihood(
    p: dict[str, np.ndarray], shape: Shape, h: np.ndarray, targets: np.ndarray, room: Room | None = None
) -> np.ndarray:
    """Natural log of the probability of each target after its state."""
    room = room or Room()
    order, among_classes, within, parts = _by_class(shape, targets)
    h = h.take(order, axis=0, out=room.array("by_class", h.shape, h.dtype), mode="clip")
    score = _log_softmax_at(_class_logits(p, h, room), among_classes)
    for begin, end, at in parts:
        logits = p["words"][begin:end] @ h[at].T
        logits += p["word_bias"][begin:end, None]
        score[at] += _log_softmax_at(logits, within[at])
    out = np.empty_like(score)
    out[order] = score
    return out


def text_scores(p: dict[str, np.ndarray], shape: Shape, texts: list[np.ndarray], start: int, at_once: int = 1024) -> np.ndarray:
    """Natural log-likelihood of each whole symbol sequence.

    Texts of like length run side by side; the states of one window of steps are the
    start of the next, so a text of any length is scored from its first symbol to its last.
    """
    totals = np.zeros(len(texts))
    order = np.argsort([-len(t) for t in texts], kind="stable")
    w, room = _weights(p), Room()
    for begin in range(0, len(order), at_once):
        rows = order[begin : begin + at_once]
        lengths = np.array([len(texts[i]) for i in rows])
        # Each text with the start before it.
        given = np.concatenate([part for i in rows for part in ([start], texts[i])], dtype=np.int32, casting="unsafe")
        firsts = np.cumsum(lengths + 1) - lengths - 1
        h = np.zeros((len(rows), HIDDEN), p["state"].dtype)
        at = 0
        while at < lengths[0]:
            live = int((lengths > at).sum())
            steps = min(int(lengths[0]) - at, max(16, 16_384 // live))
            counts = [int((lengths[:live] > at + step).sum()) for step in range(steps)]
            places = np.concatenate([firsts[:now] + (at + step) for step, now in enumerate(counts)])
            x = _inputs(p, given[places], room)
            states = room.array("states", x[0].shape, x.dtype)
            gates, u, n = (np.empty((k, live, HIDDEN), x.dtype) for k in (2, 1, 1))
            end = 0
            for now in counts:
                part = slice(end, end + now)
                _step(w, x[:, part], h[:now], gates[:, :now], u[0, :now], n[0, :now], states[part])
                h, end = states[part], end + now
            h = h.copy()
            score = log_likelihood(p, shape, states, given[places + 1], room)
            owners = np.concatenate([rows[:now] for now in counts])
            totals += np.bincount(owners, score, len(totals))
            at += steps
    return totals


def streams(texts: list[np.ndarray], start: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and first-of-text marks of all texts, cut into parallel streams."""
    targets = np.concatenate(texts).astype(np.int32)
    first = np.zeros(len(targets), bool)
    first[np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))] = True
    inputs = np.concatenate((np.array([start], np.int32), targets[:-1]))
    inputs[first] = start
    count = max(1, min(count, len(targets) // 64))
    long = len(targets) // count
    cut = lambda x: x[: count * long].reshape(count, long)
    rest = slice(count * long, None)
    if len(targets) > count * long:  # the remainder lengthens the last stream
        pad = long + len(targets) - count * long
        shapes = np.full((3, count, pad), -1, np.int32)
        for i, x in enumerate((inputs, targets, first)):
            shapes[i, :, :long] = cut(x)
            shapes[i, -1, long:] = x[rest]
        return shapes[0], shapes[1], shapes[2]
    return cut(inputs), cut(targets), cut(first).astype(np.int32)


def window_gradient(
    p: dict[str, np.ndarray],
    g: dict[str, np.ndarray],
    shape: Shape,
    h: np.ndarray,
    inputs: np.ndarray,
    targets: np.ndarray,
    begins: np.ndarray,
    room: Room | None = None,
) -> np.ndarray:
    """Add to `g` the gradient of the mean negative log-likelihood of one window.

    Rows are streams, columns are steps; `h` holds the states before the window, which
    count as given. Returns the states after it, which the next window in `room` overwrites.
    """
    room = room or Room()
    rows, steps = inputs.shape
    given, ys = inputs.T.ravel(), targets.T.ravel()
    w, x = _weights(p), _inputs(p, given, room).reshape(3, steps, rows, HIDDEN)
    firsts = [np.flatnonzero(begins[:, t]) for t in range(steps)]
    size = (steps, rows, HIDDEN)
    gates, slopes = room.array("gates", (2, *size), x.dtype), room.array("slopes", (4, *size), x.dtype)
    before, u, n, states, to_state = room.array("steps", (5, *size), x.dtype)
    for t in range(steps):
        before[t] = h
        before[t, firsts[t]] = 0
        _step(w, x[:, t], before[t], gates[:, t], u[t], n[t], states[t])
        h = states[t]
    # The softmaxes see the states by the classes of their targets.
    share = 1 / len(ys)
    order, among_classes, in_class, parts = _by_class(shape, ys)
    hs, by_class = room.array("by_class", (2, len(ys), HIDDEN), x.dtype)
    states.reshape(-1, HIDDEN).take(order, axis=0, out=hs, mode="clip")
    back = _softmax(_class_logits(p, hs, room), share)
    back.ravel()[among_classes] -= share
    g["classes"] += (back @ hs).T
    g["class_bias"] += back.sum(1)
    np.matmul(back.T, p["classes"].T, out=by_class)
    for begin, end, at in parts:
        within = p["words"][begin:end] @ hs[at].T
        within += p["word_bias"][begin:end, None]
        _softmax(within, share)
        within.ravel()[in_class[at]] -= share
        g["words"][begin:end] += within @ hs[at]
        g["word_bias"][begin:end] += within.sum(1)
        by_class[at] += within.T @ p["words"][begin:end]
    to_state.reshape(-1, HIDDEN)[order] = by_class
    # Slopes for z, r, the state's part of the new state (before r) and the new state.
    back_w = np.ascontiguousarray(w.transpose(0, 2, 1))
    from_next = np.zeros_like(states[0])
    for t in range(steps - 1, -1, -1):
        z, r = gates[:, t]
        dz, dr, du, dn = slopes[:, t]
        dh = to_state[t]
        dh += from_next
        rest = 1 - z
        np.multiply(n[t], n[t], out=dn)
        np.subtract(1, dn, out=dn)
        dn *= rest
        dn *= dh
        np.subtract(before[t], n[t], out=dz)
        dz *= rest
        dh *= z
        dz *= dh
        np.multiply(dn, r, out=du)
        np.subtract(1, r, out=dr)
        dr *= u[t]
        dr *= du
        of_z, of_r, of_u = np.matmul(slopes[:3, t], back_w)
        from_next = dh
        from_next += of_z
        from_next += of_r
        from_next += of_u
        from_next[firsts[t]] = 0
    to_z, to_r, to_u = np.matmul(before.reshape(-1, HIDDEN).T, slopes[:3].reshape(3, -1, HIDDEN))
    g["gates"][:, :HIDDEN] += to_z
    g["gates"][:, HIDDEN:] += to_r
    g["state"] += to_u
    given = given.astype(np.uint16 if shape.symbols <= 1 << 16 else np.int64)
    order = np.argsort(given, kind="stable")
    symbols, firsts = np.unique(given[order], return_index=True)
    to_input = room.array("to_input", (3, len(given), HIDDEN), x.dtype)
    for k, at in enumerate((0, 1, 3)):
        slopes[at].reshape(-1, HIDDEN).take(order, axis=0, out=to_input[k], mode="clip")
    # Two neighbours add up as one complex number, in half the steps.
    pairs = np.add.reduceat(to_input.view(np.result_type(x, np.complex64)), firsts, axis=1)
    g["input"].reshape(-1, 3, HIDDEN)[symbols] += pairs.view(x.dtype).transpose(1, 0, 2)
    return h


def train(
    vector: np.ndarray,
    shape: Shape,
    texts: list[np.ndarray],
    start: int,
    rate: float = 0.004,
    window: int = 16,
    parallel: int = 384,
    least_updates: int = 75,
) -> np.ndarray:
    """Parameters after passes over the texts by truncated backpropagation and Adam.

    One pass, or as many as give `least_updates`. There are up to `parallel` streams, but
    no more than leave a pass of `least_updates`, down to a quarter of them; `rate` is for
    that quarter and grows with the root of the number.
    """
    vector = vector.copy()
    p = unpack(vector, shape)
    slope = np.zeros_like(vector)
    g = unpack(slope, shape)
    # The moments without their factors of 0.1 and 0.01, which join the rate.
    first_moment, second_moment, size = (np.zeros_like(vector) for _ in range(3))
    tokens = sum(map(len, texts))
    count = min(parallel, max(parallel // 4, tokens // (window * least_updates)))
    # Step by step, as the windows read them.
    inputs, targets, begins = (x.T.copy().T for x in streams(texts, start, count))
    rate *= max(1.0, len(inputs) / (parallel / 4)) ** 0.5
    updates, room = 0, Room()
    windows = -(-inputs.shape[1] // window)
    for _ in range(max(1, -(-least_updates // windows))):
        h = np.zeros((len(inputs), HIDDEN), np.float32)
        for at in range(0, inputs.shape[1], window):
            slope[:] = 0
            rows = np.flatnonzero(inputs[:, at] >= 0)
            # Streams other than the last may end inside the window.
            steps = int((inputs[rows[0], at : at + window] >= 0).sum())
            part = (slice(None) if len(rows) == len(inputs) else rows, slice(at, at + steps))
            h[rows] = window_gradient(p, g, shape, h[rows], inputs[part], targets[part], begins[part], room)
            np.clip(slope, -0.05, 0.05, out=slope)
            updates += 1
            first_moment *= np.float32(0.9)
            first_moment += slope
            slope *= slope
            second_moment *= np.float32(0.99)
            second_moment += slope
            root = (0.01 / (1 - 0.99**updates)) ** 0.5
            np.sqrt(second_moment, out=size)
            size += np.float32(1e-6 / root)
            np.divide(first_moment, size, out=size)
            size *= np.float32(0.1 * rate / (1 - 0.9**updates) / root)
            vector -= size
    return vector
