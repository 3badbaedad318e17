"""A character convolutional network in numpy, for a stretch of text and what surrounds it.

A window is a row of character codes: some before the stretch, some of the stretch, some after it, each
part filled up with zeros. Characters have learned vectors; filters run over five characters, and the largest
answer of each filter in each part, and its mean in the stretch, go into a logistic output.
"""

from __future__ import annotations

import numpy as np

# Characters before, in and after a stretch.
LEFT, BODY, RIGHT = 32, 64, 16
LENGTH = LEFT + BODY + RIGHT
# ASCII has a code for each character, all other bytes share one; 0 is none.
CODES = 129
VECTOR, REACH, FILTERS = 8, 5, 24
RATE, BATCH, EPOCHS, LEAST_STEPS = 0.004, 64, 6, 400

Net = dict[str, np.ndarray]


def new_net(rng: np.random.Generator) -> Net:
    width = REACH * (VECTOR + 1)
    return {
        "vectors": rng.normal(0, 0.5, (CODES, VECTOR)).astype(np.float32),
        "filters": rng.normal(0, (2 / width) ** 0.5, (width, FILTERS)).astype(np.float32),
        "offsets": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.1, 4 * FILTERS).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }


def _parts(codes: np.ndarray) -> np.ndarray:
    """For every place of a filter, whether its middle lies before, in or after the stretch."""
    inner = slice(REACH // 2, LENGTH - REACH // 2)
    at = np.arange(LENGTH)
    parts = np.stack([at < LEFT, (at >= LEFT) & (at < LEFT + BODY), at >= LEFT + BODY])
    return ((codes > 0)[:, None, :] & parts)[:, :, inner]


def _patches(net: Net, codes: np.ndarray) -> np.ndarray:
    at = np.arange(LENGTH)
    mark = np.where((codes > 0) & (at >= LEFT) & (at < LEFT + BODY), 1.0, 0.0).astype(np.float32)
    planes = np.concatenate([net["vectors"][codes] * (codes > 0)[..., None], mark[..., None]], axis=2)
    views = np.lib.stride_tricks.sliding_window_view(planes, REACH, axis=1)
    return views.transpose(0, 1, 3, 2).reshape(len(codes), LENGTH - REACH + 1, -1)


def _forward(net: Net, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
    patches = _patches(net, codes)
    answers = np.maximum(patches @ net["filters"] + net["offsets"], 0)
    parts = _parts(codes).astype(np.float32)
    masked = [answers * parts[:, k, :, None] for k in range(3)]
    sizes = np.maximum(parts[:, 1].sum(axis=1), 1)[:, None]
    pooled = np.concatenate([m.max(axis=1) for m in masked] + [masked[1].sum(axis=1) / sizes], axis=1)
    return pooled @ net["weights"] + net["bias"][0], (patches, answers, parts, masked, sizes, pooled)


def logits(net: Net, codes: np.ndarray, block: int = 512) -> np.ndarray:
    """One number for each window, a bounded number of windows at a time."""
    found = [_forward(net, codes[at : at + block])[0] for at in range(0, len(codes), block)]
    return np.concatenate(found) if found else np.zeros(0, np.float32)


def _gradients(net: Net, codes: np.ndarray, labels: np.ndarray) -> Net:
    out, (patches, answers, parts, masked, sizes, pooled) = _forward(net, codes)
    wrong = ((1 / (1 + np.exp(-out)) - labels) / len(labels)).astype(np.float32)
    back = wrong[:, None] * net["weights"]
    slope = parts[:, 1, :, None] * (back[:, 3 * FILTERS :] / sizes)[:, None, :]
    rows, filters = np.arange(len(codes))[:, None], np.arange(FILTERS)[None, :]
    for k, answer in enumerate(masked):
        slope[rows, answer.argmax(axis=1), filters] += back[:, k * FILTERS : (k + 1) * FILTERS]
    slope *= answers > 0
    to_patches = (slope @ net["filters"].T).reshape(len(codes), LENGTH - REACH + 1, REACH, VECTOR + 1)
    to_planes = np.zeros((len(codes), LENGTH, VECTOR), np.float32)
    for k in range(REACH):
        to_planes[:, k : k + LENGTH - REACH + 1] += to_patches[:, :, k, :VECTOR]
    flat = codes.ravel()
    vectors = np.stack([np.bincount(flat, to_planes[..., v].ravel(), CODES) for v in range(VECTOR)], axis=1)
    vectors[0] = 0
    return {
        "vectors": vectors.astype(np.float32),
        "filters": np.tensordot(patches, slope, axes=((0, 1), (0, 1))),
        "offsets": slope.sum(axis=(0, 1)),
        "weights": pooled.T @ wrong,
        "bias": np.array([wrong.sum()], np.float32),
    }


def new_state(seed: int) -> Net:
    """A new net, its moment estimates (``first_`` and ``second_`` before the name) and the number of steps so far."""
    net = new_net(np.random.default_rng(seed))
    moments = {f"{kind}_{name}": np.zeros_like(value) for kind in ("first", "second") for name, value in net.items()}
    return net | moments | {"step": np.zeros(1)}


def net_of(state: Net) -> Net:
    return {name.removeprefix("first_"): state[name.removeprefix("first_")] for name in state if name.startswith("first_")}


def train_round(state: Net, codes: np.ndarray, labels: np.ndarray, number: int, seed: int) -> Net:
    """One of ``EPOCHS`` rounds: mini-batches of all rows, more than once where they are few, with a falling rate."""
    rng = np.random.default_rng([seed, number])
    state = {name: value.copy() for name, value in state.items()}
    net = net_of(state)
    batches = -(-len(codes) // BATCH)
    steps = batches * max(1, -(-LEAST_STEPS // (EPOCHS * max(batches, 1))))
    for done in range(steps):
        if done % batches == 0:
            order = rng.permutation(len(codes))
        chosen = order[done % batches * BATCH :][:BATCH]
        state["step"] += 1
        step, rate = float(state["step"][0]), RATE * (1 - (number + done / steps) / EPOCHS)
        for name, slope in _gradients(net, codes[chosen], labels[chosen]).items():
            first, second = state[f"first_{name}"], state[f"second_{name}"]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            mean, spread = first / (1 - 0.9**step), second / (1 - 0.999**step)
            net[name] -= (rate * mean / (np.sqrt(spread) + 1e-8)).astype(np.float32)
    return state


def train(codes: np.ndarray, labels: np.ndarray, seed: int = 0) -> Net:
    """All rounds on rows that fit one machine."""
    state = new_state(seed)
    for number in range(EPOCHS):
        state = train_round(state, codes, labels, number, seed)
    return net_of(state)


def as_numbers(state: Net) -> np.ndarray:
    """All values in a row; second moments by their roots, whose sizes are those of the others."""
    return np.concatenate([np.sqrt(v).ravel() if k.startswith("second") else v.ravel() for k, v in state.items()]).astype(float)


def from_numbers(like: Net, numbers: np.ndarray) -> Net:
    """The state whose values are given in a row, in the shapes of another one."""
    cuts = np.cumsum([value.size for value in like.values()])[:-1]
    parts = zip(like.items(), np.split(numbers, cuts), strict=True)
    return {k: (n**2 if k.startswith("second") else n).reshape(v.shape).astype(v.dtype) for (k, v), n in parts}
