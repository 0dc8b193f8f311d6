"""A bidirectional gated recurrent network over bytes, in numpy.

Each direction keeps a state h; for byte x, with t = tanh:
    z, r = s(E[x] + h U), s(E'[x] + h U')        gates
    c    = t(E''[x] + r * (h U''))               candidate
    h    = c + z * (h - c)
where s(v) = (t(v / 2) + 1) / 2. A softmax over both states gives every position of a
segment its label probabilities. Training is backpropagation through all positions of a
segment, with the cross-entropy of every position, and Adam.
"""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


def new_weights(hidden: int, labels: int, rng: np.random.Generator) -> Weights:
    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    out: Weights = {"W": draw(2 * hidden, labels, scale=0.3), "b": np.zeros(labels, np.float32)}
    for side in "fb":
        out["Eg" + side] = draw(256, 2 * hidden, scale=0.3)
        out["Ec" + side] = draw(256, hidden, scale=0.5)
        out["Ug" + side] = draw(hidden, 2 * hidden, scale=hidden**-0.5)
        out["Uc" + side] = draw(hidden, hidden, scale=hidden**-0.5)
    return out


def _direction(w: Weights, side: str, x: np.ndarray, live: np.ndarray | None, keep: bool):
    """States after each row of ``x`` (steps, segments); a state is 0 where not ``live``."""
    steps, count = x.shape
    hidden = w["Uc" + side].shape[0]
    eg, ec = w["Eg" + side] * np.float32(0.5), w["Ec" + side]
    ug, uc = w["Ug" + side] * np.float32(0.5), w["Uc" + side]
    states = np.empty((steps, count, hidden), np.float32)
    kept = []
    h = np.zeros((count, hidden), np.float32)
    half = np.float32(0.5)
    for t in range(steps):
        gates = eg[x[t]]
        gates += h @ ug
        np.tanh(gates, out=gates)
        gates *= half
        gates += half
        z, r = gates[:, :hidden], gates[:, hidden:]
        own = h @ uc
        c = own * r
        c += ec[x[t]]
        np.tanh(c, out=c)
        new = h - c
        new *= z
        new += c
        if live is not None:
            new *= live[t][:, None]
        if keep:
            kept.append((h, z, r, own, c))
        h = states[t] = new
    return states, kept


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def position_probabilities(w: Weights, x: np.ndarray, live: np.ndarray | None) -> np.ndarray:
    """Label probabilities of every position: (steps, segments, labels)."""
    ahead, _ = _direction(w, "f", x, live, keep=False)
    turned = None if live is None else live[::-1]
    back, _ = _direction(w, "b", x[::-1], turned, keep=False)
    hidden = ahead.shape[2]
    return _softmax(ahead @ w["W"][:hidden] + back[::-1] @ w["W"][hidden:] + w["b"])


def _back(w: Weights, side: str, x: np.ndarray, live: np.ndarray, kept, d_states, grads: Weights):
    """Add the gradients of one direction; ``d_states``: those of its states."""
    ug, uc = w["Ug" + side], w["Uc" + side]
    carried = np.zeros_like(d_states[0])
    dgs, dcs = [], []
    for t in range(len(x) - 1, -1, -1):
        h, z, r, own, c = kept[t]
        d = (d_states[t] + carried) * live[t][:, None]
        dc = d * (1 - z) * (1 - c * c)
        dz = d * (h - c) * z * (1 - z)
        dr = dc * own * r * (1 - r)
        dg = np.concatenate([dz, dr], axis=1)
        through = dc * r
        carried = d * z + dg @ ug.T + through @ uc.T
        grads["Ug" + side] += h.T @ dg
        grads["Uc" + side] += h.T @ through
        dgs.append(dg)
        dcs.append(dc)
    flat = x[::-1].reshape(-1)
    for name, parts in (("Eg", dgs), ("Ec", dcs)):
        rows = np.concatenate(parts)
        hot = np.zeros((len(flat), 256), np.float32)
        hot[np.arange(len(flat)), flat] = 1
        grads[name + side] += hot.T @ rows


def gradients(w: Weights, x: np.ndarray, live: np.ndarray, label: np.ndarray):
    """Mean cross-entropy over the live positions, and its gradients."""
    ahead, kept_f = _direction(w, "f", x, live, keep=True)
    back, kept_b = _direction(w, "b", x[::-1], live[::-1], keep=True)
    states = np.concatenate([ahead, back[::-1]], axis=2)
    p = _softmax(states @ w["W"] + w["b"])
    total = live.sum()
    own = np.arange(x.shape[1])
    loss = -(np.log(p[:, own, label] + 1e-9) * live).sum() / total
    d = p
    d[:, own, label] -= 1
    d *= (live / total)[:, :, None]
    hidden = ahead.shape[2]
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    grads["W"] = np.einsum("tbh,tbl->hl", states, d)
    grads["b"] = d.sum(axis=(0, 1))
    d_states = d @ w["W"].T
    _back(w, "f", x, live, kept_f, d_states[:, :, :hidden], grads)
    _back(w, "b", x[::-1], live[::-1], kept_b, d_states[::-1, :, hidden:], grads)
    return loss, grads


def train(
    segments: np.ndarray,
    live: np.ndarray,
    label: np.ndarray,
    labels: int,
    hidden: int,
    steps: int,
    batch: int = 256,
    rate: float = 0.01,
    seed: int = 0,
) -> Weights:
    """``segments``: bytes (count, length); ``live``: which are text; ``label``: one each."""
    rng = np.random.default_rng(seed)
    w = new_weights(hidden, labels, rng)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(segments), min(batch, len(segments)))
        x, alive = segments[pick].T, live[pick].T.astype(np.float32)
        _, grads = gradients(w, x, alive, label[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        pace = rate * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = g * np.float32(scale)
            first[k] += np.float32(0.1) * (g - first[k])
            second[k] += np.float32(0.01) * (g * g - second[k])
            up = first[k] / np.float32(1 - 0.9**step)
            w[k] -= np.float32(pace) * up / (np.sqrt(second[k] / np.float32(1 - 0.99**step)) + 1e-8)
    return w
