"""A small gated recurrent network with a class-factored softmax, in numpy.

Token ``t`` has an output class; words of the vocabulary are then told apart within their
class, the others are left to their class's counts.  Texts run in parallel lanes, each a
sequence of whole texts; the state starts at zero with each text and is carried from one
window of steps to the next, so a text's log-likelihood is exact at any length, while
training cuts the gradient at the window's edge."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

EMBED, HIDDEN = 16, 16


@dataclass
class Layout:
    """Classes 0 to ``n_fine`` - 1 hold the words ``start[c]`` to ``start[c + 1]`` - 1;
    later classes stand for all words beyond the vocabulary.  Input tokens are words,
    then one per further class."""

    start: np.ndarray
    n_classes: int

    def __post_init__(self):
        words = np.repeat(np.arange(self.n_fine), np.diff(self.start))
        self.classes = np.concatenate([words, np.arange(self.n_fine, self.n_classes)]).astype(np.int16)

    @property
    def n_fine(self) -> int:
        return len(self.start) - 1

    @property
    def n_words(self) -> int:
        return int(self.start[-1])

    @property
    def n_inputs(self) -> int:
        return self.n_words + self.n_classes - self.n_fine

    def class_of(self, tokens: np.ndarray) -> np.ndarray:
        return self.classes[tokens]


class Params:
    """Weights as one flat vector with named views."""

    def __init__(self, layout: Layout, flat: np.ndarray | None = None):
        shapes = {
            "emb": (layout.n_inputs, EMBED),
            "w": (EMBED, 3 * HIDDEN),
            "u": (HIDDEN, 3 * HIDDEN),
            "b": (3 * HIDDEN,),
            "cls": (HIDDEN, layout.n_classes),
            "cls_b": (layout.n_classes,),
            "out": (layout.n_words, HIDDEN),
            "out_b": (layout.n_words,),
        }
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(size, dtype=np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n


def initial(layout: Layout, class_counts: np.ndarray, word_counts: np.ndarray, seed: int = 2) -> Params:
    """Small random weights; biases give the unigram distribution of the counts."""
    p = Params(layout)
    rng = np.random.default_rng(seed)
    for name, scale in (("emb", 0.3), ("w", 0.25), ("u", 0.25), ("cls", 0.1), ("out", 0.05)):
        view = getattr(p, name)
        view[:] = rng.standard_normal(view.shape) * scale
    p.b[:HIDDEN] = 1.0  # gates start by keeping the state
    p.cls_b[:] = np.log(class_counts + 0.5)
    p.cls_b -= p.cls_b.mean()
    p.out_b[:] = np.log(word_counts + 0.5)
    for a, b in zip(layout.start, layout.start[1:], strict=False):
        p.out_b[a:b] -= p.out_b[a:b].mean()
    return p


def run(p: Params, h: np.ndarray, tokens: np.ndarray, fresh: np.ndarray, keep: bool = False):
    """Steps over ``tokens`` (step, lane); ``fresh`` marks a text's first token.  Returns
    the states before each token, the last state and, if asked for, what backward needs."""
    steps, lanes = tokens.shape
    # A gate is 0.5 + 0.5 * tanh(x / 2): the halves go into its weights.
    half = np.ones(3 * HIDDEN, dtype=np.float32)
    half[: 2 * HIDDEN] = 0.5
    u = p.u * half
    if tokens.size > len(p.emb):  # each input's share once, not once per token
        gx = ((p.emb @ p.w + p.b) * half)[tokens]
    else:
        gx = ((p.emb[tokens.ravel()] @ p.w + p.b) * half).reshape(steps, lanes, 3 * HIDDEN)
    before = np.empty((steps, lanes, HIDDEN), dtype=np.float32)
    new = fresh.any(axis=1).tolist()
    saved = []
    for s in range(steps):
        if new[s]:
            h = np.where(fresh[s][:, None], np.float32(0), h)
        before[s] = h
        gh = h @ u
        x, gn = gx[s], gh[:, 2 * HIDDEN :]
        zr = x[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = r * gn
        n += x[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        if keep:
            saved.append((z, r, n, gn))
        h = h - n
        h *= z
        h += n
    return before, h, saved


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(logits, their exponentials, row sums, logs of the sums); rows are shifted only if
    they need it, since weights of usual size are far from overflow."""
    e = np.exp(logits)
    total = e @ np.ones(e.shape[1], dtype=e.dtype)
    log = np.log(total)
    if not np.isfinite(log.sum()):
        logits = logits - logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        total = e.sum(axis=1)
        log = np.log(total)
    return logits, e, total, log


def log_likelihood(p: Params, layout: Layout, states: np.ndarray, targets: np.ndarray, grads: Params | None = None):
    """Natural log-probability of each target's class and, within the vocabulary, word.
    With ``grads``, adds the gradient of the summed loss and returns that of the states.
    Rows are worked in the order of their classes, so a class is one slice."""
    cls = layout.class_of(targets)
    order = np.argsort(cls, kind="stable")
    cls, states, targets = cls[order], states[order], targets[order]
    rows = np.arange(len(targets))
    logits = states @ p.cls
    logits += p.cls_b
    logits, e, total, log = _softmax(logits)
    out = logits[rows, cls] - log
    d_states = None
    if grads is not None:
        e /= total[:, None]
        e[rows, cls] -= 1
        grads.cls += states.T @ e
        grads.cls_b += e.sum(axis=0)
        d_states = e @ p.cls.T
    bounds = np.searchsorted(cls, np.arange(layout.n_fine + 1)).tolist()
    for c, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if lo == hi:
            continue
        a, b = layout.start[c], layout.start[c + 1]
        hs, own, k = states[lo:hi], targets[lo:hi] - a, rows[: hi - lo]
        logits = hs @ p.out[a:b].T
        logits += p.out_b[a:b]
        logits, e, total, log = _softmax(logits)
        out[lo:hi] += logits[k, own] - log
        if grads is not None:
            e /= total[:, None]
            e[k, own] -= 1
            grads.out[a:b] += e.T @ hs
            grads.out_b[a:b] += e.sum(axis=0)
            d_states[lo:hi] += e @ p.out[a:b]
    back = np.empty_like(order)
    back[order] = rows
    return out[back], d_states[back] if d_states is not None else None


def _backward(p: Params, g: Params, tokens, fresh, before, saved, d_before):
    """Truncated back-propagation through the window's steps."""
    steps, lanes = tokens.shape
    d_h = np.zeros((lanes, HIDDEN), dtype=np.float32)
    d_gx, d_gh = (np.empty((steps, lanes, 3 * HIDDEN), dtype=np.float32) for _ in range(2))
    back, new = p.u.T.copy(), fresh.any(axis=1).tolist()
    for s in range(steps - 1, -1, -1):
        z, r, n, gn = saved[s]
        h, gx, gh = before[s], d_gx[s], d_gh[s]
        d_n = d_h * (1 - z)
        d_n *= 1 - n * n
        gx[:, :HIDDEN] = d_h * (h - n) * (z * (1 - z))
        gx[:, HIDDEN : 2 * HIDDEN] = d_n * gn * (r * (1 - r))
        gx[:, 2 * HIDDEN :] = d_n
        gh[:, : 2 * HIDDEN] = gx[:, : 2 * HIDDEN]
        gh[:, 2 * HIDDEN :] = d_n * r
        d_h = d_h * z + gh @ back + d_before[s]
        if new[s]:
            d_h[fresh[s]] = 0
    g.u += before.reshape(-1, HIDDEN).T @ d_gh.reshape(-1, 3 * HIDDEN)
    flat = d_gx.reshape(-1, 3 * HIDDEN)
    # An input's tokens act alike, so their gradients are summed first, in the order of inputs.
    t = tokens.ravel().astype(np.int32)
    order = np.argsort(t, kind="stable")
    t = t[order]
    first = np.flatnonzero(np.diff(t, prepend=-1))
    sums, own = np.add.reduceat(flat[order], first, axis=0), t[first]
    g.w += p.emb[own].T @ sums
    g.b += sums.sum(axis=0)
    g.emb[own] += sums @ p.w.T


class Lanes:
    """Texts dealt to lanes, longest first, each to the shortest lane.  The first
    ``warm[i]`` tokens of text i only set the state; they don't count."""

    def __init__(self, texts: list[np.ndarray], n_lanes: int, warm: list[int] | None = None):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        heap = [(0, k) for k in range(min(n_lanes, len(texts)))]
        lanes: list[list[int]] = [[] for _ in heap]
        for i in np.argsort(-lengths, kind="stable").tolist():
            n, k = heapq.heappop(heap)
            lanes[k].append(i)
            heapq.heappush(heap, (n + int(lengths[i]), k))
        lanes.sort(key=lambda lane: -int(lengths[lane].sum()))
        self.sizes = np.array([int(lengths[lane].sum()) for lane in lanes], dtype=np.int64)
        order = [i for lane in lanes for i in lane]
        self.flat = np.concatenate([texts[i] for i in order]) if order else np.zeros(0, dtype=np.int64)
        self.text = np.repeat(np.array(order, dtype=np.int64), lengths[order]) if order else np.zeros(0, dtype=np.int64)
        self.fresh = np.zeros(len(self.flat), dtype=bool)
        ends = np.cumsum(lengths[order]) if order else np.zeros(0, dtype=np.int64)
        self.fresh[ends - lengths[order]] = True
        self.counts = np.ones(len(self.flat), dtype=bool)
        if warm is not None and order:
            lead = np.array(warm, dtype=np.int64)[order]
            at = np.repeat(ends - lengths[order] - np.cumsum(lead) + lead, lead) + np.arange(int(lead.sum()))
            self.counts[at] = False
        self.at = np.cumsum(self.sizes) - self.sizes

    def windows(self, steps: int, tokens: int = 0):
        """Per window: (lanes that still run, index of each (step, lane) or -1).  A window
        has ``steps`` steps, or more if that gives it at most ``tokens`` tokens, so that
        the last lanes of long texts don't go by many small windows."""
        longest, s = int(self.sizes.max(initial=0)), 0
        while s < longest:
            k = int((self.sizes > s).sum())
            n = min(max(steps, tokens // k), longest - s)
            step = s + np.arange(n)[:, None]
            yield k, np.where(step < self.sizes[None, :k], self.at[None, :k] + step, -1)
            s += n


def score(p: Params, layout: Layout, texts: list[np.ndarray], n_lanes: int = 512, steps: int = 16, window: int = 8192) -> np.ndarray:
    """Summed natural log-probability of each text's tokens."""
    lanes = Lanes(texts, n_lanes)
    out = np.zeros(len(texts))
    h = np.zeros((len(lanes.sizes), HIDDEN), dtype=np.float32)
    for k, at in lanes.windows(steps, window):
        tokens = np.where(at >= 0, lanes.flat[at], 0)
        before, h, _ = run(p, h[:k], tokens, (at >= 0) & lanes.fresh[at])
        real = at >= 0
        ll, _ = log_likelihood(p, layout, before[real], tokens[real])
        out += np.bincount(lanes.text[at[real]], weights=ll, minlength=len(texts))
    return out


def segments(texts: list[np.ndarray], most: int, lead: int) -> tuple[list[np.ndarray], list[int]]:
    """Long texts as consecutive segments of ``most`` tokens, so that one text doesn't
    occupy one lane alone; each but the first is preceded by ``lead`` tokens that only set
    the state.  Every token counts in one segment."""
    out, warm = [], []
    for t in texts:
        for a in range(0, max(len(t), 1), most):
            w = min(a, lead)
            out.append(t[a - w : a + most])
            warm.append(w)
    return out, warm


def train(p: Params, layout: Layout, texts: list[np.ndarray], rate: float, n_lanes: int = 512, steps: int = 8, most: int = 512) -> Params:
    """One pass of Adam over the texts, each token once."""
    p = Params(layout, p.flat.copy())
    parts, warm = segments(texts, most, steps)
    lanes = Lanes(parts, n_lanes, warm)
    m, v = np.zeros_like(p.flat), np.zeros_like(p.flat)
    h = np.zeros((len(lanes.sizes), HIDDEN), dtype=np.float32)
    for t, (k, at) in enumerate(lanes.windows(steps), 1):
        real = at >= 0
        tokens = np.where(real, lanes.flat[at], 0)
        fresh, counted = real & lanes.fresh[at], real & lanes.counts[at]
        before, h, saved = run(p, h[:k], tokens, fresh, keep=True)
        g = Params(layout)
        d_before = np.zeros_like(before)
        _, d = log_likelihood(p, layout, before[counted], tokens[counted], g)
        d_before[counted] = d
        _backward(p, g, tokens, fresh, before, saved, d_before)
        grad = g.flat / max(1, int(counted.sum()))
        norm = float(np.sqrt(grad @ grad))
        if norm > 1:
            grad /= norm
        m *= 0.9
        m += 0.1 * grad
        v *= 0.998
        grad *= grad
        grad *= 0.002
        v += grad
        np.sqrt(v, out=grad)
        grad *= (1 - 0.998**t) ** -0.5
        grad += 1e-7
        np.divide(m, grad, out=grad)
        grad *= rate / (1 - 0.9**t)
        p.flat -= grad
    return p
