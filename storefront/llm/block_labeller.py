"""A bidirectional LSTM over the blocks of a page, in numpy.

A block is two bags of hashed names (its tag path, its words) and a few
numbers; both directions read all blocks of a page, so a block is judged with
everything before and after it. Pages are padded into batches of similar
length whose size is bounded; padding comes after a page's own blocks in both
directions and plays no part.
"""

from __future__ import annotations

import numpy as np

TAGS, WORDS, NUMBERS, INNER, HIDDEN = 512, 256, 8, 24, 16

# One page: flat tag ids with offsets, flat word ids with offsets, numbers (blocks x NUMBERS).
Page = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def fresh_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"tags": (TAGS, INNER), "words": (WORDS, INNER), "numbers": (NUMBERS, INNER), "out": (2 * HIDDEN, 1), "out0": (1,)}
    for d in ("f", "b"):
        shapes |= {f"{d}x": (INNER, 4 * HIDDEN), f"{d}h": (HIDDEN, 4 * HIDDEN), f"{d}0": (4 * HIDDEN,)}
    weights = {k: rng.normal(0, 0.3 if len(s) > 1 else 0.0, s) / (1 if len(s) < 2 or k in ("tags", "words") else np.sqrt(s[0]) / 2)
               for k, s in shapes.items()}
    for d in ("f", "b"):
        weights[f"{d}0"][HIDDEN:2 * HIDDEN] = 1  # remember at first
    return weights


def _bag(table: np.ndarray, ids: np.ndarray, offsets: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Per block the scaled sum of its ids' rows (blocks without ids: zero)."""
    sums = np.zeros((len(offsets) - 1, table.shape[1]))
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        sums[full] = np.add.reduceat(table[ids], offsets[:-1][full], axis=0)
    return sums * scale[:, None]


def _scales(page: Page) -> tuple[np.ndarray, np.ndarray]:
    tags, words = np.diff(page[1]), np.diff(page[3])
    return 1 / np.sqrt(np.maximum(tags, 1)), 1 / np.sqrt(np.maximum(words, 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _inputs(w: dict, page: Page) -> np.ndarray:
    tag_scale, word_scale = _scales(page)
    return np.tanh(_bag(w["tags"], page[0], page[1], tag_scale) + _bag(w["words"], page[2], page[3], word_scale)
                   + page[4] @ w["numbers"])


def _run(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, w0: np.ndarray, keep: bool = False):
    """x: (steps, pages, INNER) -> hidden states, and what training needs."""
    steps, pages, _ = x.shape
    given, n = x @ wx + w0, HIDDEN
    h, c = np.zeros((pages, n)), np.zeros((pages, n))
    out, trace = np.empty((steps, pages, n)), []
    for t in range(steps):
        z = given[t] + h @ wh
        gates, fresh = _sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
        before = c
        c = gates[:, n:2 * n] * c + gates[:, :n] * fresh
        shown = np.tanh(c)
        if keep:
            trace.append((gates, fresh, before, shown, h))
        h = gates[:, 2 * n:] * shown
        out[t] = h
    return out, trace


def _back(d_out: np.ndarray, x: np.ndarray, wx: np.ndarray, wh: np.ndarray, trace: list):
    """Gradients of ``_run``: for x, wx, wh, w0."""
    steps, pages, n = d_out.shape
    d_given = np.empty((steps, pages, 4 * n))
    d_wh, d_h, d_c = np.zeros_like(wh), np.zeros((pages, n)), np.zeros((pages, n))
    for t in range(steps - 1, -1, -1):
        gates, fresh, before, shown, h = trace[t]
        i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - shown ** 2)
        d_z = np.concatenate([d_c * fresh * i * (1 - i), d_c * before * f * (1 - f), d_h * shown * o * (1 - o),
                              d_c * i * (1 - fresh ** 2)], axis=1)
        d_given[t] = d_z
        d_wh += h.T @ d_z
        d_h, d_c = d_z @ wh.T, d_c * f
    flat = d_given.reshape(-1, 4 * n)
    return d_given @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(0)


def _padded(rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, width) forwards and, each page reversed in itself, backwards."""
    steps = max(len(r) for r in rows)
    ahead, back = np.zeros((steps, len(rows), width)), np.zeros((steps, len(rows), width))
    for i, r in enumerate(rows):
        ahead[:len(r), i], back[:len(r), i] = r, r[::-1]
    return ahead, back


def _unpadded(ahead: np.ndarray, back: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    return [np.concatenate([ahead[:n, i], back[:n, i][::-1]], axis=1) for i, n in enumerate(lengths)]


def label(w: dict[str, np.ndarray], pages: list[Page], cells: int = 20_000) -> list[np.ndarray]:
    """The probability of every block of every page to be main text."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p[4])), key=lambda i: len(pages[i][4]))
    while order:
        longest = len(pages[order[-1]][4])
        n = max(1, min(len(order), cells // longest))
        some, order = order[-n:], order[:-n]
        inputs = [_inputs(w, pages[i]) for i in some]
        ahead, back = _padded(inputs, INNER)
        states = _unpadded(_run(ahead, w["fx"], w["fh"], w["f0"])[0], _run(back, w["bx"], w["bh"], w["b0"])[0], [len(x) for x in inputs])
        for i, s in zip(some, states, strict=True):
            out[i] = _sigmoid(s @ w["out"] + w["out0"])[:, 0]
    return out


def _gradients(w: dict, pages: list[Page], truth: list[np.ndarray]) -> tuple[float, dict]:
    inputs = [_inputs(w, p) for p in pages]
    lengths = [len(x) for x in inputs]
    ahead, back = _padded(inputs, INNER)
    (fo, ft), (bo, bt) = _run(ahead, w["fx"], w["fh"], w["f0"], True), _run(back, w["bx"], w["bh"], w["b0"], True)
    states = np.concatenate(_unpadded(fo, bo, lengths))
    y = np.concatenate(truth)
    p = _sigmoid(states @ w["out"] + w["out0"])[:, 0]
    loss = -np.mean(np.log(np.where(y > 0.5, p, 1 - p) + 1e-9))
    d = ((p - y) / len(y))[:, None]
    g = {"out": states.T @ d, "out0": d.sum(0)}
    cuts = np.cumsum(lengths)[:-1]
    d_states = np.split(d @ w["out"].T, cuts)
    fd, _ = _padded([x[:, :HIDDEN] for x in d_states], HIDDEN)
    _, bd = _padded([x[:, HIDDEN:] for x in d_states], HIDDEN)
    d_ahead, g["fx"], g["fh"], g["f0"] = _back(fd, ahead, w["fx"], w["fh"], ft)
    d_back, g["bx"], g["bh"], g["b0"] = _back(bd, back, w["bx"], w["bh"], bt)
    g |= {k: np.zeros_like(w[k]) for k in ("tags", "words", "numbers")}
    for i, (page, x) in enumerate(zip(pages, inputs, strict=True)):
        n = len(x)
        dx = (d_ahead[:n, i] + d_back[:n, i][::-1]) * (1 - x ** 2)
        tag_scale, word_scale = _scales(page)
        np.add.at(g["tags"], page[0], np.repeat(dx * tag_scale[:, None], np.diff(page[1]), axis=0))
        np.add.at(g["words"], page[2], np.repeat(dx * word_scale[:, None], np.diff(page[3]), axis=0))
        g["numbers"] += page[4].T @ dx
    return float(loss), g


def train(pages: list[Page], truth: list[np.ndarray], rounds: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 7) -> dict:
    """Weights by Adam; the same pages and seed give the same weights."""
    w, rng = fresh_weights(seed), np.random.default_rng(seed)
    known = [i for i, t in enumerate(truth) if len(t)]
    mean, square, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    batches = max(1, -(-len(known) // batch))
    for _ in range(rounds if known else 0):
        # Alike in length within a batch, batches in any order.
        by_length = sorted(known, key=lambda i: (len(truth[i]), rng.random()))
        for k in rng.permutation(batches):
            some = by_length[k * batch:(k + 1) * batch]
            _, g = _gradients(w, [pages[i] for i in some], [truth[i] for i in some])
            step += 1
            size = np.sqrt(sum(float((x ** 2).sum()) for x in g.values()))
            now = rate * (1 - 0.9 * step / (rounds * batches)) / max(1.0, size / 5)
            for name, x in g.items():
                mean[name] = 0.9 * mean[name] + 0.1 * x
                square[name] = 0.99 * square[name] + 0.01 * x ** 2
                w[name] = w[name] - now * mean[name] / (1 - 0.9 ** step) / (np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-8)
    return w
