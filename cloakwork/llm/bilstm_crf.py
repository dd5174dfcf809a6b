"""A character-level bidirectional LSTM with CRF transitions, in numpy: training, scores, decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PAD = 0


@dataclass
class Params:
    embed: np.ndarray  # characters x e
    wf: np.ndarray  # (e + h) x 4h, forward: input, forget, output, candidate
    bf: np.ndarray
    wb: np.ndarray  # backward
    bb: np.ndarray
    wo: np.ndarray  # 2h x tags
    bo: np.ndarray
    trans: np.ndarray  # tags x tags, from row to column

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.wf, self.bf, self.wb, self.bb, self.wo, self.bo, self.trans]


def start(chars: int, tags: int, e: int, h: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    bias = np.zeros(4 * h, np.float32)
    bias[h : 2 * h] = 1  # remember at first
    return Params(init(chars, e), init(e + h, 4 * h), bias.copy(), init(e + h, 4 * h), bias.copy(), init(2 * h, tags), np.zeros(tags, np.float32), np.zeros((tags, tags), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """x: time x batch x e. Hidden states, and what the way back needs."""
    t, n, e = x.shape
    hid = w.shape[1] // 4
    h, c = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
    out, saved = np.empty((t, n, hid), np.float32), []
    pre = x.reshape(t * n, e) @ w[:e] + b
    pre = pre.reshape(t, n, 4 * hid)
    for i in range(t):
        z = pre[i] + h @ w[e:]
        gates = _sigmoid(z[:, : 3 * hid])
        g = np.tanh(z[:, 3 * hid :])
        last_h, last_c = h, c
        c = gates[:, hid : 2 * hid] * c + gates[:, :hid] * g
        tc = np.tanh(c)
        h = gates[:, 2 * hid :] * tc
        out[i] = h
        if keep:
            saved.append((gates, g, last_h, last_c, tc))
    return out, saved


def _lstm_back(x: np.ndarray, w: np.ndarray, saved: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t, n, e = x.shape
    hid = w.shape[1] // 4
    dw, db, dx = np.zeros_like(w), np.zeros(4 * hid, np.float32), np.empty_like(x)
    dh, dc = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
    for i in range(t - 1, -1, -1):
        gates, g, last_h, last_c, tc = saved[i]
        gi, gf, go = gates[:, :hid], gates[:, hid : 2 * hid], gates[:, 2 * hid :]
        dh = dh + dout[i]
        dc = dc + dh * go * (1 - tc * tc)
        dz = np.concatenate([dc * g * gi * (1 - gi), dc * last_c * gf * (1 - gf), dh * tc * go * (1 - go), dc * gi * (1 - g * g)], axis=1)
        dw[:e] += x[i].T @ dz
        dw[e:] += last_h.T @ dz
        db += dz.sum(axis=0)
        dx[i] = dz @ w[:e].T
        dh, dc = dz @ w[e:].T, dc * gf
    return dw, db, dx


def _hidden(table: np.ndarray, codes: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hidden states of one direction, time x batch x h. table: what each character adds to the gates.

    The logistic gates are computed as (1 + tanh(z / 2)) / 2: one call for all gates.
    """
    t, n = codes.shape
    hid = w.shape[1] // 4
    half = np.where(np.arange(4 * hid) < 3 * hid, 0.5, 1).astype(np.float32)
    table, w = table * half, np.ascontiguousarray(w * half)
    h, c, z, out = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32), np.empty((n, 4 * hid), np.float32), np.empty((t, n, hid), np.float32)
    for i in range(t):
        np.dot(h, w, out=z)
        z += table[codes[i]]
        np.tanh(z, out=z)
        gates = z[:, : 3 * hid]
        gates *= 0.5
        gates += 0.5
        c *= gates[:, hid : 2 * hid]
        c += gates[:, :hid] * z[:, 3 * hid :]
        h = np.multiply(gates[:, 2 * hid :], np.tanh(c), out=out[i])
    return out


def emissions(p: Params, codes: np.ndarray) -> np.ndarray:
    """codes: batch x time. Scores batch x time x tags."""
    e, codes = p.embed.shape[1], np.ascontiguousarray(codes.T)
    f = _hidden(p.embed @ p.wf[:e] + p.bf, codes, p.wf[e:])
    b = _hidden(p.embed @ p.wb[:e] + p.bb, codes[::-1], p.wb[e:])
    return (np.concatenate([f, b[::-1]], axis=2) @ p.wo + p.bo).transpose(1, 0, 2)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def marginals(em: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a linear-chain CRF: log partition, tag marginals (batch x time x tags) and summed transition marginals."""
    n, t, k = em.shape
    a, b = np.empty_like(em), np.zeros_like(em)
    a[:, 0] = em[:, 0]
    for i in range(1, t):
        a[:, i] = em[:, i] + _lse(a[:, i - 1, :, None] + trans, 1)
    for i in range(t - 2, -1, -1):
        b[:, i] = _lse(trans + (em[:, i + 1] + b[:, i + 1])[:, None, :], 2)
    z = _lse(a[:, -1], 1)
    pairs = np.zeros_like(trans)
    for i in range(t - 1):
        pairs += np.exp(a[:, i, :, None] + trans + (em[:, i + 1] + b[:, i + 1])[:, None, :] - z[:, None, None]).sum(axis=0)
    return z, np.exp(a + b - z[:, None, None]), pairs


def viterbi(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags, batch x time."""
    n, t, k = em.shape
    back, best = np.empty((n, t, k), np.int8), em[:, 0]
    for i in range(1, t):
        s = best[:, :, None] + trans
        back[:, i] = s.argmax(axis=1)
        best = s.max(axis=1) + em[:, i]
    out = np.empty((n, t), np.int8)
    out[:, -1] = best.argmax(axis=1)
    for i in range(t - 1, 0, -1):
        out[:, i - 1] = np.take_along_axis(back[:, i], out[:, i, None].astype(np.int64), 1)[:, 0]
    return out


def loss_and_gradient(p: Params, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log likelihood of the tags, and its gradient in the order of Params.arrays()."""
    n, t = codes.shape
    x = p.embed[codes.T]
    f, sf = _lstm(x, p.wf, p.bf, True)
    b, sb = _lstm(x[::-1], p.wb, p.bb, True)
    both = np.concatenate([f, b[::-1]], axis=2)
    em = (both @ p.wo + p.bo).transpose(1, 0, 2)
    z, marg, pairs = marginals(em.astype(np.float64), p.trans.astype(np.float64))
    rows = np.arange(n)[:, None]
    gold = em[rows, np.arange(t)[None, :], tags].sum() + p.trans[tags[:, :-1], tags[:, 1:]].sum()
    d = marg.copy()
    d[rows, np.arange(t)[None, :], tags] -= 1
    dtrans = pairs
    np.subtract.at(dtrans, (tags[:, :-1], tags[:, 1:]), 1)
    d = (d / n).astype(np.float32).transpose(1, 0, 2)
    dwo, dbo = both.reshape(t * n, -1).T @ d.reshape(t * n, -1), d.sum(axis=(0, 1))
    dboth = d @ p.wo.T
    h = f.shape[2]
    dwf, dbf, dxf = _lstm_back(x, p.wf, sf, dboth[:, :, :h])
    dwb, dbb, dxb = _lstm_back(x[::-1], p.wb, sb, dboth[::-1, :, h:])
    dembed = np.zeros_like(p.embed)
    np.add.at(dembed, codes.T, dxf + dxb[::-1])
    return float(z.sum() - gold) / n, [dembed, dwf, dbf, dwb, dbb, dwo, dbo, (dtrans / n).astype(np.float32)]


def train(codes: np.ndarray, tags: np.ndarray, chars: int, kinds: int, e: int = 12, h: int = 16, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 3) -> Params:
    """Adam over seeded batches; gradients are clipped to norm 5."""
    p = start(chars, kinds, e, h, seed)
    rng = np.random.default_rng(seed)
    m, v = [np.zeros_like(a) for a in p.arrays()], [np.zeros_like(a) for a in p.arrays()]
    steps, total = 0, epochs * -(-len(codes) // batch)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(codes)), -(-len(codes) // batch)):
            _, grads = loss_and_gradient(p, codes[some], tags[some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            steps += 1
            now = rate * (1 - steps / (total + 1))
            for a, g, mi, vi in zip(p.arrays(), grads, m, v, strict=True):
                g = g * min(1, 5 / (norm + 1e-9))
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                a -= now * (mi / (1 - 0.9**steps)) / (np.sqrt(vi / (1 - 0.999**steps)) + 1e-8)
    return p
