"""A small causal self-attention model over subword ids, in numpy.

One head looks back over a window of subwords. Its output and the current subword give the
weights of a mixture of fixed distributions over the vocabulary:

    p(next | past) = sum_m weight_m(past) * part_m(next)

so a probability costs one row of the table of parts, not a sum over the vocabulary. The
weights are trained by gradient (Adam) in rounds: in each, every task moves its own copy over
its texts, and the copies are averaged. The parts are trained by expectation maximisation,
once a round. The last round reads all training texts.

Texts are scored in overlapping windows: each window scores `STRIDE` subwords and sees
`CONTEXT` earlier ones besides; windows go through batches of masked matrix products, and
each subword is scored once.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

import numpy as np

DIM = 16
HIDDEN = 32
PARTS = 48
CONTEXT = 8
STRIDE = 24
WINDOW = CONTEXT + STRIDE
ROUNDS = 8  # of training: after each, the weights of all tasks are averaged
RATE = 0.01
BATCH = 128  # windows of a gradient step
OTHERS = ["project", "distance", "hidden", "hidden_bias", "out", "out_bias"]  # weights that every window moves
CHUNK = 128  # windows in one batch of products: their values stay in the cache
LIMIT = np.float32(50)
ONE_BITS = np.int32(127 << 23)  # the bits of 1.0
HALF_BITS = np.float32((1 << 23) / np.log(2) / 2)


@dataclass(frozen=True)
class Model:
    embed: np.ndarray  # vocabulary x DIM
    project: np.ndarray  # DIM x 3 DIM: query, key, value
    distance: np.ndarray  # WINDOW: bias of looking that far back
    hidden: np.ndarray  # 2 DIM x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # HIDDEN x PARTS
    out_bias: np.ndarray
    parts: np.ndarray  # vocabulary x PARTS, each column a distribution

    def weights(self) -> dict[str, np.ndarray]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "parts"}


def new_model(unigram: np.ndarray, seed: int = 1) -> Model:
    """Random weights; parts that differ a little from the unigram distribution."""
    draw = np.random.default_rng(seed)

    def around(*shape: int, scale: float) -> np.ndarray:
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    parts = unigram[:, None] * draw.gamma(1.0, 1.0, (len(unigram), PARTS))
    return Model(
        around(len(unigram), DIM, scale=0.5),
        around(DIM, 3 * DIM, scale=DIM**-0.5),
        np.zeros(WINDOW, np.float32),
        around(2 * DIM, HIDDEN, scale=(2 * DIM) ** -0.5),
        np.zeros(HIDDEN, np.float32),
        around(HIDDEN, PARTS, scale=HIDDEN**-0.5),
        np.zeros(PARTS, np.float32),
        (parts / parts.sum(0)).astype(np.float32),
    )


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first scored position, end of its text) of each window over texts laid end to end."""
    number = -(-lengths // STRIDE)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), number)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    return (ends - lengths)[owner] + place * STRIDE, ends[owner]


def laid(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each position, whether a window begins its text) with each text beginning at a multiple of STRIDE.

    So all windows follow each other at one distance and can share what their places have in common.
    """
    number = -(-lengths // STRIDE)
    before = np.cumsum(number) - number
    place = np.arange(lengths.sum()) + np.repeat(before * STRIDE - (np.cumsum(lengths) - lengths), lengths)
    lead = np.zeros(number.sum(), bool)
    lead[before] = True
    return place, lead


def _over_windows(values: np.ndarray) -> np.ndarray:
    """(windows, WINDOW, columns) of (CONTEXT + windows * STRIDE, columns): the windows overlap in memory."""
    places, columns = values.strides
    shape = ((len(values) - CONTEXT) // STRIDE, WINDOW, values.shape[1])
    return np.lib.stride_tricks.as_strided(values, shape, (STRIDE * places, places, columns))


# STRIDE x WINDOW: how far back a place lies, and 1 up to the query's own place, else 0
_BACK = (np.arange(STRIDE)[:, None] + CONTEXT) - np.arange(WINDOW)[None, :]
_CAUSAL = (_BACK >= 0).astype(np.float32)
_BACK = np.clip(_BACK, 0, WINDOW - 1)
_SCALE = np.float32(DIM**-0.5)
_ONES = np.ones(max(PARTS, WINDOW), np.float32)


def _exponential(values: np.ndarray) -> None:
    """exp in place; the bounds keep sums finite and above zero, and are far from trained values."""
    np.clip(values, -LIMIT, LIMIT, out=values)
    np.exp(values, out=values)


def _raised(values: np.ndarray) -> None:
    """exp in place, to 1.1 %, for weights that are divided by their own sum.

    2^t is near the float whose bits are (127 + t) * 2^23; the errors of exp(x/2) and
    1/exp(-x/2) made in this way have opposite signs.
    """
    np.clip(values, -LIMIT, LIMIT, out=values)
    values *= HALF_BITS
    bits = values.astype(np.int32)
    np.divide((ONE_BITS + bits).view(np.float32), (ONE_BITS - bits).view(np.float32), out=values)


def _row_sums(rows: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sums of their values); rows are below `size`, values have an even number of columns."""
    order = np.argsort(rows.astype(np.uint16 if size <= 1 << 16 else rows.dtype), kind="stable")
    ordered = rows[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    # two floats are added as one complex number: half as many short loops
    pairs = np.take(values, order, axis=0).view(np.result_type(values, np.complex64))
    return ordered[heads], np.add.reduceat(pairs, heads, axis=0).view(values.dtype)


def _attended(q: np.ndarray, k: np.ndarray, v: np.ndarray, distance: np.ndarray, lead: np.ndarray):
    """(shares not yet divided, 1 / their sums, what the queries see) of windows; `lead` ones see nothing before themselves."""
    shares = np.matmul(q, k.swapaxes(1, 2))
    shares += distance[_BACK]
    _exponential(shares)
    shares *= _CAUSAL
    shares[lead, :, :CONTEXT] = 0
    inverse = 1 / (shares.reshape(-1, WINDOW) @ _ONES[:WINDOW])[:, None]
    seen = np.matmul(shares, v).reshape(-1, DIM)
    seen *= inverse
    return shares, inverse, seen


def _mixture(h: np.ndarray, out: np.ndarray, out_bias: np.ndarray) -> np.ndarray:
    """The mixture's weights, not yet divided by their sum; `h` becomes the hidden layer's values."""
    np.maximum(h, 0, out=h)
    weights = h @ out
    flat = weights.reshape(-1, STRIDE * PARTS)
    flat += np.tile(out_bias, STRIDE)  # a long row at a time
    _exponential(weights)
    return weights


class Reader:
    """A model ready to read texts: what each subword brings to a window is computed once.

    Query, key, value and the current subword's share of the hidden layer depend on the id
    alone, so they are rows of one table.
    """

    def __init__(self, model: Model):
        self.model, self.parts = model, model.parts
        self.table = model.embed @ _near(model)
        self.table[:, 3 * DIM :] += model.hidden_bias

    def batches(self, ids: np.ndarray, targets: np.ndarray, lengths: np.ndarray):
        """(places, targets, weights, probabilities before division) of batches of windows.

        The last three have a row for each scored place of each window, places beyond a text
        included; `places` has -1 there.
        """
        model = self.model
        place, lead = laid(lengths)
        origin = np.full(len(lead) * STRIDE, -1)
        origin[place] = np.arange(len(ids))
        # CONTEXT places before the first text, which no window sees
        stream, goals = np.zeros(CONTEXT + len(origin), np.int64), np.zeros(len(origin), np.int64)
        stream[CONTEXT + place], goals[place] = ids, targets
        for a in range(0, len(lead), CHUNK):
            b = min(a + CHUNK, len(lead))
            known = np.take(self.table, stream[a * STRIDE : CONTEXT + b * STRIDE], axis=0)
            q = known[CONTEXT:, :DIM].reshape(b - a, STRIDE, DIM)
            k, v = (_over_windows(known[:, c : c + DIM]) for c in (DIM, 2 * DIM))
            _, _, seen = _attended(q, k, v, model.distance, lead[a:b])
            h = seen @ model.hidden[DIM:]
            h += known[CONTEXT:, 3 * DIM :]
            weights = _mixture(h, model.out, model.out_bias)
            goal = goals[a * STRIDE : b * STRIDE]
            top = np.einsum("ij,ij->i", weights, np.take(self.parts, goal, axis=0))
            yield origin[a * STRIDE : b * STRIDE], goal, weights, top

    def log_probabilities(self, ids: np.ndarray, targets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each target, given the ids up to its place."""
        out = np.zeros(len(ids), np.float32)
        for places, _, weights, top in self.batches(ids, targets, lengths):
            inside = places >= 0
            out[places[inside]] = np.log(top / (weights @ _ONES[:PARTS]))[inside]
        return out


class Expectation:
    """How often each part is expected to have given each subword, summed over texts.

    A part's share in a place is weight * part / top, and the part's factor is the same at all
    places with one target: it is multiplied in once, at the end.
    """

    def __init__(self, model: Model):
        self.reader = Reader(model)
        self.sums = np.zeros(model.parts.shape)

    def add(self, ids: np.ndarray, targets: np.ndarray, lengths: np.ndarray) -> None:
        for places, goal, weights, top in self.reader.batches(ids, targets, lengths):
            weights *= ((places >= 0) / top).astype(np.float32)[:, None]
            rows, values = _row_sums(goal, weights, len(self.sums))
            self.sums[rows] += values

    def counts(self) -> np.ndarray:
        return self.sums * self.reader.parts


def log_probabilities(model: Model, ids: np.ndarray, targets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return Reader(model).log_probabilities(ids, targets, lengths)


def _near(model: Model) -> np.ndarray:
    """DIM x (3 DIM + HIDDEN): from a subword to its query, already scaled, key, value and share of the hidden layer."""
    near = np.concatenate([model.project, model.hidden[:DIM]], axis=1)
    near[:, :DIM] *= _SCALE
    return near


def gradients(model: Model, ids: np.ndarray, targets: np.ndarray, first, end, start, sums: np.ndarray | None = None):
    """(mean loss, gradients of the weights) over windows; `start` is the first position of each one's text.

    The weights of the parts over the probability, by target, are added to `sums`: see `Expectation`.
    """
    n, in_windows = max(int(np.minimum(end - first, STRIDE).sum()), 1), (len(first), STRIDE)
    near, far = _near(model), model.hidden[DIM:]
    at = first[:, None] + np.arange(-CONTEXT, STRIDE)
    seen = np.take(ids, at, mode="clip").reshape(-1)
    x = np.take(model.embed, seen, axis=0)
    known = (x @ near).reshape(len(first), WINDOW, 3 * DIM + HIDDEN)
    own = known[:, CONTEXT:]
    q, k, v = own[:, :, :DIM], known[:, :, DIM : 2 * DIM], known[:, :, 2 * DIM : 3 * DIM]
    shares, inverse, context = _attended(q, k, v, model.distance, first == start)
    h = context @ far
    flat = h.reshape(len(first), -1)
    flat += np.tile(model.hidden_bias, STRIDE)
    by_window = h.reshape(*in_windows, HIDDEN)
    by_window += own[:, :, 3 * DIM :]
    weights = _mixture(h, model.out, model.out_bias)

    # the loss's slope by logits, n times: weight / sum - weight * part / total inside the texts
    query = first[:, None] + np.arange(STRIDE)
    inside = (query < end[:, None]).reshape(-1)
    goal = np.take(targets, query.reshape(-1), mode="clip")
    part = np.take(model.parts, goal, axis=0)
    total = np.maximum(np.einsum("ij,ij->i", weights, part), np.float32(1e-30))
    mean = (total / (weights @ _ONES[:PARTS]))[:, None]
    loss = -float(np.log(mean[:, 0])[inside].sum()) / n
    weights *= (inside / total)[:, None]
    d = np.subtract(mean, part, out=part)
    d *= weights
    if sums is not None:
        rows, values = _row_sums(goal, weights, len(sums))
        sums[rows] += values

    ones = _ONES[:1].repeat(len(d))
    g = {"out": h.T @ d, "out_bias": ones @ d}
    d_h = d @ model.out.T
    d_h *= h > 0
    g["hidden_bias"] = ones @ d_h
    d_context = d_h @ far.T
    d_context *= inverse
    drop = np.einsum("ij,ij->i", d_context, context).reshape(*in_windows, 1)
    d_context = d_context.reshape(*in_windows, DIM)
    d_shares = np.matmul(d_context, v.swapaxes(1, 2))
    d_shares -= drop
    d_shares *= shares
    g["distance"] = np.bincount(_BACK.ravel(), d_shares.reshape(-1, STRIDE * WINDOW).sum(0), WINDOW)
    d_known = np.empty_like(known)
    d_own = d_known[:, CONTEXT:]
    # places before a window have no query and no hidden layer in it
    d_known[:, :CONTEXT, :DIM] = 0
    d_known[:, :CONTEXT, 3 * DIM :] = 0
    np.matmul(d_shares, k, out=d_own[:, :, :DIM])
    np.matmul(d_shares.swapaxes(1, 2), q, out=d_known[:, :, DIM : 2 * DIM])
    np.matmul(shares.swapaxes(1, 2), d_context, out=d_known[:, :, 2 * DIM : 3 * DIM])
    d_own[:, :, 3 * DIM :] = d_h.reshape(*in_windows, HIDDEN)
    d_known = d_known.reshape(len(x), -1)
    d_near = x.T @ d_known
    d_near[:, :DIM] *= _SCALE
    g["project"] = d_near[:, : 3 * DIM]
    g["hidden"] = np.concatenate([d_near[:, 3 * DIM :], context.T @ d_h])
    g = {name: (values / n).astype(np.float32) for name, values in g.items()}
    rows, values = _row_sums(seen, d_known @ near.T, len(model.embed))
    g["embed"] = (rows, values / np.float32(n))
    return loss, g


def parts_from(counts: np.ndarray, unigram: np.ndarray, smoothing: float) -> np.ndarray:
    """Distributions from expected counts, each with `smoothing` counts of the unigram added."""
    parts = counts + smoothing * unigram[:, None]
    return (parts / parts.sum(0)).astype(np.float32)


def with_parts(model: Model, counts: np.ndarray, unigram: np.ndarray, smoothing: float) -> Model:
    return replace(model, parts=parts_from(counts, unigram, smoothing))


class Learner:
    """One task's part of a round of training: Adam from the round's weights, with its parts held still.

    `rows` marks the rows of the table of subwords that were moved; `counts` are the expected
    counts of the last pass over each slice.
    """

    def __init__(self, model: Model, rate: float = RATE, seed: int = 1):
        self.model, self.rate, self.step, self.windows = model, rate, 0, 0
        # the weights that every window moves lie in one array, and move at once
        self.others = np.concatenate([getattr(model, k).ravel() for k in OTHERS])
        self.weights, at = {"embed": model.embed.copy()}, 0
        for name in OTHERS:
            w = getattr(model, name)
            self.weights[name] = self.others[at : at + w.size].reshape(w.shape)
            at += w.size
        self.moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in (("embed", model.embed), ("others", self.others))}
        self.rows = np.zeros(len(model.embed), bool)
        self.sums = np.zeros(model.parts.shape)  # doubles: single floats stop counting at 2^24
        self.draw = np.random.default_rng(seed)

    @property
    def counts(self) -> np.ndarray:
        return self.sums * self.model.parts

    def read(self, ids: np.ndarray, targets: np.ndarray, lengths: np.ndarray, passes: int = 1, batch: int = BATCH) -> float:
        """Mean loss of the last pass over the texts."""
        first, end = windows(lengths)
        start = np.repeat(np.cumsum(lengths) - lengths, -(-lengths // STRIDE))
        self.windows += len(first)
        current = replace(self.model, **self.weights)
        sums = np.zeros(self.sums.shape, np.float32)
        for left in reversed(range(passes)):
            losses = []
            for own in np.array_split(self.draw.permutation(len(first)), max(1, len(first) // batch)):
                loss, g = gradients(current, ids, targets, first[own], end[own], start[own], None if left else sums)
                losses.append(loss)
                self._move(g)
        self.sums += sums
        return float(np.mean(losses))

    def _move(self, g: dict) -> None:
        self.step += 1
        # the moments start at zero in each round: the first steps are short
        speed = np.float32(self.rate * min(1.0, self.step / 50))
        rows, d = g["embed"]
        self.rows[rows] = True
        for name, own, w, d in (("embed", rows, self.weights["embed"], d), ("others", slice(None), self.others, np.concatenate([g[k].ravel() for k in OTHERS]))):
            mean, square = self.moments[name]
            m, s = mean[own], square[own]
            m *= np.float32(0.9)
            m += np.float32(0.1) * d
            s *= np.float32(0.98)
            s += np.float32(0.02) * (d * d)
            mean[own], square[own] = m, s
            w[own] -= speed * m / (np.sqrt(s) + np.float32(1e-8))

    def rows_out(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kind, row, PARTS numbers each): moved subwords, counts, all other weights; to be summed.

        Weights are multiplied by the number of windows, which is the last row of its own kind.
        """
        counts = self.counts
        embed, counted = np.flatnonzero(self.rows), np.flatnonzero(counts.any(axis=1))
        moved = np.zeros((len(embed), PARTS))
        moved[:, :DIM] = self.weights["embed"][embed]
        moved[:, DIM] = 1
        other = np.concatenate([self.weights[k].ravel() for k in OTHERS])
        other = np.append(other, np.ones(PARTS - len(other) % PARTS)).reshape(-1, PARTS)
        kind = np.repeat([0, 1, 2], [len(embed), len(counted), len(other)])
        row = np.concatenate([embed, counted, np.arange(len(other))])
        return kind, row, np.concatenate([moved * self.windows, counts[counted], other * self.windows])


def averaged(model: Model, kind: np.ndarray, row: np.ndarray, sums: np.ndarray, unigram: np.ndarray, smoothing: float) -> Model:
    """The model after a round, from the summed rows of its learners; each moved row is the mean of those who moved it."""
    embed = model.embed.copy()
    own = kind == 0
    embed[row[own]] = sums[own, :DIM] / sums[own, DIM : DIM + 1]
    counts = np.zeros(model.parts.shape)
    counts[row[kind == 1]] = sums[kind == 1]
    other = sums[kind == 2][np.argsort(row[kind == 2])].ravel()
    other = (other / other[-1]).astype(np.float32)
    weights, at = {}, 0
    for name in OTHERS:
        shape = getattr(model, name).shape
        weights[name] = other[at : at + int(np.prod(shape))].reshape(shape)
        at += int(np.prod(shape))
    return with_parts(replace(model, embed=embed, **weights), counts, unigram, smoothing)


def rate_of(number: int) -> float:
    """The step size of a round: from `RATE` down to a tenth, where it stays."""
    return RATE * max(0.1, 1 - 0.9 * number / max(1, ROUNDS - 1))
