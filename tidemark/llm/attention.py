"""A small causal self-attention model over subword ids, in numpy.

The next id is predicted in two steps: its class, and the id within its class. Corpus counts of
ids after groups of ids give both a first estimate; one block of masked attention with one
hidden layer, which sees the context window, corrects the estimate of the class. Classes and
groups hold about equal shares of all ids counted, so frequent ids stand for themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

WIDTH = 16
HIDDEN = 16
INPUTS = 32  # context window
TARGETS = 24  # of a window's last positions the next id is scored; windows overlap by the rest
AHEAD = INPUTS - TARGETS
CLASSES = 32
GROUPS = 1024
PRIOR = 5.0
BATCH = 128
RATE = 0.01


class Vocabulary:
    """Classes of ids from counts of all ids.

    ``final`` tells which ids end a word; no class mixes them with others, so that the classes
    show the context where words end.
    """

    def __init__(self, counts: np.ndarray, final: np.ndarray, classes: int = CLASSES):
        smooth = counts + 0.5
        self.of = np.zeros(len(counts), np.int64)
        shares = [smooth[final == kind].sum() / smooth.sum() for kind in (False, True)]
        given = [max(1, min(classes - 1, round(classes * shares[0])))]
        given.append(classes - given[0])
        self.count = 0
        for kind, number, part in zip((False, True), given, shares):
            ids = np.flatnonzero(final == kind)
            if not len(ids):
                continue
            order = ids[np.argsort(-smooth[ids], kind="stable")]
            before = np.cumsum(smooth[order]) - smooth[order]
            raw = np.minimum((before / smooth[ids].sum() * number).astype(np.int64), number - 1)
            self.of[order] = self.count + np.unique(raw, return_inverse=True)[1]
            self.count = int(self.of[order].max()) + 1
        within = np.bincount(self.of, smooth, self.count)
        self.within = smooth / within[self.of]


def finest(counts: np.ndarray, final: np.ndarray, limit: int = GROUPS) -> Vocabulary:
    """The finest of halved cuts that has no more than ``limit`` groups of ids."""
    number, found = limit, Vocabulary(counts, final, limit)
    while number < 64 * limit:
        number *= 2
        finer = Vocabulary(counts, final, number)
        if finer.count > limit:
            break
        found = finer
    return found


class Model:
    """What the corpus counts say, and how ids enter the attention.

    ``keys`` are ``group * ids + id`` with the number of times the id follows the group. The tables
    have a row for each group: the log of each class's probability, and log10 of each id's in its
    class. An id that was never counted shares the last column of its class's tables, so the size is
    that of groups x ids whatever the corpus.
    """

    def __init__(self, counts: np.ndarray, final: np.ndarray, keys: np.ndarray, times: np.ndarray):
        classes, n = Vocabulary(counts, final), len(counts)
        self.class_of, self.group_of = classes.of, finest(counts, final).of
        # Columns for the ids counted, one more for all others.
        there = np.flatnonzero(counts)
        self.column = np.full(n, len(there), np.int32)
        self.column[there] = np.arange(len(there))
        self.rare = np.log10(classes.within)  # of an id never counted
        group, follower = keys // n, keys % n
        of = self.class_of[follower]
        cell = np.bincount(group * CLASSES + of, times, GROUPS * CLASSES).reshape(GROUPS, CLASSES)
        share = np.bincount(self.class_of, counts + 0.5, CLASSES)
        share = share / share.sum()
        kinds = (cell > 0).sum(axis=1, keepdims=True) + 1.0
        log = np.log(np.maximum((cell + kinds * share) / (cell.sum(axis=1, keepdims=True) + kinds), 1e-30))
        self.class_log = log.astype(np.float32)
        within = np.zeros((GROUPS, len(there) + 1), np.float32)
        within[group, self.column[follower]] = times
        within[:, :-1] += (PRIOR * classes.within[there]).astype(np.float32)
        within[:, -1] = 1
        total = np.log10(cell + PRIOR).astype(np.float32)
        np.log10(within, out=within)
        for start in range(0, GROUPS, 64):  # in strips, as the whole would take twice the room
            strip = slice(start, start + 64)
            within[strip, :-1] -= total[strip][:, self.class_of[there]]
        self.within_log = within
        self.total_log = np.float32(np.log10(PRIOR)) - total

    def log_within(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Log10 probability of each id in its class after a group of ids."""
        column = self.column[ids]
        width = self.within_log.shape[1]
        found = self.within_log.ravel()[before * width + column].astype(np.float64)
        unseen = column == width - 1
        if unseen.any():
            some = ids[unseen]
            found[unseen] = self.rare[some] + self.total_log[before[unseen], self.class_of[some]]
        return found


_KEPT: dict[str, Model] = {}


def kept(name: str, build) -> Model:
    """The model of this name, which a worker process keeps from task to task; the last one only."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = build()
    return _KEPT[name]


SHAPES = {
    "group_in": (GROUPS, WIDTH), "place": (INPUTS, WIDTH),
    "wq": (WIDTH, WIDTH), "wk": (WIDTH, WIDTH), "wv": (WIDTH, WIDTH), "wo": (WIDTH, WIDTH),
    "w1": (WIDTH, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, WIDTH),
    "out": (WIDTH, CLASSES), "bias": (CLASSES,),
}


def initial(seed: int = 7) -> np.ndarray:
    """Starting parameters: the correction is zero."""
    random = np.random.default_rng(seed)
    parts = {n: random.normal(0, 0.3, s) if n in ("group_in", "place") else random.normal(0, 0.25, s) for n, s in SHAPES.items()}
    parts["b1"], parts["bias"], parts["out"] = np.zeros(HIDDEN), np.zeros(CLASSES), np.zeros((WIDTH, CLASSES))
    return np.concatenate([parts[n].ravel() for n in SHAPES]).astype(np.float32)


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of one parameter vector by name."""
    found, start = {}, 0
    for name, shape in SHAPES.items():
        size = math.prod(shape)
        found[name] = flat[start : start + size].reshape(shape)
        start += size
    return found


# Added to the scores: a target sees the inputs up to its own place.
FUTURE = np.where(np.arange(INPUTS)[None, :] > np.arange(AHEAD, INPUTS)[:, None], -1e9, 0).astype(np.float32)


# Scores and logits are cut here, far above what training gives, so that no exponential overflows.
CEILING = 60.0


class Room:
    """Arrays by name that every batch uses again, as making them anew would cost as much as filling them."""

    def __init__(self):
        self.kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple, kind) -> np.ndarray:
        size = math.prod(shape)
        found = self.kept.get(name)
        if found is None or found.size < size or found.dtype != kind:
            found = self.kept[name] = np.empty(size, kind)
        return found[:size].reshape(shape)

    def product(self, name: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The matrix product of ``a`` and ``b``, as the array of this name."""
        return np.matmul(a, b, out=self(name, (*a.shape[:-1], b.shape[-1]), a.dtype))


def _cut(values: np.ndarray) -> None:
    if values.size and values.max() > CEILING:
        np.minimum(values, CEILING, out=values)


def _ones(count: int, like: np.ndarray) -> np.ndarray:
    return np.ones((count, 1), like.dtype)


def forward(p: dict, groups: np.ndarray, model: Model, room: Room | None = None) -> dict:
    """Log-probabilities of the next class at the last positions of each window, and what led there."""
    found = _states(p, groups, model, room or Room())
    return {**found, "log": found["logits"] - np.log(found["total"])}


def _states(p: dict, groups: np.ndarray, model: Model, room: Room) -> dict:
    """What leads to the probabilities of classes.

    ``weights`` are those of the attention, and ``share`` those of the classes, before they are divided
    by ``norm`` and ``total``, their sums. Keys and values are linear in the inputs, so their matrices
    are multiplied into those of queries and outputs, and the attention meets the inputs themselves.
    """
    n, kind = len(groups), p["wq"].dtype
    positions = n * TARGETS
    product = room.product
    x = np.take(p["group_in"], groups, axis=0, out=room("x", (n, INPUTS, WIDTH), kind), mode="clip")
    x += p["place"]
    across = room("across", (n, WIDTH, INPUTS), kind)
    across[:] = x.transpose(0, 2, 1)
    last = room("last", (positions, WIDTH), kind)
    last.reshape(n, TARGETS, WIDTH)[:] = x[:, AHEAD:]
    query = p["wq"] @ p["wk"].T * kind.type(WIDTH**-0.5)
    value = p["wv"] @ p["wo"]
    q = product("q", last, query).reshape(n, TARGETS, WIDTH)
    weights = product("weights", q, across)
    weights += FUTURE
    _cut(weights)
    np.exp(weights, out=weights)
    norm = weights.reshape(-1, INPUTS) @ _ones(INPUTS, weights)
    mean = product("mean", weights, x).reshape(-1, WIDTH)
    mean /= norm
    y = product("y", mean, value)
    y += last
    hidden = product("hidden", y, p["w1"])
    wide = hidden.reshape(n, -1)  # few long rows are added to faster than many short ones
    wide += np.tile(p["b1"], TARGETS)
    np.maximum(hidden, 0, out=hidden)
    z = product("z", hidden, p["w2"])
    z += y
    logits = product("logits", z, p["out"])
    prior = model.class_log + p["bias"]
    logits += np.take(prior, groups[:, AHEAD:].ravel(), axis=0, out=room("prior", logits.shape, prior.dtype), mode="clip")
    _cut(logits)
    share = np.exp(logits, out=room("share", logits.shape, kind))
    total = share @ _ones(CLASSES, share)
    return {"x": x, "across": across, "last": last, "query": query, "value": value, "q": q, "weights": weights,
            "norm": norm, "mean": mean, "y": y, "hidden": hidden, "z": z, "logits": logits, "share": share,
            "total": total}


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of tall arrays, in strips that stay near."""
    strips = [v.reshape(TARGETS, -1, v.shape[1]) for v in (a, b)]
    return (strips[0].transpose(0, 2, 1) @ strips[1]).sum(axis=0)


# Where the numbers of a group lie among those of all.
CELLS = np.arange(GROUPS * WIDTH).reshape(GROUPS, WIDTH)


def gradient(flat: np.ndarray, groups, target, scored, model: Model, room: Room | None = None) -> tuple[float, np.ndarray]:
    """Mean loss over the scored positions of a batch of windows, and its gradient."""
    room = room or Room()
    f = _states(unpacked(flat), groups, model, room)
    on = scored.ravel()
    wanted = np.arange(0, len(on) * CLASSES, CLASSES) + target.ravel()
    loss = float((np.log(f["total"][:, 0]) - f["logits"].reshape(-1)[wanted])[on].sum()) / max(int(on.sum()), 1)
    return loss, slope(flat, groups, target, scored, f, room)


def slope(flat: np.ndarray, groups, target, scored, f: dict, room: Room) -> np.ndarray:
    """The gradient of the mean loss, from what ``_states`` found; it is written over that."""
    p, count, kind = unpacked(flat), len(groups), flat.dtype
    grad = np.zeros_like(flat)
    g = unpacked(grad)
    product = room.product

    def back(name, a, b):
        return product(name, a, np.ascontiguousarray(b.T))

    on = scored.ravel()
    n = max(int(on.sum()), 1)
    wanted = np.arange(0, len(on) * CLASSES, CLASSES) + target.ravel()
    each = on / kind.type(n)
    d = f["share"]
    d *= each[:, None] / f["total"]
    d.reshape(-1)[wanted] -= each
    ones = _ones(len(on), d)[:, 0]
    g["out"][:] = _inner(f["z"], d)
    g["bias"][:] = ones @ d
    dz = back("dz", d, p["out"])
    dh = back("dh", dz, p["w2"])
    dh *= f["hidden"] > 0
    g["w2"][:] = _inner(f["hidden"], dz)
    g["w1"][:] = _inner(f["y"], dh)
    g["b1"][:] = ones @ dh
    dy = back("dy", dh, p["w1"])
    dy += dz
    dvalue = _inner(f["mean"], dy)
    g["wv"][:] = dvalue @ p["wo"].T
    g["wo"][:] = p["wv"].T @ dvalue
    dmean = back("dmean", dy, f["value"])
    dmean /= f["norm"]
    # The mean of ds under the weights is the product with the mean input.
    level = np.einsum("ij,ij->i", dmean, f["mean"]).reshape(count, TARGETS, 1)
    dmean = dmean.reshape(count, TARGETS, WIDTH)
    ds = product("ds", dmean, f["across"])
    ds -= level
    ds *= f["weights"]
    dq = product("dq", ds, f["x"]).reshape(-1, WIDTH)
    dquery = _inner(f["last"], dq) * kind.type(WIDTH**-0.5)
    g["wq"][:] = dquery @ p["wk"]
    g["wk"][:] = dquery.T @ p["wq"]
    dx = product("dx", f["weights"].transpose(0, 2, 1), dmean)
    dx += product("dx of q", ds.transpose(0, 2, 1), f["q"])
    dy += back("dlast", dq, f["query"])
    dx[:, AHEAD:] += dy.reshape(count, TARGETS, WIDTH)
    g["place"][:] = (_ones(count, dx).T @ dx.reshape(count, -1)).reshape(INPUTS, WIDTH)
    cells = np.take(CELLS, groups, axis=0, out=room("cells", (*groups.shape, WIDTH), CELLS.dtype), mode="clip")
    g["group_in"][:] = np.bincount(cells.ravel(), dx.ravel(), GROUPS * WIDTH).reshape(GROUPS, WIDTH)
    return grad


class Trainer:
    """Adam over batches of windows, as ``windowed`` gives them."""

    def __init__(self, flat: np.ndarray, model: Model, rate: float = RATE, batch: int = BATCH):
        self.flat, self.model, self.rate, self.batch = flat.copy(), model, rate, batch
        self.mean, self.square = np.zeros_like(flat), np.zeros_like(flat)
        self.step = 0
        self.windows = 0
        self.room = Room()

    def train(self, windows) -> None:
        ids, target, scored = windows
        order = np.random.default_rng(self.windows).permutation(len(ids))
        for start in range(0, len(ids), self.batch):
            part = order[start : start + self.batch]
            groups, wanted = self.model.group_of[ids[part]], self.model.class_of[target[part]]
            found = _states(unpacked(self.flat), groups, self.model, self.room)
            self._follow(slope(self.flat, groups, wanted, scored[part], found, self.room))
        self.windows += len(ids)

    def _follow(self, grad: np.ndarray) -> None:
        """One step of Adam, in the arrays there are."""
        self.step += 1
        step, scale = (self.room(name, grad.shape, grad.dtype) for name in ("step", "scale"))
        np.subtract(grad, self.mean, out=step)
        step *= 0.1
        self.mean += step
        np.multiply(grad, grad, out=step)
        step -= self.square
        step *= 0.01
        self.square += step
        np.divide(self.square, 1 - 0.99**self.step, out=scale)
        np.sqrt(scale, out=scale)
        scale += 1e-8
        np.divide(self.mean, 1 - 0.9**self.step, out=step)
        step *= self.rate
        step /= scale
        self.flat -= step


def windowed(sequence: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of a sequence, ``(ids, target, scored)``.

    ``begin`` stands before the first id. Every id of the sequence is a scored target of
    exactly one window, after at least ``AHEAD`` earlier inputs where there are any.
    """
    n = len(sequence)
    count = -(-n // TARGETS)
    padded = np.full(AHEAD + count * TARGETS, begin, sequence.dtype)
    padded[AHEAD + 1 : AHEAD + n] = sequence[:-1]
    target = np.full(count * TARGETS, begin, sequence.dtype)
    target[:n] = sequence
    scored = np.arange(count * TARGETS) < n
    ids = np.lib.stride_tricks.sliding_window_view(padded, INPUTS)[::TARGETS]
    return ids, target.reshape(count, TARGETS), scored.reshape(count, TARGETS)


def gathered(texts: list[np.ndarray], parts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Some windows of many texts, as ``windowed`` gives them with ``end`` before and after each text.

    ``parts`` has the numbers of the windows wanted of each text, one at least, in ascending order.
    """
    number = np.concatenate(parts)
    wanted = [len(part) for part in parts]
    lows, highs = np.array([part[0] for part in parts]), np.array([part[-1] + 1 for part in parts])
    tops = np.cumsum(highs - lows) - (highs - lows)
    total = int((highs - lows).sum()) * TARGETS
    inputs = np.full(total + len(parts) * AHEAD, end, texts[0].dtype)
    target = np.full(total, end, texts[0].dtype)
    for i, (text, low, high, top) in enumerate(zip(texts, lows.tolist(), highs.tolist(), tops.tolist())):
        some = text[low * TARGETS : high * TARGETS]
        target[top * TARGETS : top * TARGETS + len(some)] = some
        before = AHEAD + 1 - low * TARGETS
        some = text[max(-before, 0) : high * TARGETS - 1]
        at = top * TARGETS + i * AHEAD + max(before, 0)
        inputs[at : at + len(some)] = some
    places = number + np.repeat(tops - lows, wanted)
    starts = places * TARGETS + np.repeat(np.arange(len(parts)) * AHEAD, wanted)
    left = np.repeat([len(text) + 1 for text in texts], wanted) - number * TARGETS
    ids = np.lib.stride_tricks.sliding_window_view(inputs, INPUTS)[starts]
    return ids, target.reshape(-1, TARGETS)[places], np.arange(TARGETS) < left[:, None]


class Scorer:
    """A trained model made ready to score windows, with the results of ``forward``.

    Up to the softmax and the hidden layer all is linear, so a position's projections are those of
    its group plus those of its place: both are computed once, and the output matrices are
    multiplied into those before them. Where sums of the largest entries show that neither scores
    nor logits can reach ``CEILING``, they are not cut.
    """

    def __init__(self, flat: np.ndarray, model: Model):
        p, self.model, self.room = unpacked(flat), model, Room()
        query = p["wq"] * p["wq"].dtype.type(WIDTH**-0.5)
        mixed = p["wv"] @ p["wo"]
        late = p["w2"] @ p["out"]
        self.inner = p["w1"]
        self.outer = np.concatenate([p["out"], late])
        self.mask = FUTURE.astype(flat.dtype)
        ways = {"key": p["wk"], "value": mixed, "query": query, "hidden": p["w1"], "logit": p["out"]}
        self.group = {n: p["group_in"] @ way for n, way in ways.items()}
        self.place = {n: p["place"] @ way for n, way in ways.items()}
        self.group["hidden"] += p["b1"]
        self.group["logit"] += p["bias"] + model.class_log
        for name in ("query", "hidden", "logit"):
            self.place[name] = self.place[name][AHEAD:]

        def most(name, of=np.abs):
            return of(self.group[name]).max(axis=0) + of(self.place[name]).max(axis=0)

        seen = most("value")
        hidden = np.maximum(most("hidden", np.positive) + seen @ np.abs(p["w1"]), 0)
        logit = most("logit", np.positive) + np.concatenate([seen, hidden]) @ np.abs(self.outer)
        self.cut_scores = bool(most("query") @ most("key") > CEILING)
        self.cut_logits = bool(logit.max() > CEILING)

    def _at(self, name: str, groups: np.ndarray) -> np.ndarray:
        table = self.group[name]
        found = np.take(table, groups, axis=0, out=self.room(name, (*groups.shape, table.shape[1]), table.dtype), mode="clip")
        found += self.place[name]
        return found

    def class_log(self, groups: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log-probability of the given class at each of the last positions of windows."""
        product = self.room.product
        last = np.ascontiguousarray(groups[:, AHEAD:])
        keys = self._at("key", groups)
        across = self.room("across", (len(groups), WIDTH, INPUTS), keys.dtype)
        across[:] = keys.transpose(0, 2, 1)
        weights = product("weights", self._at("query", last), across)
        weights += self.mask
        if self.cut_scores:
            np.minimum(weights, CEILING, out=weights)
        np.exp(weights, out=weights)
        norm = weights.reshape(-1, INPUTS) @ _ones(INPUTS, weights)
        seen = product("seen", weights, self._at("value", groups)).reshape(-1, WIDTH)
        both = self.room("both", (len(seen), WIDTH + HIDDEN), seen.dtype)
        seen = np.divide(seen, norm, out=both[:, :WIDTH])
        hidden = product("inner", seen, self.inner)
        hidden += self._at("hidden", last).reshape(-1, HIDDEN)
        np.maximum(hidden, 0, out=both[:, WIDTH:])
        log = product("log", both, self.outer)
        log += self._at("logit", last).reshape(-1, CLASSES)
        if self.cut_logits:
            np.minimum(log, CEILING, out=log)
        chosen = np.take(log.ravel(), np.arange(0, log.size, CLASSES) + classes)
        np.exp(log, out=log)
        return chosen - np.log(log @ _ones(CLASSES, log))[:, 0]


def scored_windows(
    flat: np.ndarray, model: Model, windows, batch: int = BATCH, scorer: Scorer | None = None
) -> Iterator[np.ndarray]:
    """Log10 probability of the scored ids of each window, batch after batch.

    ``scorer`` is that of ``flat`` and ``model``, if there is one already.
    """
    scorer = scorer or Scorer(flat, model)
    ids, target, scored = windows
    for start in range(0, len(ids), batch):
        part = slice(start, start + batch)
        groups, wanted = model.group_of[ids[part]], target[part].ravel()
        chosen = scorer.class_log(groups, model.class_of[wanted]).astype(np.float64)
        total = chosen / np.log(10) + model.log_within(groups[:, AHEAD:].ravel(), wanted)
        yield np.where(scored[part], total.reshape(-1, TARGETS), 0.0).sum(axis=1)
