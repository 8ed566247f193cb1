"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its own hashed vector plus the mean of the hashed vectors of
its character n-grams. Two gated recurrent passes run over a window of words,
attention pools their states, and a linear layer gives the window's logit. All
overlapping windows of a text are scored; the text's score is its strongest
window, put on a probability scale. The network is trained in numpy, in one task, on a bounded
sample of labelled rows (``SAMPLE`` rows, smallest id hashes first), whole texts
of them, the text's label teaching its strongest window. The probability scale is
fitted on the same strongest windows that scoring takes.

Defined cases: null and empty texts (and texts without words) get the score of
the bias alone; null labels and ids are not learned from; repeated rows count as
often as they occur; without labelled rows of both kinds every score is 0; a
long text costs memory for its words only, windows are scored in blocks. Only the named
columns are read; label, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import free_name, text_of

SAMPLE, LEAST_STEPS = 4000, 120
WINDOW, STRIDE = 32, 16
BUCKETS, DIM, HIDDEN = 1 << 16, 12, 8
NGRAMS = (3, 5)
WORD = re.compile(r"\w+")
BLOCK = 4096
WORDS = 200_000


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slots of all words and n-grams, flat, and where each word's begin: the word first, then its n-grams."""
    text = [b"^" + w.encode("utf-8", "surrogatepass") + b"$" for w in words]
    size = np.array([len(t) for t in text], np.int64)
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(text), np.uint8).astype(np.uint64) + np.uint64(1)
    power = np.uint64(0x9E3779B97F4A7C15)
    scaled = np.empty(len(flat), np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    left = size[word] - (np.arange(len(flat)) - begin[word])  # bytes up to the word's end
    slots, owner = [], []
    with np.errstate(over="ignore"):
        for n in NGRAMS:
            h = np.full(len(flat), n, np.uint64)
            for i in range(n):
                scaled[: len(flat) - i], scaled[len(flat) - i :] = flat[i:], 0
                h = (h ^ scaled) * power
                h ^= h >> np.uint64(29)
            keep = left >= n
            slots.append(h[keep])
            owner.append(word[keep])
        where = (np.arange(len(flat)) - begin[word]).astype(np.uint64)
        mixed = (flat * power ^ (where + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F)) * power
        mixed ^= mixed >> np.uint64(31)
        whole = np.add.reduceat(mixed, begin) * power
        slots.append(whole ^ whole >> np.uint64(32))
        owner.append(np.arange(len(words)) - 0.5)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    flat_slots = (np.concatenate(slots)[order] % np.uint64(BUCKETS)).astype(np.int64)
    return flat_slots, np.searchsorted(owner[order], np.arange(len(words)) - 0.5)


def shares(begin: np.ndarray, total: int) -> np.ndarray:
    """Weight of each slot in its word's vector: 1 for the word, 1/m for each of m n-grams."""
    count = np.diff(np.append(begin, total))
    share = np.repeat(1.0 / np.maximum(count - 1, 1), count).astype(np.float32)
    share[begin] = 1
    return share


def inputs(table: np.ndarray, words: list[str]) -> np.ndarray:
    """Vectors of words, some thousand at a time."""
    out = [np.zeros((0, table.shape[1]), np.float32)]
    for i in range(0, len(words), 20_000):
        slots, begin = features(words[i : i + 20_000])
        out.append(np.add.reduceat(table[slots] * shares(begin, len(slots))[:, None], begin))
    return np.concatenate(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _gates(net: dict, x: np.ndarray, d: str) -> np.ndarray:
    """Input part of the gates for each word; the last row is padding, which leaves the state alone."""
    g = np.append(x @ net["W" + d] + net["b" + d], np.zeros((1, 3 * HIDDEN), np.float32), axis=0)
    g[-1, :HIDDEN] = -30
    return g


def _run(gates: np.ndarray, net: dict, d: str, index: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (step, window, hidden) of one direction; ``index`` has a row for each window."""
    steps = range(index.shape[1]) if d == "f" else range(index.shape[1] - 1, -1, -1)
    h, out, u, un = np.zeros((len(index), HIDDEN), np.float32), np.empty((index.shape[1], len(index), HIDDEN), np.float32), net["U" + d], net["V" + d]
    for t in steps:
        g = gates[index[:, t]]
        zr = _sigmoid(g[:, : 2 * HIDDEN] + h @ u)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        rh = r * h
        n = np.tanh(g[:, 2 * HIDDEN :] + rh @ un)
        if keep is not None:
            keep.append((t, h, z, r, n, rh))
        h = h + z * (n - h)
        out[t] = h
    return out


def _pool(net: dict, states: np.ndarray, pad: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = states @ net["a"]
    a[pad] = -1e9
    a = np.exp(a - a.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", a, states)
    return a, pooled, pooled @ net["o"] + net["c"]


def logits(net: dict, gates: tuple[np.ndarray, np.ndarray], index: np.ndarray) -> np.ndarray:
    """Logit of each window (rows of word numbers, -1 as padding)."""
    out = np.empty(len(index), np.float32)
    for i in range(0, len(index), BLOCK):
        part = index[i : i + BLOCK]
        states = np.concatenate([_run(g, net, d, part) for g, d in zip(gates, "fb")], axis=2)
        out[i : i + BLOCK] = _pool(net, states, part.T < 0)[2]
    return out


def strongest(net: dict, x: np.ndarray, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit of each text's strongest window (the first of equals) and its word numbers, -1 as padding, over all overlapping
    windows, a block at a time; the texts' word numbers, rows of ``x``, lie end to end."""
    gates = tuple(_gates(net, x, d) for d in "fb")
    count = -(-np.maximum(1, sizes - (WINDOW - STRIDE)) // STRIDE)
    ends, first, padded = np.cumsum(count), np.cumsum(sizes) - sizes, np.append(numbers, -1)
    best, rows = np.full(len(sizes), -np.inf, np.float32), np.full((len(sizes), WINDOW), -1, np.int64)
    for lo in range(0, int(count.sum()), BLOCK):
        at = np.arange(lo, min(lo + BLOCK, int(ends[-1])))
        owner = np.searchsorted(ends, at, side="right")
        within = ((at - (ends - count)[owner]) * STRIDE)[:, None] + np.arange(WINDOW)
        index = padded[np.where(within < sizes[owner][:, None], first[owner][:, None] + within, len(numbers))]
        guess = logits(net, gates, index)
        order = np.lexsort((-guess, owner))
        order = order[np.append(True, np.diff(owner[order]) > 0)]
        order = order[guess[order] > best[owner[order]]]
        best[owner[order]], rows[owner[order]] = guess[order], index[order]
    return best, rows


def blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of texts with some ``WORDS`` words together, at least one text each."""
    ends, i = np.cumsum(sizes), 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + WORDS, side="right")))
        yield slice(i, j)
        i = j


def _backward(net: dict, x: np.ndarray, index: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weighted logistic loss over windows, and those of the words' inputs."""
    gates, kept, states = {}, {"f": [], "b": []}, []
    for d in "fb":
        gates[d] = _gates(net, x, d)
        states.append(_run(gates[d], net, d, index, kept[d]))
    states = np.concatenate(states, axis=2)
    a, pooled, logit = _pool(net, states, index.T < 0)
    d_logit = ((_sigmoid(logit) - y) * weight).astype(np.float32)
    grad = {"o": pooled.T @ d_logit, "c": np.float32(d_logit.sum())}
    d_pooled = d_logit[:, None] * net["o"]
    d_a = np.einsum("tbh,bh->tb", states, d_pooled)
    d_score = a * (d_a - (a * d_a).sum(axis=0))
    d_states = a[:, :, None] * d_pooled + d_score[:, :, None] * net["a"]
    grad["a"] = np.einsum("tb,tbh->h", d_score, states)
    d_x = np.zeros_like(x)
    for d, part in zip("fb", (slice(0, HIDDEN), slice(HIDDEN, None))):
        u, un = net["U" + d], net["V" + d]
        d_u, d_un, d_g, carry = np.zeros_like(u), np.zeros_like(un), np.zeros_like(gates[d]), np.zeros((len(index), HIDDEN), np.float32)
        for t, h, z, r, n, rh in reversed(kept[d]):
            dh = d_states[t][:, part] + carry
            dn = dh * z * (1 - n * n)
            d_rh = dn @ un.T
            dzr = np.concatenate([dh * (n - h) * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
            carry = dh * (1 - z) + d_rh * r + dzr @ u.T
            d_u += h.T @ dzr
            d_un += rh.T @ dn
            np.add.at(d_g, index[:, t], np.concatenate([dzr, dn], axis=1))
        grad |= {"U" + d: d_u, "V" + d: d_un, "W" + d: x.T @ d_g[:-1], "b" + d: d_g[:-1].sum(axis=0)}
        d_x += d_g[:-1] @ net["W" + d].T
    return grad, d_x


def train(texts: list[str], labels: np.ndarray, epochs: int = 4, seed: int = 7) -> dict | None:
    """The network and its probability scale; None without texts of both kinds."""
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    vocabulary = Numbers()
    numbers = [np.array([vocabulary[w] for w in WORD.findall(text.lower())], np.int64) for text in texts]
    sizes = np.array([len(n) for n in numbers], np.int64)
    slots, begin = features(list(vocabulary) or ["-"])
    share = shares(begin, len(slots))
    count = np.diff(np.append(begin, len(slots)))

    def local(index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of some texts or windows renumbered densely; the slots, shares and first slots of those words."""
        used, inverse = np.unique(index, return_inverse=True)
        inverse = inverse.reshape(index.shape)
        if len(used) and used[0] < 0:
            used, inverse = used[1:], inverse - 1
        first = np.cumsum(count[used]) - count[used]
        flat = np.arange(count[used].sum()) - np.repeat(first - begin[used], count[used])
        return inverse, slots[flat], share[flat], first

    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    net = {"E": rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32), "a": small(2 * HIDDEN), "o": small(2 * HIDDEN), "c": np.float32(-1)}
    for d in "fb":
        net |= {"W" + d: small(DIM, 3 * HIDDEN), "U" + d: small(HIDDEN, 2 * HIDDEN), "V" + d: small(HIDDEN, HIDDEN), "b" + d: np.zeros(3 * HIDDEN, np.float32)}
    # The first input dimension starts from how much likelier a slot is in toxic texts.
    seen = np.zeros((2, BUCKETS), np.float32)
    for words, label in zip(numbers, y):
        seen[int(label), np.unique(local(words)[1])] += 1
    rate = (seen + 0.5) / (np.bincount(y.astype(int), minlength=2)[:, None] + 1)
    surprise = np.log(rate[1] / rate[0]) * np.minimum(1, seen[1] / 8)
    net["E"][:, 0] = np.clip(surprise, -1, 3)
    m, v = {k: 0.0 for k in net}, {k: 0.0 for k in net}
    step, balance = 0, np.where(y > 0, min(4.0, (1 - y.mean()) / y.mean()), 1.0)

    def move(k: str, g: np.ndarray, rate: float) -> None:
        m[k] = 0.9 * m[k] + 0.1 * g
        v[k] = 0.99 * v[k] + 0.01 * g * g
        net[k] = np.asarray(net[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6), np.float32)

    def vectors(at: np.ndarray, part: np.ndarray, first: np.ndarray) -> np.ndarray:
        out, ends = [np.zeros((0, DIM), np.float32)], np.append(first, len(at))
        for i in range(0, len(first), 20_000):
            lo, hi = ends[i], ends[min(i + 20_000, len(first))]
            out.append(np.add.reduceat(net["E"][at[lo:hi]] * part[lo:hi, None], first[i : i + 20_000] - lo))
        return np.concatenate(out)

    def strongest_of(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit and words of the strongest window of some texts, over all their windows."""
        best, rows = [], []
        for span in blocks(sizes[some]):
            flat = np.concatenate([numbers[i] for i in some[span]])
            index, at, part, first = local(flat)
            guess, row = strongest(net, vectors(at, part, first), index, sizes[some[span]])
            best.append(guess)
            rows.append(np.append(np.unique(flat), -1)[row])
        return np.concatenate(best), np.concatenate(rows)

    batches = max(1, len(y) // 128)
    rounds = max(epochs, -(-LEAST_STEPS // batches))
    for epoch in range(rounds):
        for some in np.array_split(rng.permutation(len(y)), batches):
            index, at, part, first = local(strongest_of(some)[1])
            grad, d_x = _backward(net, vectors(at, part, first), index, y[some], balance[some] / len(some))
            step += 1
            for k, g in grad.items():
                move(k, g, 0.02 * 0.25 ** (epoch / rounds))
            d_e = d_x[np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))] * part[:, None]
            np.subtract.at(net["E"], at, np.float32(0.5) * np.clip(d_e, -1, 1))
    net["scale"] = _platt(strongest_of(np.arange(len(y)))[0].astype(float), y)
    return net


def _platt(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve of the label over the score, by Newton steps with a light penalty."""
    x, w = np.column_stack([s, np.ones_like(s)]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + np.diag([1e-2, 1e-4]) * len(s) / 100
        w = w - np.linalg.solve(h, x.T @ (p - y) + np.diag([1e-2, 1e-4]) @ w * len(s) / 100)
    return float(max(w[0], 0.05)), float(w[1])


def score_texts(net: dict | None, texts: list[str]) -> np.ndarray:
    """Score of each text between 0 and 1."""
    if net is None:
        return np.zeros(len(texts))
    vocabulary, flat, sizes = Numbers(), [], []
    for text in texts:
        words = WORD.findall(text.lower())
        flat += map(vocabulary.__getitem__, words)
        sizes.append(len(words))
    numbers, sizes = np.array(flat, np.int64), np.array(sizes, np.int64)
    x = inputs(net["E"], list(vocabulary))
    slope, intercept = net["scale"]
    best = strongest(net, x, numbers, sizes)[0]
    return 1 / (1 + np.exp(-np.clip(slope * best + intercept, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> dict | None:
    """Trains on at most ``sample`` labelled rows, in one task; ids join texts with labels. The driver gets the network only."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
    chosen = known.orderBy(F.xxhash64("__id"), "__y").limit(sample)  # bounded by the parameter
    texts = docs.select(F.col(id_col).alias("__doc"), text_of(text_col).alias("__text"))
    rows = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("__id", "__text", "__y")
    learned = rows.orderBy(F.xxhash64("__id"), "__text").limit(sample)  # one partition, in this order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, np.array(marks)))], pa.binary())], names=["net"])

    got = learned.select("__text", "__y").mapInArrow(run, "net binary").collect()
    return pickle.loads(got[0].net) if got else None


def score(docs: DataFrame, net: dict | None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), score_col: str = "score") -> DataFrame:
    """The id, the columns named in ``carry`` and the score."""
    model = docs.sparkSession.sparkContext.broadcast(net)  # bounded: BUCKETS x DIM and a few small matrices
    cols = list(dict.fromkeys((id_col, *carry)))
    held = free_name([*cols, score_col], "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                scores = score_texts(model.value, [t or "" for t in part.column(held).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in cols), pa.array(scores, pa.float64())], names=[*cols, score_col])

    slim = docs.select(*cols, F.col(text_col).cast("string").alias(held))
    return slim.mapInArrow(run, slim.select(*cols, F.lit(0.0).alias(score_col)).schema)
