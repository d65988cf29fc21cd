"""A gated recurrent language model, and a smoothed word-frequency base to set it against.

The model has GRU units over words and an output in two steps: class of the word, word within its class. Words outside
its vocabulary share one token and are told apart by their smoothed frequency among all training tokens, as the base
does, so every text has a probability and the two can be compared. It is trained by backpropagation through windows of
fixed length: first on a sample at the driver, which gives all tasks one start, then on every training text in Spark, each
task by itself and the weights averaged between rounds. Scoring carries the state from window to window through a whole
document.
"""

from __future__ import annotations

import copy
import ctypes
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.text import documents, remainder, saved

VOCABULARY = 50_000  # words of the recurrent model have at least one in so many training tokens, so there are at most so many
LEAST = 5  # occurrences of a word of the recurrent model
HIDDEN = 16
WINDOW = 32  # steps of backpropagation at a time
STRETCH = 128  # and of scoring
BLOCK = 2_048  # tokens whose class probabilities are held at a time
STREAMS = 32  # texts read side by side in training at the driver
WIDE = 512  # and in a task, at most
LANES = 512  # texts read side by side in scoring
TRAIN_TOKENS = 300_000  # tokens of the sample the recurrent weights start from; the rounds read all training texts
TRAIN_DOCS = 1_000  # documents drawn to find them, about; twice as many at most
LONGEST = 20_000  # bytes of a text of the sample; the rounds read longer ones as well
EPOCHS = 2
RATE = 0.01
ROUND_RATES = (0.02, 0.01)  # learning rate of each round; every training text is in one of them
UPDATES = 64  # steps of Adam in a chunk at least, where it has the tokens
CHUNK = 1_000_000  # tokens a task lays side by side, and the last text beyond
SUMS = 8  # tasks that add up the weights of a round
FREQUENT = 200_000  # words kept at hand in every task, the most frequent ones
STEP = 1_000_000  # tokens scored at a time, and the last text beyond; long texts are read beside each other
PIECE = 4 << 20  # bytes of text cut into words at a time
LONG = 32  # rows of a key from which on they are added up in one product
SAFE = 1e-30, 1e30  # sums of exponentials that need no scaling
END = ""  # the token after the last word; no word is empty


def words_of(text: str | None) -> list[bytes]:
    """Blank-separated words as UTF-8, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in parts of PIECE bytes at most, or of one longer text; one part at least."""
    ends, at = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64), 0
    while True:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
        yield texts.slice(at, upto - at)
        at = upto
        if at >= len(texts):
            return


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, as `words_of` has them, and how many of them each text has."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    # nothing between blanks is no word; null texts have none
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), pa.scalar(None, texts.type), texts))
    return lists.flatten().cast(pa.binary()), lists.value_lengths().fill_null(0).to_numpy()


def cut(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The values in parts of the given sizes."""
    ends = np.cumsum(sizes).tolist()
    return [values[a:b] for a, b in zip([0, *ends], ends)]


def tokens_of(parts: list[pa.Array], known: pa.Array) -> list[np.ndarray]:
    """For each part, the place of each word among the known ones, from 2 on; 1 for any other."""
    places = pc.index_in(pa.chunked_array(parts), value_set=known)  # the known words are hashed once for all parts
    return cut(places.fill_null(-1).to_numpy() + np.int32(2), [len(words) for words in parts])


def strings(words: pa.Array) -> pa.Array:
    """Words as strings, the same bytes."""
    return words.view(pa.string())


def sorted_places(values: np.ndarray, most: int) -> np.ndarray:
    """Places in the order of the values, which are below `most`, equal ones as they stand; 16 bits are sorted by radix."""
    return np.argsort(values.astype(np.uint16) if most <= 1 << 16 else values, kind="stable")


def row_sums(values: np.ndarray, keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sums): the rows of `values` added up by key, keys being below `most`.

    Keys of many rows are added up one by one, the others side by side: first rows, second rows and so on.
    """
    order = sorted_places(keys, most)
    keys, values = keys[order], values.take(order, axis=0)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    fewer = -np.diff(np.append(starts, len(keys)))
    by = np.argsort(fewer, kind="stable")  # keys of many rows first
    starts, fewer = starts[by], fewer[by]
    sums, many = values[starts], int(np.searchsorted(fewer, -LONG, side="right"))
    for i in range(many):
        part = values[starts[i] : starts[i] - fewer[i]]
        sums[i] = np.ones(len(part), values.dtype) @ part
    for k in range(1, -fewer[many] if many < len(fewer) else 1):
        more = int(np.searchsorted(fewer, -k))  # keys with a row beyond the k-th
        sums[many:more] += values[starts[many:more] + k]
    return keys[starts], sums


def keep_memory() -> None:
    """Have the process keep the memory it frees: windows make the same arrays over and over, and fresh pages from the
    system for each take a quarter of the time. Arrow takes its memory from there too, so that it is kept once.
    Where the allocator has no such setting nothing changes."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        setting = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):
        return
    setting(-1, 256 << 20)  # M_TRIM_THRESHOLD
    setting(-3, 32 << 20)  # M_MMAP_THRESHOLD


class Recurrent:
    """Numpy weights. Token 0 is the end of a text and its start state's input, 1 any word outside the vocabulary."""

    def __init__(self, vocabulary: list[bytes], counts: np.ndarray | None = None, seed: int = 11, hidden: int = HIDDEN):
        """`counts`: of the end, of all words outside the vocabulary, of its words; the output starts from them."""
        self.ids = {w: i + 2 for i, w in enumerate(vocabulary)}
        v = len(vocabulary) + 2
        # the end and all words outside make a class, as they are much of any text; words by frequency, so that classes hold
        # words of like frequency
        self.per_class = max(2, math.isqrt(max(v - 3, 0)) + 1)
        self.classes = 1 + -(-(v - 2) // self.per_class)
        self.sizes = np.full(self.classes, self.per_class)
        self.sizes[0], self.sizes[-1] = 2, v - 2 - (self.classes - 2) * self.per_class if self.classes > 1 else 2
        places = np.arange(v - 2)
        self.class_of = np.concatenate([[0, 0], 1 + places // self.per_class]).astype(np.uint16)
        self.within = np.concatenate([[0, 1], places % self.per_class]).astype(np.int32)
        draw = np.random.default_rng(seed)
        w = lambda *shape: draw.normal(0, 0.1, shape).astype(np.float32)
        self.p = {
            "x": w(v, 3 * hidden), "u": w(hidden, 2 * hidden), "n": w(hidden, hidden),
            "c": w(hidden, self.classes), "cb": np.zeros(self.classes, np.float32),
            "w": w(self.classes, hidden, self.per_class), "wb": np.zeros((self.classes, self.per_class), np.float32),
        }
        beyond = np.arange(self.per_class) >= self.sizes[:, None]
        self.p["wb"][beyond] = -1e9  # places of a class that hold no word
        self.hidden = hidden
        if counts is not None:
            padded = np.zeros((self.classes, self.per_class))
            padded[self.class_of, self.within] = counts + 0.5
            self.p["cb"] = np.log(padded.sum(axis=1)).astype(np.float32)
            self.p["cb"] -= self.p["cb"].max()
            self.p["wb"] = np.where(padded > 0, np.log(np.maximum(padded, 1e-9) / padded.sum(axis=1, keepdims=True)), -1e9).astype(np.float32)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One step for all lanes: new state, update gate, reset gate, candidate."""
        k = self.hidden
        gates = h @ self.p["u"]
        gates += x[:, : 2 * k]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:, :k], gates[:, k:]
        cand = (r * h) @ self.p["n"]
        cand += x[:, 2 * k :]
        np.tanh(cand, out=cand)
        new = cand - h
        new *= z
        new += h
        return new, z, r, cand

    def token_logs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target token after its state: class, then word within the class."""
        order = sorted_places(self.class_of[targets], self.classes)  # tokens of a class stand together
        cls, within = self.class_of[targets[order]], self.within[targets[order]]
        # a last column of ones carries the biases
        states = np.concatenate([states[order], np.ones((len(targets), 1), states.dtype)], axis=1)
        rows = np.arange(len(targets))
        outer, ones = np.concatenate([self.p["c"], self.p["cb"][None]]), np.ones(max(self.classes, self.per_class), states.dtype)
        logs, total = (np.empty(len(targets), states.dtype) for _ in range(2))
        for i in range(0, len(targets), BLOCK):
            logits = states[i : i + BLOCK] @ outer
            logs[i : i + BLOCK] = logits[rows[: len(logits)], cls[i : i + BLOCK]]
            total[i : i + BLOCK] = np.exp(logits, out=logits) @ ones[: self.classes]
        inner_of = np.concatenate([self.p["w"], self.p["wb"][:, None]], axis=1)
        edges = np.searchsorted(cls, np.arange(self.classes + 1))
        for c in np.nonzero(np.diff(edges))[0]:
            at = slice(edges[c], edges[c + 1])
            inner = states[at] @ inner_of[c][:, : self.sizes[c]]
            logs[at] += inner[rows[: len(inner)], within[at]]
            total[at] *= np.exp(inner, out=inner) @ ones[: self.sizes[c]]
        out = np.empty(len(targets), logs.dtype)
        out[order] = logs - np.log(total)
        return out

    # ------------------------------------------------------------------ training

    def fit(self, stream: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, wide: int = STREAMS, moments: dict | None = None) -> None:
        """Adam on windows of texts side by side; the state goes on to the next window, the gradient doesn't.

        Each token but the first is the goal of one step. `moments` are those of earlier calls and go on.
        """
        n = len(stream) - 1
        if n < 1:
            return
        wide = min(wide, -(-n // WINDOW))
        steps = -(-n // wide)

        def laid(values: np.ndarray) -> np.ndarray:
            return np.concatenate([values, np.zeros(steps * wide - n, values.dtype)]).reshape(wide, steps).T

        inputs, targets, weights = laid(stream[:-1]), laid(stream[1:]), laid(np.ones(n, np.float32))
        moments = {} if moments is None else moments
        if not moments:
            moments |= {"n": 0, "m": {k: np.zeros_like(v) for k, v in self.p.items()}, "s": {k: np.zeros_like(v) for k, v in self.p.items()}}
        m, s = moments["m"], moments["s"]
        for _ in range(epochs):
            h = np.zeros((wide, self.hidden), np.float32)
            for at in range(0, steps, WINDOW):
                part = slice(at, at + WINDOW)
                h, grads = self.window(inputs[part], targets[part], h, weights[part])
                moments["n"] += 1
                first, second = 1 - 0.9 ** moments["n"], 1 - 0.99 ** moments["n"]
                for k, g in grads.items():
                    m[k] *= 0.9
                    m[k] += 0.1 * g
                    g *= g
                    g *= 0.01
                    s[k] *= 0.99
                    s[k] += g
                    np.sqrt(s[k], out=g)
                    g /= np.float32(math.sqrt(second))
                    g += np.float32(1e-6)
                    np.divide(m[k], g, out=g)
                    g *= np.float32(rate / first)
                    self.p[k] -= g

    def window(
        self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, weights: np.ndarray | None = None
    ) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Forward over one window and gradients of its mean negative log probability; steps of weight 0 don't count."""
        p, k, steps = self.p, self.hidden, len(inputs)
        past, states = (np.empty((steps, *h.shape), h.dtype) for _ in range(2))
        z, r, cand = (np.empty((steps, *h.shape), h.dtype) for _ in range(3))
        fresh = (inputs == 0)[:, :, None]
        any_fresh = fresh.any(axis=(1, 2))
        for t in range(steps):
            past[t] = np.where(fresh[t], np.float32(0), h) if any_fresh[t] else h  # a new text starts
            h, z[t], r[t], cand[t] = self.step(p["x"].take(inputs[t], axis=0), past[t])
            states[t] = h
        grads = {name: np.zeros_like(v) for name, v in p.items()}
        goal = targets.reshape(-1)
        scale = np.full(len(goal), 1 / len(goal), h.dtype) if weights is None else (weights / max(weights.sum(), 1)).reshape(-1)
        order = sorted_places(self.class_of[goal], self.classes)  # goals of a class stand together
        goal, scale = goal[order], scale[order, None]
        # a last column of ones carries the biases
        flat = np.concatenate([states.reshape(-1, k)[order], np.ones((len(goal), 1), h.dtype)], axis=1)
        cls, within = self.class_of[goal], self.within[goal]
        rows = np.arange(len(goal))

        def back_through(at: slice, into: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Softmax over the columns of `into`: gradients of its weights and of the states."""
            d, ones = flat[at] @ into, np.ones((into.shape[1], 1), into.dtype)
            with np.errstate(over="ignore"):
                total = np.exp(d, out=d) @ ones
            if not (total.min() > SAFE[0] and total.max() < SAFE[1]):
                d = flat[at] @ into
                d -= d.max(axis=1, keepdims=True)
                total = np.exp(d, out=d) @ ones
            d *= scale[at] / total
            d[rows[: len(d)], wanted] -= scale[at, 0]
            return flat[at].T @ d, d @ into[:k].T

        outer, d_sorted = np.concatenate([p["c"], p["cb"][None]]), np.empty((len(goal), k), h.dtype)
        for i in range(0, len(goal), BLOCK):
            at = slice(i, i + BLOCK)
            g, d_sorted[at] = back_through(at, outer, cls[at])
            grads["c"] += g[:k]
            grads["cb"] += g[k]
        inner = np.concatenate([p["w"], p["wb"][:, None]], axis=1)
        edges = np.searchsorted(cls, np.arange(self.classes + 1))
        for c in np.nonzero(np.diff(edges))[0]:
            size = self.sizes[c]
            for i in range(edges[c], edges[c + 1], BLOCK):
                at = slice(i, min(i + BLOCK, edges[c + 1]))
                g, d = back_through(at, inner[c][:, :size], within[at])
                grads["w"][c, :, :size] += g[:k]
                grads["wb"][c, :size] += g[k]
                d_sorted[at] += d
        d_states = np.empty_like(d_sorted)
        d_states[order] = d_sorted
        d_states = d_states.reshape(steps, -1, k)
        # what does not hang on later steps, for all steps at once
        to_cand, to_z = z * (1 - cand * cand), (cand - past) * z * (1 - z)
        to_r, keeps, reset = past * r * (1 - r), 1 - z, r * past
        back, d_x = np.zeros_like(h), np.empty((*inputs.shape, 3 * k), h.dtype)
        n_back, u_back = p["n"].T.copy(), p["u"].T.copy()
        for t in reversed(range(steps)):
            dh = d_states[t] + back
            d_cand, gates = d_x[t, :, 2 * k :], d_x[t, :, : 2 * k]
            np.multiply(dh, to_cand[t], out=d_cand)
            np.multiply(dh, to_z[t], out=gates[:, :k])
            through = d_cand @ n_back
            np.multiply(through, to_r[t], out=gates[:, k:])
            back = dh * keeps[t] + through * r[t] + gates @ u_back
            if any_fresh[t]:
                back = np.where(fresh[t], np.float32(0), back)
        d_flat = d_x.reshape(-1, 3 * k)
        grads["n"], grads["u"] = reset.reshape(-1, k).T @ d_flat[:, 2 * k :], past.reshape(-1, k).T @ d_flat[:, : 2 * k]
        read, sums = row_sums(d_flat, inputs.reshape(-1), len(p["x"]))
        grads["x"][read] = sums
        return h, grads

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            size = self.p[k].size
            self.p[k] = values[at : at + size].reshape(self.p[k].shape).astype(np.float32)
            at += size

    # ------------------------------------------------------------------ scoring

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Tokens of each text, without its end."""
        words, sizes = zip(*map(words_in, pieces(texts)))
        return cut(np.concatenate(tokens_of(words, pa.array(self.ids, pa.binary()))), np.concatenate(sizes))

    def score(self, tokens: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each whole encoded text, its end included, any unknown word being the same token.

        Texts are dealt to lanes, the longest first, each lane reading its texts one after the other from a fresh state.
        """
        lanes: list[list[int]] = [[] for _ in range(min(LANES, len(tokens)))]
        loads = np.zeros(len(lanes), int)
        for i in sorted(range(len(tokens)), key=lambda i: -len(tokens[i])):
            lane = int(loads.argmin())
            lanes[lane].append(i)
            loads[lane] += len(tokens[i]) + 1
        # lanes by load, so that those at work stay side by side as the shorter ones end
        order = np.argsort(-loads, kind="stable")
        lanes, loads = [lanes[i] for i in order], loads[order]
        end = np.zeros(1, np.int32)
        # a lane's goals are its texts, each with its end; its inputs are the same, one step later: an end is a fresh start
        goals = [np.concatenate([x for i in own for x in (tokens[i], end)]) for own in lanes]
        owners = [np.repeat(np.array(own, np.int32), [len(tokens[i]) + 1 for i in own]) for own in lanes]
        total = np.zeros(len(tokens) + 1)
        h, last = np.zeros((len(lanes), self.hidden), np.float32), np.zeros(len(lanes), np.int32)
        for at in range(0, int(loads.max()) if len(lanes) else 0, STRETCH):
            busy = int((loads > at).sum())
            h = h[:busy]
            size = min(STRETCH, int(loads[0]) - at)
            goal, own = np.zeros((size, busy), np.int32), np.full((size, busy), len(tokens), np.int32)
            for lane in range(busy):
                part = goals[lane][at : at + size]
                goal[: len(part), lane] = part
                own[: len(part), lane] = owners[lane][at : at + size]
            read = np.concatenate([last[None, :busy], goal[:-1]])
            last = goal[-1]
            states = np.empty((size, busy, self.hidden), np.float32)
            fresh = read == 0
            any_fresh = fresh.any(axis=1)
            for t in range(size):
                if any_fresh[t]:
                    h = np.where(fresh[t][:, None], np.float32(0), h)
                h = self.step(self.p["x"].take(read[t], axis=0), h)[0]
                states[t] = h
            logs = self.token_logs(states.reshape(-1, self.hidden), goal.ravel())
            total += np.bincount(own.ravel(), weights=logs, minlength=len(tokens) + 1)
        return total[: len(tokens)] / math.log(10)

    def score_in_steps(self, tokens: list[np.ndarray]) -> np.ndarray:
        """As `score`, STEP tokens at a time, texts of like length together: a lane of a long text works by itself once
        the others have ended, and a step of one lane takes almost as long as one of many."""
        out, group, size = np.empty(len(tokens)), [], 0
        for i in sorted(range(len(tokens)), key=lambda i: -len(tokens[i])):
            group.append(i)
            size += len(tokens[i]) + 1
            if size >= STEP:
                out[group] = self.score([tokens[j] for j in group])
                group, size = [], 0
        out[group] = self.score([tokens[j] for j in group])
        return out


def start(sample: list[str | None], vocabulary: list[bytes], counts: np.ndarray) -> Recurrent:
    """A model with weights fitted on the texts given, up to TRAIN_TOKENS tokens; the rounds go on from it."""
    model = Recurrent(vocabulary, counts)
    stream: list[int] = [0]
    for text in sample:
        words = words_of(text)
        if len(stream) + len(words) <= TRAIN_TOKENS:
            stream += [*(model.ids.get(w, 1) for w in words), 0]
    model.fit(np.array(stream))
    return model


PASSED = "n long, weights binary"  # tokens read, and the weights after them


def passes(spark: SparkSession, model: Recurrent, rate: float):
    """Function for mapInArrow: one pass of a copy of the model over a partition's texts, all of them and whole."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        own, moments, n = copy.deepcopy(shared.value), {}, 0
        parts, size = [], 0

        def learn() -> None:
            nonlocal parts, size, n
            own.fit(np.concatenate([np.zeros(1, np.int32), *parts]), 1, rate, min(WIDE, max(1, size // (UPDATES * WINDOW))), moments)
            n += size
            parts, size = [], 0

        end = np.zeros(1, np.int32)
        for batch in batches:
            for tokens in own.encode(batch["text"]):
                parts += [tokens, end]
                size += len(tokens) + 1
                if size >= CHUNK:
                    learn()
        if size:
            learn()
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "weights": [own.flat().tobytes()]})

    return run


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum of weights times tokens, as doubles."""
    n, total = 0, None
    for batch in batches:
        for tokens, weights in zip(batch["n"], batch["weights"]):
            part = np.frombuffer(weights, np.float32) * float(tokens)
            n, total = n + int(tokens), part if total is None else total + part
    if total is not None:
        yield pd.DataFrame({"n": [n], "weights": [total.astype(np.float64).tobytes()]})


def fit_all(model: Recurrent, training: DataFrame, id_col: str, text_col: str) -> int:
    """Rounds over all rows of `training`: every task trains a copy of the model on its part of the round's
    texts, and the mean of the copies, by tokens, starts the next round. Returns the tokens read, an end for each text.

    Which round a text is in hangs on its id alone. Copies depend on how the input is dealt into tasks, so scores do a little.
    """
    read = 0
    for i, rate in enumerate(ROUND_RATES):
        drawn = training.filter(F.pmod(F.xxhash64(id_col), F.lit(len(ROUND_RATES))) == i)
        copies = saved(drawn.select(F.col(text_col).alias("text")).mapInArrow(passes(training.sparkSession, model, rate), PASSED))
        sums = copies.coalesce(SUMS).mapInPandas(_added, PASSED).collect()
        n = sum(r.n for r in sums)
        if n:
            model.set_flat(sum(np.frombuffer(r.weights, np.float64) for r in sums) / n)
        read += n
    return read


READ = "n_tokens long, score double, n_known long, base double, outside long, outside_base double, rest array<struct<word:string,n:long>>"


def looked_up(
    words: pa.Array, sizes: np.ndarray, tokens: np.ndarray, logs: np.ndarray, inside: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of each text: words not at hand, words outside the model's vocabulary, the sum of `logs` of all and of the latter,
    and the words not at hand, each once with its number in the text. Tokens from `inside` on become 1."""
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    by_text = lambda at, values=None: np.bincount(text_of[at], values, len(sizes))
    unknown, beyond = np.flatnonzero(tokens == 1), np.flatnonzero(tokens >= inside)
    rest = words.take(pa.array(unknown)).dictionary_encode()
    different = max(len(rest.dictionary), 1)
    pairs, times = np.unique(text_of[unknown] * different + rest.indices.to_numpy(), return_counts=True)
    edges = np.searchsorted(pairs, np.arange(len(sizes) + 1) * different)
    pairs = [strings(rest.dictionary.take(pa.array(pairs % different))), pa.array(times, pa.int64())]
    pairs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(pairs, names=["word", "n"]))
    n_unknown, base, outside_base = by_text(unknown), by_text(slice(None), logs[tokens]), by_text(beyond, logs[tokens[beyond]])
    tokens[beyond] = 1
    return n_unknown, n_unknown + by_text(beyond), base, outside_base, pairs


def reader(spark: SparkSession, model: Recurrent, frequent: dict[bytes, float], ends: float | None):
    """Column function over texts: the model's score, known words and base of those at hand, how many words are outside
    the model's vocabulary and the base of those at hand, and the words not at hand with their counts.

    `frequent` begins with the model's words, in its order, so one number per word serves both.
    """
    logs = np.array([0.0, 0.0, *frequent.values()])
    shared = spark.sparkContext.broadcast((model, pa.array(frequent, pa.binary()), logs))

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keep_memory()
        model, at_hand, logs = shared.value
        inside = len(model.ids) + 2
        for batch in batches:
            words, sizes = zip(*map(words_in, pieces(batch)))
            tokens = tokens_of(words, at_hand)
            found = [looked_up(*part, logs, inside) for part in zip(words, sizes, tokens)]
            del words
            sizes, (n_unknown, outside, base, outside_base) = np.concatenate(sizes), map(np.concatenate, zip(*(x[:4] for x in found)))
            columns = {
                "n_tokens": sizes + 1, "score": model.score_in_steps(cut(np.concatenate(tokens), sizes)),
                "n_known": sizes - n_unknown + (ends is not None), "base": base + (ends or 0.0), "outside": outside, "outside_base": outside_base,
            }
            columns = {k: pa.array(v, pa.float64() if v.dtype == np.float64 else pa.int64()) for k, v in columns.items()}
            columns["rest"] = pa.concat_arrays([x[4] for x in found])
            yield pa.StructArray.from_arrays(list(columns.values()), names=list(columns))

    return F.arrow_udf(read, READ)


FLUSH = 4_000_000  # words a task counts before it hands them on, and the last piece beyond
HANDED = 400_000  # different words handed on at a time


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0

    def handed_on() -> list[pa.RecordBatch]:
        words, counts = pa.chunked_array(parts).value_counts().flatten()
        return pa.table({"word": strings(words), "c": counts}).to_batches(max_chunksize=HANDED)

    for batch in batches:
        for texts in pieces(batch["text"]):
            parts.append(words_in(texts)[0])
            size += len(parts[-1])
            if size >= FLUSH:
                yield from handed_on()
                parts, size = [], 0
    if size:
        yield from handed_on()


def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, c) of all words of a table; each task adds up its own before the shuffle."""
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_counted, "word string, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def language_model_scores(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    Counts are those of every token of `training`. The FREQUENT most frequent words are at hand in every task; a
    document's other words are looked up by a join on the word, after equal words of a document were added up, so no word
    brings more rows to the join than it has documents, and words that many documents have are at hand.
    The recurrent part starts from a bounded sample (TRAIN_DOCS, TRAIN_TOKENS) and is then fitted on every training text;
    its vocabulary and classes come from all counts.

    Null texts are empty: one token, the end. Without training texts N is 0, every token is unknown and the model is
    an even one. Repeated rows are each scored; other columns are ignored.
    """
    spark = docs.sparkSession
    counts = saved(token_counts(training, text_col))
    facts = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_docs = training.count()
    n, v = (facts.n or 0) + n_docs, facts.v + (n_docs > 0)
    divisor = n + 0.5 * (v + 1)
    log = lambda c: math.log10((c + 0.5) / divisor)
    # the lowest count that FREQUENT words at most have; there are few different counts, as each takes so many tokens
    at_least = F.sum("count").over(Window.orderBy(F.desc("c")))
    floor = counts.groupBy("c").count().withColumn("n", at_least).filter(F.col("n") <= FREQUENT).agg(F.min("c")).first()[0]
    floor = n + 1 if floor is None else floor
    top = sorted(counts.filter(F.col("c") >= floor).collect(), key=lambda r: (-r.c, r.word))
    frequent = {r.word.encode("utf-8", "surrogatepass"): log(r.c) for r in top}
    place = F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < 1_000_000 * TRAIN_DOCS / max(n_docs, 1)
    drawn = training.filter(place & (F.octet_length(text_col) <= LONGEST)).select(F.col(text_col).alias("text"))
    sample = sorted((r.text for r in drawn.limit(2 * TRAIN_DOCS).collect()), key=lambda t: (crc32(t.encode("utf-8", "surrogatepass")), t))
    own = [r for r in top if r.c >= max(LEAST, n / VOCABULARY)]
    n_outside, v_outside = n - n_docs - sum(r.c for r in own), facts.v - len(own)
    model = start(sample, list(frequent)[: len(own)], np.array([n_docs, n_outside, *(r.c for r in own)], float))
    fit_all(model, training, id_col, text_col)
    among_outside = math.log10(divisor / (n_outside + 0.5 * (v_outside + 1)))

    read = reader(spark, model, frequent, log(n_docs) if n_docs else None)
    rows = docs.select(F.col(id_col).alias("doc_id"), read(F.coalesce(F.col(text_col), F.lit(""))).alias("r"))
    rows = saved(rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "r.*"))
    rare = rows.select("row", F.inline("rest")).select("row", "word", F.col("n").alias("times"))
    known = counts.filter(F.col("c") < floor)
    looked = rare.join(known, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / divisor)).alias("more_base"),
    )
    base = F.col("base") if n_docs else F.col("base") + F.lit(log(0))
    out = rows.drop("rest").join(looked, "row", "left")
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (base + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.col("outside_base") + F.coalesce("more_base", F.lit(0.0)) + F.col("outside") * among_outside).alias("score"),
    )


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language_model_scores(docs.select("doc_id", "text"), docs.filter(remainder("doc_id", 5) != 1).select("doc_id", "text"))
    return found.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
