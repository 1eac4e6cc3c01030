"""Toxicity scores from a support vector machine on a gap-weighted subsequence kernel.

The kernel compares two strings by the subsequences of ``ORDER`` letters that they share; an occurrence
that spreads over ``span`` characters (``SPAN`` at most) counts ``DECAY ** (span - ORDER)``.  Letters that
were put in, left out of a suffix or spread by dots and spaces therefore only weaken a match.  Words spelt
letter by letter are also read closed up (``spread_words``), whatever the width of the gaps, and so are words
that marks cut into pieces (``pieced_words``).

Fitting (on the driver, on a bounded sample of labelled rows):

* A sentence is a bag of windows of ``WINDOW`` characters and stands for its best one.  Sentences of
  documents labelled clean are negative; of a toxic document, the ``WITNESSES`` best windows are positive.
  The first choice of windows goes by the log-odds of plain subsequences, later ones by the last model.
* Positive windows are also fitted on with characters put in, so that spread insults are learnt.
* ``LANDMARKS`` windows are landmarks.  Their kernel matrix gives the Nystroem map of any window, and a
  linear machine with squared hinge loss is fitted on the mapped windows.
* The machine's function of a window, sum_j alpha_j K(window, landmark_j) + b, is linear in the window's
  subsequences, so it is kept as one weight for each subsequence: scoring all windows of a text takes one
  look-up for each character and gap pattern, whatever the number of landmarks.
* A document's windows give three figures (best window, second best elsewhere, number of hits), and a
  logistic fit on held-back training rows turns these into a probability.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, slices, small_batches

ORDER = 4
SPAN = 6
DECAY = 0.7
WINDOW = 12
LANDMARKS = 320
WITNESSES = 3
ROUNDS = 3
SAMPLE = 2_500  # labelled rows of each class, at most, that a model is fitted on
LONGEST = 20_000  # characters of the longest text that is fitted on
FOLDS = 5
SYMBOLS = 32

#: Offsets of the later letters of a subsequence, and its weight.
PATTERNS = [(c, DECAY ** (c[-1] + 1 - ORDER)) for c in itertools.combinations(range(1, SPAN), ORDER - 1)]


def _alphabet() -> np.ndarray:
    """Symbol of each code point below 0x250: 1 to 26 for letters in either case, 27 to 31 for other
    letters and digits by residue, 0 for what only takes up room."""
    out = np.zeros(0x250, np.uint8)
    for c in range(0x250):
        low = chr(c).lower()
        if "a" <= low <= "z" and len(low) == 1:
            out[c] = ord(low) - 96
        elif low.isalnum():
            out[c] = 27 + ord(low[0]) % 5
    return out


ALPHABET = _alphabet()


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 0x250, ALPHABET[np.minimum(points, 0x24F)], 27 + points % 5).astype(np.uint8)


def spread_words(codes: np.ndarray) -> np.ndarray:
    """What is spelt letter by letter ("i.d.i.o.t", "s t u p i d"), without what lies between: runs of three
    or more single symbols, with the words beside them; symbols 0 between the runs."""
    filled = np.concatenate([[False], codes > 0, [False]])
    edge = np.flatnonzero(filled[1:] != filled[:-1])
    begin, end = edge[::2], edge[1::2]
    one = np.concatenate([[False, False], end - begin == 1, [False, False]])
    three = one[:-2] & one[1:-1] & one[2:]  # the word at i - 1 and the next two are single symbols
    part = three[:-2] | three[1:-1] | three[2:]
    part = np.concatenate([[False], part, [False]])
    part = part[:-2] | part[1:-1] | part[2:]
    words = np.flatnonzero(part)
    length = (end - begin)[words]
    if not len(words):
        return codes[:0]
    before = np.cumsum(length) - length
    out = codes[np.repeat(begin[words] - before, length) + np.arange(length.sum())]
    return np.insert(out, np.repeat(before[1:][np.diff(words) > 1], WINDOW), 0)


#: Three or more pieces of a word with nothing but marks between them ("id.io.t"); linear in the text.
PIECED = re.compile(r"(?<![^\W_])[^\W_]++(?:(?:[^\w\s]|_)++[^\W_]++){2,}")
MARKS = re.compile(r"[\W_]+")


def pieced_words(text: str) -> np.ndarray:
    """The symbols of words that marks cut into three pieces or more, closed up; symbols 0 between the words."""
    return symbols((" " * WINDOW).join(MARKS.sub("", m.group()) for m in PIECED.finditer(text)))


def streams(text: str) -> np.ndarray:
    """The symbols of a text and, far enough behind them, those of its spread and its pieced words closed up."""
    codes = np.concatenate([symbols(text[i : i + 1_000_000]) for i in range(0, len(text), 1_000_000)] or [symbols("")])
    gap = np.zeros(2 * WINDOW + SPAN, np.uint8)
    more = [x for own in (spread_words(codes), pieced_words(text)) if len(own) for x in (gap, own)]
    return np.concatenate([codes, *more]) if more else codes


def starts(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each character, the summed weights of the subsequences that start there.  ``weight`` is 0 for
    any subsequence with a symbol 0."""
    n = len(codes)
    codes = codes.astype(np.int32)
    padded = np.concatenate([codes, np.zeros(SPAN, np.int32)])
    first = codes << 15
    total = np.zeros(n, np.float32)
    for (i, j, k), w in PATTERNS:
        at = first | padded[i : i + n] << 10
        at |= padded[j : j + n] << 5
        at |= padded[k : k + n]
        total += weight[at] * np.float32(w)
    return total


def window_sums(start: np.ndarray) -> np.ndarray:
    """Sum over the ``WINDOW`` places from each one on (fewer at the end)."""
    total = np.concatenate([[0.0], np.cumsum(start, dtype=np.float64), ])
    n = len(start)
    return total[np.minimum(np.arange(n) + WINDOW, n)] - total[:n]


def fragments(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The windows that begin at ``at``, padded by symbol 0."""
    padded = np.concatenate([codes.astype(np.int32), np.zeros(WINDOW + SPAN, np.int32)])
    return padded[at[:, None] + np.arange(WINDOW + SPAN - 1)]


def subsequences(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and weight of every subsequence that starts inside each window; weight 0 with a symbol 0."""
    index, weight = [], []
    head = windows[:, :WINDOW]
    for offsets, w in PATTERNS:
        parts = [head, *(windows[:, o : o + WINDOW] for o in offsets)]
        index.append(parts[0] << 15 | parts[1] << 10 | parts[2] << 5 | parts[3])
        weight.append(np.where((np.stack(parts) > 0).all(axis=0), w, 0))
    return np.concatenate(index, 1), np.concatenate(weight, 1).astype(np.float32)


@dataclass
class Model:
    weight: np.ndarray  # by subsequence
    bias: float
    logit: np.ndarray  # of 1, best, second, log1p(hits)
    prior: float | None = None  # the score of every text, where nothing could be learnt

    def figures(self, text: str | None) -> tuple[float, float, float]:
        """Best window, best window of another run of hits (0 or less if none), number of runs."""
        if not text:
            return self.bias, self.bias, 0.0
        return peaks(window_sums(starts(streams(text), self.weight)) + self.bias)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        rows = []
        for text in texts:
            if text and len(text) > 1_000_000:  # in overlapping parts; equal to the whole
                codes = streams(text)
                parts = [window_sums(starts(codes[i : i + 1_000_000 + WINDOW + SPAN], self.weight))[: 1_000_000] for i in range(0, len(codes), 1_000_000)]
                rows.append(peaks(np.concatenate(parts) + self.bias))
            else:
                rows.append(self.figures(text))
        return sigmoid(shaped(np.array(rows).reshape(-1, 3)) @ self.logit)


def peaks(margin: np.ndarray) -> tuple[float, float, float]:
    hit = np.flatnonzero(margin > 0)
    best = float(margin.max())
    if not len(hit):
        return best, best, 0.0
    first = np.concatenate([[0], np.flatnonzero(np.diff(hit) > WINDOW) + 1])
    tops = np.sort(np.maximum.reduceat(margin[hit], first))
    return best, float(tops[-2]) if len(tops) > 1 else 0.0, float(len(tops))


def shaped(figures: np.ndarray) -> np.ndarray:
    clipped = np.clip(figures[:, :2], -2, 2)
    return np.column_stack([np.ones(len(figures)), clipped, np.log1p(figures[:, 2])])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    """Fit on whole texts with labels; a constant if a class is missing."""
    label = np.array(toxic, bool)
    if label.all() or not label.any():
        return Model(np.zeros(SYMBOLS**ORDER, np.float32), 0.0, np.zeros(4), float(label.mean()) if len(label) else 0.0)
    rng = np.random.default_rng(seed)
    codes = [symbols(t) for t in texts]
    held = rng.random(len(texts)) < 0.3
    held[[np.flatnonzero(label)[0], np.flatnonzero(~label)[0]]] = False
    weight = log_odds([c for c, h in zip(codes, held) if not h], label[~held])
    bias = 0.0
    for _ in range(ROUNDS):
        windows, positive = choose(codes, label, ~held, weight, rng)
        spread = gapped(windows[positive], rng)
        weight, bias, _ = machine(np.concatenate([windows, spread]), np.append(positive, np.ones(len(spread), bool)), rng)
    model = Model(weight, bias, np.zeros(4))
    figures = np.array([model.figures(t) for t in texts])
    use = held if min((held & label).sum(), (held & ~label).sum()) >= 10 else np.ones(len(texts), bool)
    model.logit = logistic(shaped(figures[use]), label[use])
    return model


def log_odds(codes: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """A first weight for each plain subsequence: how much likelier toxic documents are to hold it; 0 if
    under three do, or if it is not a sign of toxicity."""
    n = np.zeros((2, SYMBOLS**ORDER), np.int32)
    for c, y in zip(codes, label):
        if len(c) >= ORDER:
            c = c.astype(np.int32)
            own = np.unique(c[:-3] << 15 | c[1:-2] << 10 | c[2:-1] << 5 | c[3:])
            n[int(y), own] += 1
    has_blank = np.zeros((SYMBOLS,) * ORDER, bool)
    for axis in range(ORDER):
        has_blank[(slice(None),) * axis + (0,)] = True
    odds = np.log((n[1] + 0.5) / (label.sum() + 1)) - np.log((n[0] + 0.5) / ((~label).sum() + 1))
    sure = odds * np.sqrt(n[1])
    return np.where((n[1] >= 3) & (odds > 1) & ~has_blank.ravel(), sure, 0).astype(np.float32)


def choose(codes: list[np.ndarray], label: np.ndarray, use: np.ndarray, weight: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Windows to fit on: the best ones of toxic texts, the best and random ones of clean texts."""
    windows, positive = [], []
    for c, y, u in zip(codes, label, use):
        if not u or len(c) < ORDER:
            continue
        sums = window_sums(starts(c, weight))
        # the window that is centred best: of a run of equal sums, the middle one
        at = []
        for _ in range(WITNESSES):
            top = float(sums.max())
            if y and top <= 0 and at:
                break
            same = np.flatnonzero(sums >= top - 1e-6)
            run = same[: int(np.argmax(np.append(np.diff(same) != 1, True))) + 1]
            at.append(int(run[len(run) // 2]))
            sums[max(0, at[-1] - WINDOW) : at[-1] + WINDOW] = -1e30
        if not y:
            at += rng.integers(0, len(c), WITNESSES).tolist()
        windows.append(fragments(c, np.array(at)))
        positive += [bool(y)] * len(at)
    return np.concatenate(windows), np.array(positive)


def gapped(windows: np.ndarray, rng) -> np.ndarray:
    """Windows with one to three characters put in at random: every place may be a gap from then on."""
    out = np.zeros_like(windows)
    width = windows.shape[1]
    for row, w in enumerate(windows):
        keep = np.ones(width, bool)
        keep[rng.integers(1, width, rng.integers(1, 4))] = False
        out[row, keep] = w[: keep.sum()]
    return out


def machine(windows: np.ndarray, positive: np.ndarray, rng) -> tuple[np.ndarray, float, tuple[np.ndarray, np.ndarray]]:
    """The weight of every subsequence, and the bias, of a machine on Nystroem features; also its landmarks
    and their coefficients."""
    half = LANDMARKS // 2
    pick = lambda of, n: rng.permutation(np.flatnonzero(of))[:n]
    landmark = np.unique(windows[np.concatenate([pick(positive, half), pick(~positive, half)])], axis=0)
    index, weight = subsequences(landmark)
    used, place = np.unique(index[weight > 0], return_inverse=True)
    table = np.zeros((len(used) + 1, len(landmark)), np.float32)
    row = np.broadcast_to(np.arange(len(landmark))[:, None], index.shape)[weight > 0]
    np.add.at(table, (place, row), weight[weight > 0])
    slot = np.full(SYMBOLS**ORDER, len(used), np.int32)
    slot[used] = np.arange(len(used))

    def kernel(of: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(of), 50):
            i, w = subsequences(of[at : at + 50])
            out.append(np.einsum("nf,nfm->nm", w, table[slot[i]]))
        return np.concatenate(out)

    value, vector = np.linalg.eigh(kernel(landmark).astype(np.float64))
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    x = (kernel(windows) @ root).astype(np.float32)
    y = np.where(positive, 1.0, -1.0)
    balance = np.where(positive, 0.5 / positive.mean(), 0.5 / (~positive).mean()) / len(y)
    w, b = squared_hinge(x, y, balance)
    alpha = root @ w
    return np.append(table[:-1] @ alpha, 0).astype(np.float32)[slot] * (slot < len(used)), b, (landmark, alpha)


def squared_hinge(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1e-4, steps: int = 30) -> tuple[np.ndarray, float]:
    """Minimise ridge/2 |w|^2 + sum share * max(0, 1 - y (xw + b))^2 by Newton steps."""
    z = np.column_stack([x, np.ones(len(x), x.dtype)])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-9
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        left, right = np.diag(penalty), np.zeros(len(w))
        for at in range(0, len(z), 2_000):
            part, own, sign = z[at : at + 2_000].astype(np.float64), share[at : at + 2_000], y[at : at + 2_000]
            own = own * (1 - sign * (part @ w) > 0)
            left = left + 2 * (part * own[:, None]).T @ part
            right += 2 * part.T @ (own * sign)
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w[:-1], float(w[-1])


def logistic(z: np.ndarray, label: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(z @ w)
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (label - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


# Spark --------------------------------------------------------------------------------------------


def fold(id: Column) -> Column:
    return F.crc32(id.cast("string")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Up to ``sample`` labelled rows of each class with a fold other than 0 and at most ``LONGEST``
    characters, the first by a hash of the id.  Rows without id or label are no training rows; an id
    with both labels counts as toxic."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    known = known.filter("id is not null and label is not null").filter(fold(F.col("id")) != 0).groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter(F.length("text").between(1, LONGEST))
    order = F.xxhash64("id")
    # labels meet the documents first, by ids alone; then the sample is chosen, and its texts are fetched
    usable = rows.select("id").distinct().join(known, "id")
    first = lambda y: usable.filter(F.col("label") == y).orderBy(order, "id").limit(sample)
    ids = Scratch(docs.sparkSession, "toxicity").save(first(1).unionByName(first(0)))
    # at most 2 * sample rows of two numbers: a bounded broadcast
    found = rows.join(F.broadcast(ids), "id").select("id", "label", "text")
    take = lambda y: found.filter(F.col("label") == y).orderBy(order, "id", "text").limit(sample)
    return take(1).unionByName(take(0))


def fit_toxicity(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """A model from labelled rows (see ``training_rows``), fitted on the driver."""
    rows = training_rows(docs, labels, **options).toArrow().to_pydict()
    order = np.argsort(rows["id"], kind="stable")
    return fit([rows["text"][i] for i in order], [rows["label"][i] for i in order])


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) to each row of ``docs``, replacing a column of that name.

    Null and empty texts have the score of a text without any hit; repeated rows score alike; whole
    texts are scored, in parts that overlap where they are very long.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]
    place = kept.index(text_col)
    source = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            texts = whole.column(place).to_pylist()
            scores = [own.scores(part) for part, _ in slices(texts, texts, 4_000_000)]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*whole.columns, pa.array(score, pa.float64())], names=[*kept, "score"])

    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema], "score double"])
    return source.mapInArrow(run, fields)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text of ``documents``, learnt from the labels of folds 1 to 4."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
