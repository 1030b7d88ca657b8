"""Toxicity by a support vector machine over a gap-tolerant subsequence string kernel with Nyström landmarks.

The kernel compares strings by their three-letter subsequences that span at most ``SPAN`` characters; each
character skipped inside a subsequence multiplies its weight by ``DECAY``. Digits and signs can only be skipped,
and so can blanks beside single letters; a run of them counts as one, and other blanks as a letter that marks the ends
of words. Between three or more letters that all stand alone, as in a spelled-out word, the runs are skipped at no cost.
So ``i-d i.o_t`` and ``i - d...i--o--t`` have the subsequences of ``idiot``. Letters are folded first: accented, full-width and styled ones
count as their plain letters, and dashes, bullets and zero-width characters of any script are signs. A text is a bag of windows as long as a
landmark (and nearly twice as long, for inserted characters); its similarity to a landmark is the best normalised
kernel value of a window, and the number of near matches is kept beside it.

Landmarks are letter sequences that the labelled sample sets apart. Similarities to them are whitened by the
landmarks' own kernel matrix (Nyström), a linear machine with squared hinge loss is fitted on a bounded sample of
labelled rows, and its margin is turned into a probability. Fitting needs a few thousand small rows on the driver;
scoring streams over all documents.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN, DECAY = 5, 0.6
OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
LETTERS, BLANK = 64, 63
LOW, NEAR = 0.35, 0.68  # similarities count from LOW, and fully from NEAR
MAX_TRAIN = 12_000
LANDMARKS = 32
GRAM = (4, 8)
THRESHOLD = 0.3
PIECE = 1 << 18


def folded(text: str) -> str:
    """Lower case; compatible forms (full width, ligatures, styled letters) and letters with marks as their plain letters."""
    if text.isascii():
        return text.lower()
    plain = unicodedata.normalize("NFKD", text).lower()
    return plain if plain.isascii() else "".join(c for c in plain if not unicodedata.category(c).startswith("M"))


def _letters(text: str) -> np.ndarray:
    """Letter numbers of the folded text: 1 to 26 for a-z, 27 to 62 for other letters, 63 for blanks of any kind, 0 for all else.

    What is a letter or a blank is told by its Unicode category, so signs, dashes, digits and characters without width are 0.
    """
    points = np.frombuffer(folded(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.zeros(len(points), np.int32)
    latin = (points >= 97) & (points <= 122)
    codes[latin] = points[latin] - 96
    codes[(points == 32) | ((points >= 9) & (points <= 13))] = BLANK
    beyond = points >= 128
    if beyond.any():
        distinct, back = np.unique(points[beyond], return_inverse=True)
        kinds = [unicodedata.category(chr(p))[0] for p in distinct.tolist()]
        codes[beyond] = np.array([27 + p % 36 if k == "L" else BLANK if k == "Z" else 0 for p, k in zip(distinct.tolist(), kinds)], np.int32)[back]
    return codes


def encode(text: str) -> np.ndarray:
    """Letter numbers, with one 63 for the blanks between words and one 0 for each run of what can be skipped.

    Blanks are skipped between two runs of characters that hold one letter or none, as in a spelled-out word. Runs
    between neighbours of three or more letters that stand alone leave no 0.
    """
    end = np.array([BLANK], np.int32)  # a text begins and ends like a word
    codes = np.concatenate([end, _letters(text), end])
    blank = codes == BLANK
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
    at = np.flatnonzero(codes == BLANK)
    short = np.add.reduceat((codes > 0) & (codes != BLANK), at[:-1], dtype=np.int64) <= 1
    codes[at[1:-1][short[:-1] & short[1:]]] = 0
    skipped = codes == 0
    codes = codes[~(skipped & np.concatenate([[False], skipped[:-1]]))]
    return codes[~_free_runs(codes)]


def _free_runs(codes: np.ndarray) -> np.ndarray:
    """The single 0s between neighbours of three or more letters that stand alone."""
    free = np.zeros(len(codes), bool)
    letter = (codes > 0) & (codes != BLANK)
    alone = letter.copy()
    alone[1:] &= ~letter[:-1]
    alone[:-1] &= ~letter[1:]
    link = np.zeros(len(codes), bool)  # a 0 between two letters that stand alone
    link[1:-1] = (codes[1:-1] == 0) & alone[:-2] & alone[2:]
    free[2:] |= link[2:] & link[:-2]
    free[:-2] |= link[:-2] & link[2:]
    return free


def subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """By pair of offsets: triple numbers at all starts, which of them are whole, and their weight.

    The last SPAN - 1 codes must be zero.
    """
    n = len(codes) - SPAN + 1
    letter = codes > 0
    high, middle = codes[:n] * (LETTERS * LETTERS), codes * LETTERS
    for a, b in OFFSETS:
        yield high + middle[a : a + n] + codes[b : b + n], letter[:n] & letter[a : a + n] & letter[b : b + n], DECAY ** (b - 2)


def landmark_codes(z: str) -> np.ndarray:
    """As ``encode``, but only the blanks that the landmark has itself."""
    return _letters(z)


@dataclass
class Kernel:
    """Landmarks and, for each subsequence in one of them, who has it and with what weight."""

    landmarks: list[str]

    def __post_init__(self):
        rows = []
        self.norm = np.zeros(len(self.landmarks))
        for j, z in enumerate(self.landmarks):
            weights: Counter = Counter()
            for triple, whole, w in subsequences(np.concatenate([landmark_codes(z), np.zeros(SPAN, np.int32)])):
                for t in triple[whole].tolist():
                    weights[t] += w
            self.norm[j] = np.sqrt(sum(w * w for w in weights.values())) or 1.0
            rows += [(t, j, w) for t, w in weights.items()]
        rows.sort()
        triples = np.array([r[0] for r in rows], np.int64)
        self.owner, self.weight = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.float64)
        known, first, self.count = np.unique(triples, return_index=True, return_counts=True)
        self.first = first
        self.number = np.zeros(LETTERS**3, np.int32)
        self.number[known] = np.arange(len(known))
        self.known = np.zeros(LETTERS**3, bool)
        self.known[known] = True
        self.length = np.array([len(landmark_codes(z)) for z in self.landmarks], np.int64)
        # the largest share of a landmark's squared norm that one occurrence of a subsequence can stand for
        self.reach = np.zeros(len(known))
        np.maximum.at(self.reach, np.repeat(np.arange(len(known)), self.count), self.weight**2 / self.norm[self.owner] ** 2)

    def similarities(self, texts: list[str | None]) -> np.ndarray:
        """One row per text: best similarity to each landmark, then log(1 + near matches) with each."""
        m = len(self.landmarks)
        out = np.zeros((len(texts), 2 * m))
        gap = np.zeros(2 * int(self.length.max()) + SPAN, np.int32)  # no window reaches over it
        parts, owners, size = [], [], 0
        for i, t in enumerate(texts):
            codes = encode(t or "")
            for k in range(0, max(len(codes), 1), PIECE):  # pieces overlap by more than a window
                parts.append(np.concatenate([codes[max(0, k - 32) : k + PIECE], gap]))
                owners.append(i)
                size += len(parts[-1])
                if size > PIECE:
                    self._add(out, parts, owners)
                    parts, owners, size = [], [], 0
        if parts:
            self._add(out, parts, owners)
        out[:, m:] = np.log1p(out[:, m:])
        return out

    def _add(self, out: np.ndarray, parts: list[np.ndarray], owners: list[int]) -> None:
        m = len(self.landmarks)
        codes = np.concatenate(parts)
        doc = np.repeat(np.array(owners), [len(p) for p in parts])
        n = len(codes) - SPAN + 1
        square = np.zeros(len(codes) + 1, np.float32)
        starts, triples, weights = [], [], []
        for triple, whole, w in subsequences(codes):
            square[1 : n + 1] += whole * np.float32(w * w)
            hit = np.flatnonzero(self.known[triple])  # a known triple is whole
            starts.append(hit)
            triples.append(triple[hit])
            weights.append(np.full(len(hit), w))
        square = np.cumsum(square, dtype=np.float64)
        at, n, w = np.concatenate(starts), self.number[np.concatenate(triples)], np.concatenate(weights)
        # by Cauchy and Schwarz a window's squared value is at most the sum of what its subsequences can stand for, so no value above LOW is lost
        around = np.concatenate([[0.0], np.cumsum(np.bincount(at, self.reach[n], minlength=len(codes)))])
        width = 2 * int(self.length.max())
        dense = around[np.minimum(at + width, len(codes))] - around[np.maximum(at - width, 0)] >= LOW * LOW - 1e-6
        at, n, w = at[dense], n[dense], w[dense]
        if not len(at):
            return
        times = self.count[n]
        entry = np.repeat(self.first[n] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        who, value = self.owner[entry], np.repeat(w, times) * self.weight[entry]
        key, inverse = np.unique(who * len(codes) + np.repeat(at, times), return_inverse=True)
        total = np.concatenate([[0.0], np.cumsum(np.bincount(inverse, value))])
        who, at = key // len(codes), key % len(codes)
        best = np.zeros(len(key))
        for width in (self.length[who], 2 * self.length[who] - 1):
            last = np.searchsorted(key, key + width - 2)  # subsequences that begin early enough to fit, nearly
            end = np.minimum(at + width - 2, len(codes))
            inner = total[last] - total[np.arange(len(key))]
            best = np.maximum(best, inner / (np.sqrt(np.maximum(square[end] - square[at], 1e-9)) * self.norm[who]))
        best = np.clip((best - LOW) / (NEAR - LOW), 0, 1)
        owner = doc[at]
        np.maximum.at(out, (owner, who), best)
        near = best >= 1
        np.add.at(out, (owner[near], m + who[near]), 1.0)


@dataclass
class Model:
    kernel: Kernel | None
    whiten: np.ndarray | None = None
    weights: np.ndarray | None = None
    slope: float = 0.0
    offset: float = 0.0

    def features(self, similarities: np.ndarray) -> np.ndarray:
        m = len(self.kernel.landmarks)
        return np.hstack([similarities[:, :m] @ self.whiten, similarities[:, m:], np.ones((len(similarities), 1))])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(texts), self.offset)
        margin = self.features(self.kernel.similarities(texts)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; y is -1 or 1."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve(ridge + cost * xa.T @ xa, cost * xa.T @ y[active])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def _platt(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the margins."""
    x, t = np.column_stack([margin, np.ones(len(margin))]), toxic * (len(toxic) / (len(toxic) + 2.0)) + 1.0 / (len(toxic) + 2)
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p) - 1e-6 * ab)
        ab = ab + step
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {"".join(c for c in w if c.isalpha()) for w in set(folded(text or "").split())}
            (toxic if label else clean).update(f" {w} " for w in words if GRAM[0] - 1 <= len(w) <= 40)
    words = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_pydict({"word": words, "toxic": [toxic[w] for w in words], "clean": [clean[w] for w in words]}, schema=pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]))


def choose_landmarks(sample: DataFrame, n_toxic: int, n_clean: int, limit: int = LANDMARKS) -> list[str]:
    """Letter sequences that toxic rows hold at least three times as often as chance, without near repeats.

    They have 4 to 8 characters, where a blank stands for the end of a word.
    """
    words = sample.select("text", "toxic").mapInArrow(_words, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    grams = F.flatten(F.transform(F.sequence(F.lit(GRAM[0]), F.least(F.lit(GRAM[1]), F.length("word"))), lambda n: F.transform(F.sequence(F.lit(1), F.length("word") - n + 1), lambda i: F.substring("word", i, n))))
    counted = words.select(F.explode(F.array_distinct(grams)).alias("gram"), "toxic", "clean").groupBy("gram").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    expected = (F.col("t") + F.col("c")) * (n_toxic / (n_toxic + n_clean))
    score = (F.col("t") - expected) / F.sqrt(expected + 1)
    often = counted.where((F.col("t") >= max(5, n_toxic // 40)) & (F.col("t") >= 3 * expected))
    best = often.select("gram", score.alias("s")).orderBy(F.round("s", 3).desc(), F.length("gram").desc(), "gram").limit(60 * limit).collect()
    chosen: list[str] = []
    for row in best:
        pieces = {row.gram[i : i + GRAM[0]] for i in range(len(row.gram) - GRAM[0] + 1)}
        if len(chosen) < limit and not any(p in z for z in chosen for p in pieces):
            chosen.append(row.gram)
    return chosen


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows, taken in the order of a hash of doc_id, never held-out ones.

    Null texts count as empty, null labels not at all; a repeated row counts each time. Without rows of both labels, or
    without a sequence that tells them apart, the model gives one score to all texts. The same rows give the same model
    however they are partitioned. Long texts are taken whole.
    """
    usable = labels.where(~held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    taken = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_train)
    sample = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("text", (F.col("toxic") == 1).cast("int").alias("toxic"), F.xxhash64("text", "toxic").alias("place")).persist()
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    landmarks = choose_landmarks(sample, n_toxic, n_clean) if n_toxic and n_clean else []
    if not landmarks:
        sample.unpersist()
        return Model(None, offset=(n_toxic + 1) / (n_toxic + n_clean + 20))
    kernel = Kernel(landmarks)

    def measure(batches):
        for batch in batches:
            x = kernel.similarities(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel(), pa.float64()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["toxic", "place", "x"])

    rows = sample.mapInArrow(measure, "toxic int, place long, x array<double>").toArrow().sort_by([("place", "ascending"), ("toxic", "ascending")])
    sample.unpersist()
    toxic = rows.column("toxic").to_numpy().astype(float)
    x = np.stack([np.asarray(v) for v in rows.column("x").to_pylist()])
    m = len(landmarks)
    gram = kernel.similarities(landmarks)[:, :m]
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    model = Model(kernel, vectors / np.sqrt(np.maximum(values, 0.05)))
    features = model.features(x)
    # the margins that the curve is fitted to come from machines that did not see their rows
    fold, margin = rows.column("place").to_numpy() % 3, np.zeros(len(toxic))
    for k in range(3):
        margin[fold == k] = features[fold == k] @ _machine(features[fold != k], 2 * toxic[fold != k] - 1)
    model.weights = _machine(features, 2 * toxic - 1)
    model.slope, model.offset = _platt(margin, toxic)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1); a column of that name is replaced, all others stay. Null text counts as empty.

    Texts of any length are read whole, in overlapping pieces. Equal texts have equal scores. Empty in, empty out.
    """
    docs = docs.drop("score")

    def scored(batches):
        for batch in batches:
            made = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
