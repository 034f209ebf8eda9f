"""Toxicity by a small convolutional network over hashed word embeddings (operator 4).

A word's vector is the concatenation of rows of five hashed tables, one for the whole word and one for each of its first
4 to 7 bytes, so inflected forms share most of it and two words are confused only if they meet in all. Filters of widths 1, 2 and 3 run over the whole text, each keeps its maximum, and a dense layer gives
the logit. Every labelled row counts: four fifths of them, by a hash of the text, train the weights and the others set the
thresholds. A threshold per language is subtracted from the logit, so 0.5 is the decision in every language. The language
is guessed from the words of the text itself.

Training is a fixed number of passes of Spark over the labelled rows. The first counts in how many texts of each class a
table row occurs; the weights start at these log odds. In each of `ROUNDS` the tasks step through their own rows from the
shared weights, and the moves are averaged, those of a table row over the tasks that moved it. The last pass counts logits
in cells. The driver holds the weights, whose size is fixed, and the occupied cells.

Scoring runs in Arrow batches: each distinct word of a batch is projected once on all filter taps, occurrences add
looked-up rows. The model is broadcast; its size is fixed by the constants below.
"""

from __future__ import annotations

import pickle
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, releasing, table

#: Labels are handed to all tasks up to this many; beyond, the labelled texts are shuffled to their labels.
SHARED_LABELS = 250_000
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 6, (1, 2, 3), 8
STEMS = (4, 5, 6, 7)
TABLES = 1 + len(STEMS)
ROUNDS, PASSES, BATCH, RATE, SEED = 3, 2, 64, 0.05, 7     # passes: over each piece of a task's rows, in every round
SPAN, MERGED_TOGETHER = 1 << 13, 64                       # rows of a table, and tasks, that are averaged in one group
CELLS, FARTHEST = 256, 32                                 # cells of a unit of the logit; logits beyond are in the last ones

#: Frequent function words by language, for the language guess.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with as on be by this are from at or an not".split(),
    "fr": "le la les de des du un une et est que qui dans pour par sur pas au avec ce il".split(),
    "de": "der die das und ist nicht ein eine zu den von mit auf für im des dem sich auch es".split(),
    "es": "el la los las de que y en un una es por con para del se no su al lo como".split(),
}
LANGUAGES = (*FUNCTION_WORDS, "other")
_MARKED = sorted({w for words in FUNCTION_WORDS.values() for w in words})
_MARKS = np.array([[w in words for words in FUNCTION_WORDS.values()] for w in _MARKED] + [[False] * len(FUNCTION_WORDS)], np.int32)
_EDGES = string.punctuation + "«»“”‘’„…¡¿"
_PRIME = np.uint64(0x100000001B3)


def _bucketed(words: pa.Array) -> np.ndarray:
    """Rows of every word in the tables, shape (words, TABLES): byte-wise FNV hashes of the word and of its beginnings;
    row BUCKETS, which stays zero, where the word is shorter. Bytes beyond the 64th enter by one hash of the rest."""
    words = words.cast(pa.large_string())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    order = np.argsort(-size, kind="stable")
    start, longest = ends[:-1][order], size[order]
    h = np.full(len(words), 0xCBF29CE484222325, np.uint64)
    out = np.full((len(words), TABLES), BUCKETS, np.int64)
    for j in range(min(64, int(longest[0])) if len(longest) else 0):
        k = int(np.searchsorted(-longest, -j, "left"))                      # words longer than j bytes
        h[:k] = (h[:k] ^ data[start[:k] + j]) * _PRIME
        if j + 1 in STEMS:
            out[order[:k], 1 + STEMS.index(j + 1)] = _fold(h[:k])
    for i in range(int(np.searchsorted(-longest, -64, "left"))):            # the few longer ones by themselves
        h[i] = (h[i] ^ np.uint64(xxhash.xxh64_intdigest(data[start[i] + 64:start[i] + longest[i]].tobytes()))) * _PRIME
    out[order, 0] = _fold(h)
    return out


def _fold(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of every word, words per text, table rows of the distinct words, their language marks)."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    plain = pc.utf8_lower(coded.dictionary)
    bare = pc.utf8_trim(plain, _EDGES)
    plain = pc.if_else(pc.equal(bare, ""), plain, bare)
    marks = _MARKS[pc.fill_null(pc.index_in(plain, pa.array(_MARKED)), len(_MARKED)).to_numpy(zero_copy_only=False)]
    index = coded.indices.to_numpy().astype(np.int64)
    real = pc.not_equal(plain, "").to_numpy(zero_copy_only=False)
    if not real.all():                                        # an empty text, or white space at an end, is no word
        held = real[index]
        owner = np.repeat(np.arange(len(per_text)), per_text)[held]
        index, per_text = index[held], np.bincount(owner, minlength=len(per_text))
    return index, per_text, _bucketed(plain), marks


def languages_of(index, per_text, marks) -> np.ndarray:
    """The language whose function words are most frequent, "other" (the last) without any."""
    owner = np.repeat(np.arange(len(per_text)), per_text)
    votes = np.stack([np.bincount(owner, weights=marks[index, k], minlength=len(per_text))
                      for k in range(marks.shape[1])], 1)
    return np.where(votes.max(1) > 0, votes.argmax(1), marks.shape[1])


@dataclass
class Model:
    tables: np.ndarray                                  # (TABLES, BUCKETS + 1, DIM), the last row zero
    filters: list[np.ndarray]                           # per width: (width, TABLES * DIM, FILTERS)
    bias: np.ndarray                                    # (len(WIDTHS), FILTERS)
    dense: np.ndarray                                   # (len(WIDTHS) * FILTERS,)
    offset: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    constant: float | None = None                       # the score of every text if there was nothing to learn

    def logits(self, index, per_text, buckets) -> np.ndarray:
        return _forward(self, index, per_text, buckets)[0]

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores from 0 to 1 and the guessed languages; a null text scores as an empty one."""
        index, per_text, buckets, marks = words_of(texts)
        language = languages_of(index, per_text, marks)
        if self.constant is not None:
            return np.full(len(texts), self.constant), language
        margin = self.logits(index, per_text, buckets) - self.thresholds[language]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30))), language


def _layout(per_text):
    """Places of words in one row of all texts, each followed by pads; start of each text, and the row's length."""
    pad = max(WIDTHS)
    starts = np.cumsum(per_text + pad) - (per_text + pad)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text) + starts[owner]
    return place, starts, int((per_text + pad).sum())


def _forward(m: Model, index, per_text, buckets, keep: bool = False):
    vectors = np.concatenate([t[buckets[:, k]] for k, t in enumerate(m.tables)], 1)
    place, starts, size = _layout(per_text)
    row = np.full(size + max(WIDTHS), len(vectors), np.int64)              # pads read the zero row at the end
    row[place] = index
    pooled, maps = [], []                                                  # the maps are kept for training alone
    for k, f in zip(WIDTHS, m.filters):
        out = np.zeros((size, FILTERS), np.float32)
        for j in range(k):
            taps = np.concatenate([vectors @ f[j], np.zeros((1, FILTERS), np.float32)])
            out += np.take(taps, row[j:size + j], axis=0)
        reach = starts[:, None] + (per_text + max(WIDTHS))[:, None] - 1 - np.arange(k - 1)
        out[reach.reshape(-1)] = -np.inf                                   # these windows reach into the next text
        pooled.append(np.maximum.reduceat(out, starts, axis=0) if len(starts) else out)
        if keep:
            maps.append(out)
    act = np.maximum(np.stack(pooled, 1) + m.bias, 0).reshape(len(per_text), -1)
    logit = act @ m.dense + m.offset
    return (logit, act, pooled, maps, vectors, row, starts) if keep else (logit,)


def occurrences(index, per_text, buckets, y) -> np.ndarray:
    """Texts of each class that meet a row of a table: (2, TABLES, BUCKETS + 1)."""
    held = np.zeros((2, TABLES, BUCKETS + 1), np.int64)
    if not len(index):
        return held
    owner = np.repeat(np.arange(len(per_text)), per_text)
    owner, word = np.divmod(np.unique(owner * len(buckets) + index), len(buckets))
    for h in range(TABLES):
        text, row = np.divmod(np.unique(owner * (BUCKETS + 1) + buckets[word, h]), BUCKETS + 1)
        np.add.at(held, (y[text], h, row), 1)
    return held


def _start(held: np.ndarray, toxic: int, clean: int, rng) -> Model:
    """Random small weights; the first dimension of a word starts at its bucket's smoothed log odds."""
    tables = rng.normal(0, 0.05, (TABLES, BUCKETS + 1, DIM)).astype(np.float32)
    for h in range(TABLES):
        neg, pos = held[:, h]
        odds = np.log((pos + 1) / (toxic + 2)) - np.log((neg + 1) / (clean + 2))
        tables[h, :, 0] = np.where(pos + neg > 0, odds * (pos + neg) / (pos + neg + 10), 0) / 2
    tables[:, BUCKETS] = 0
    filters = [rng.normal(0, 0.1, (k, TABLES * DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    for f in filters:
        f[:, ::DIM, :] += 0.4 / len(f)
    return Model(tables, filters, np.zeros((len(WIDTHS), FILTERS), np.float32),
                 rng.normal(0.1, 0.05, len(WIDTHS) * FILTERS).astype(np.float32), -1.0)


class Learner:
    """A model and its Adagrad sums: one for each row of a table, one for each of the other weights, which lie in ``rest``."""

    def __init__(self, model: Model):
        self.model = model
        self.seen = np.full((TABLES, BUCKETS + 1), 1e-3, np.float32)
        self.rest = np.concatenate([x.ravel() for x in (*model.filters, model.bias, model.dense)] + [[model.offset]]).astype(np.float32)
        self.rest_seen = np.full(len(self.rest), 1e-3, np.float32)
        self.begin()

    def begin(self) -> None:
        """Moves count from here."""
        self.first = self.model.tables.copy(), self.seen.copy(), self.rest.copy(), self.rest_seen.copy()
        self.moved, self.steps = np.zeros((TABLES, BUCKETS + 1), np.int32), 0
        self._spread()

    def _spread(self) -> None:
        m, at = self.model, 0
        for x in (*m.filters, m.bias, m.dense):
            x[...] = self.rest[at:at + x.size].reshape(x.shape)
            at += x.size
        m.offset = float(self.rest[at])

    def step(self, index, per_text, buckets, y, weight) -> None:
        """One step on a batch of texts."""
        m, dims = self.model, TABLES * DIM
        logit, act, pooled, maps, vectors, row, starts = _forward(m, index, per_text, buckets, keep=True)
        d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / len(y)).astype(np.float32)
        d_act = (d[:, None] * m.dense * (act > 0)).reshape(len(y), len(WIDTHS), FILTERS)
        d_word = np.zeros((len(vectors) + 1, dims), np.float32)
        padded = np.concatenate([vectors, np.zeros((1, dims), np.float32)])
        stops = np.append(starts[1:], len(maps[0]))
        grads = []
        for w, (k, f) in enumerate(zip(WIDTHS, m.filters)):
            top = np.stack([maps[w][a:b].argmax(0) + a for a, b in zip(starts, stops)])      # rows x filters
            g = d_act[:, w]
            grad = np.zeros_like(f)
            for j in range(k):
                at = row[top + j]
                grad[j] = np.einsum("rfd,rf->df", padded[at], g)
                np.add.at(d_word, at.reshape(-1), (g[:, :, None] * f[j].T[None]).reshape(-1, dims))
            grads.append(grad.ravel())
        grad = np.concatenate([*grads, d_act.sum(0).ravel(), act.T @ d + 1e-4 * m.dense, [d.sum()]]).astype(np.float32)
        self.rest_seen[:-1] += grad[:-1] ** 2
        self.rest_seen[-1] = 1                                # the offset takes plain steps
        self.rest -= RATE * grad / np.sqrt(self.rest_seen)
        self._spread()
        hit = np.flatnonzero(np.abs(d_word[:-1]).sum(1))              # words at some filter's maximum
        for h in range(TABLES):
            at, into = np.unique(buckets[hit, h], return_inverse=True)
            grad = np.zeros((len(at), DIM), np.float32)
            np.add.at(grad, into, d_word[hit, h * DIM:(h + 1) * DIM])
            at, grad = at[at < BUCKETS], grad[at < BUCKETS]
            self.seen[h, at] += (grad * grad).mean(1)
            m.tables[h, at] -= RATE * grad / np.sqrt(self.seen[h, at])[:, None]
            self.moved[h, at] += 1
        self.steps += 1

    def learn(self, index, per_text, buckets, y, weight, rng, passes: int = 1) -> None:
        """Step ``passes`` times through texts in a random order."""
        ends = np.cumsum(per_text)
        for _ in range(passes if len(y) else 0):
            for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
                words = np.concatenate([index[ends[r] - per_text[r]:ends[r]] for r in rows])
                local, back = np.unique(words, return_inverse=True)
                self.step(back, per_text[rows], buckets[local], y[rows], weight[rows])

    def moves(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(key, places, weights, moves times weights) of what moved: a span of rows of a table, and the rest (key -1)."""
        tables, seen, rest, rest_seen = self.first
        if self.steps:
            yield (-1, np.arange(len(rest)), np.full(len(rest), self.steps),
                   np.stack([self.rest - rest, self.rest_seen - rest_seen], 1) * self.steps)
        for h in range(TABLES):
            for at in range(0, BUCKETS, SPAN):
                rows = at + np.flatnonzero(self.moved[h, at:at + SPAN])
                if len(rows):
                    n = self.moved[h, rows]
                    move = np.concatenate([self.model.tables[h, rows] - tables[h, rows], (self.seen[h, rows] - seen[h, rows])[:, None]], 1)
                    yield h * BUCKETS + at, rows, n, move * n[:, None]

    def take(self, key: int, rows: np.ndarray, n: np.ndarray, move: np.ndarray) -> None:
        """Make the average of moves."""
        mean = (move / n[:, None]).astype(np.float32)
        if key < 0:
            self.rest[rows] += mean[:, 0]
            self.rest_seen[rows] += mean[:, 1]
        else:
            self.model.tables[key // BUCKETS, rows] += mean[:, :DIM]
            self.seen[key // BUCKETS, rows] += mean[:, DIM]


def _constant(score: float) -> Model:
    none = Model(np.zeros((TABLES, 1, DIM), np.float32), [], np.zeros(0), np.zeros(0), 0.0)
    none.constant = score
    return none


def _class_weights(y: np.ndarray, clean: int, toxic: int) -> np.ndarray:
    """Both classes weigh as much as the other."""
    return np.where(y == 1, 0.5 / max(1, toxic), 0.5 / max(1, clean)) * (clean + toxic)


def fit(texts: list[str], toxic: np.ndarray, seed: int = SEED, epochs: int = ROUNDS * PASSES) -> Model:
    """The training of `train` on texts in memory, as one task; every fifth text of a class sets the thresholds."""
    y = np.asarray(toxic, np.int64)
    if not len(y) or y.min() == y.max():
        return _constant(float(y[0]) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    held = np.zeros(len(y), bool)
    for c in (0, 1):
        mine = np.flatnonzero(y == c)
        held[mine[rng.permutation(len(mine))[:len(mine) // 5]]] = True
    column = pa.array(texts, pa.string())
    index, per_text, buckets, _ = words_of(column.filter(pa.array(~held)))
    known = y[~held]
    clean, toxic = np.bincount(known, minlength=2)
    learner = Learner(_start(occurrences(index, per_text, buckets, known), toxic, clean, rng))
    learner.learn(index, per_text, buckets, known, _class_weights(known, clean, toxic), rng, epochs)
    index, per_text, buckets, marks = words_of(column.filter(pa.array(held)))
    logit = learner.model.logits(index, per_text, buckets) if held.any() else np.empty(0)
    learner.model.thresholds = _thresholds(logit, logit, y[held], np.ones(held.sum(), np.int64), languages_of(index, per_text, marks))
    return learner.model


def _best_cut(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The middle of the widest gap among cuts with the largest hit rate less false-alarm rate, between cells of logits:
    ``n`` rows of a class from ``low`` to ``high``."""
    at, cell = np.unique(np.floor(np.clip(low, -FARTHEST, FARTHEST) * CELLS), return_inverse=True)
    if len(at) == 1:
        return float(low.min() + high.max()) / 2
    first, last = np.full(len(at), np.inf), np.full(len(at), -np.inf)
    np.minimum.at(first, cell, low)
    np.maximum.at(last, cell, high)
    neg, pos = (np.bincount(cell, weights=n * (toxic == c), minlength=len(at)) for c in (0, 1))
    gain = np.cumsum(neg) / max(1, neg.sum()) - np.cumsum(pos) / max(1, pos.sum())
    best = max(range(len(at) - 1), key=lambda i: (round(gain[i], 6), first[i + 1] - last[i]))
    return float(last[best] + first[best + 1]) / 2


def _thresholds(low, high, toxic, n, language) -> np.ndarray:
    """Cut of the rows counted in each language; one for all where a language has few rows of a class."""
    total = np.bincount(toxic, weights=n, minlength=2)
    if not total.all():
        return np.zeros(len(LANGUAGES))
    every = _best_cut(low, high, toxic, n)
    cuts = np.full(len(LANGUAGES), every)
    for k in range(len(LANGUAGES)):
        mine = language == k
        few = np.bincount(toxic[mine], weights=n[mine], minlength=2).min()
        if few:
            cuts[k] = (few * _best_cut(low[mine], high[mine], toxic[mine], n[mine]) + 10 * every) / (few + 10)
    return cuts


# ------------------------------------------------------------------------------------------------ on tables

def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _known(docs: DataFrame, labels: DataFrame, held_fold: int | None) -> DataFrame:
    """text, toxic and apart (the row sets thresholds) of every labelled row outside ``held_fold``."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    if held_fold is not None:
        known = known.where(fold(F.col("doc_id")) != held_fold)
    known = cut(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    if known.limit(SHARED_LABELS + 1).count() <= SHARED_LABELS:
        known = F.broadcast(known)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where("doc_id IS NOT NULL")
    if held_fold is not None:
        texts = texts.where(fold(F.col("doc_id")) != held_fold)
    return cut(texts.join(known, "doc_id").select("text", "toxic", (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("apart")),
               "labelled", compression="zstd")


def train(docs: DataFrame, labels: DataFrame, held_fold: int | None = 0) -> Model:
    """Fit on the whole texts of all labelled rows outside ``held_fold``. Null labels and ids are no labels; an id with both
    labels is toxic; a null text is learned from as an empty one, equal texts as often as they occur."""
    prepare(docs.sparkSession)
    rows = _known(docs, labels, held_fold)
    sizes = {(r["toxic"], r["apart"]): r["n"] for r in rows.groupBy("toxic", "apart").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = {c for c, _ in sizes}
    if len(found) < 2:
        return _constant(float(*found) if found else 0.0)
    rows = rows.select("text", "toxic", "apart")
    learned = rows if any((c, False) not in sizes for c in (0, 1)) else rows.where("NOT apart")
    judged = rows if any((c, True) not in sizes for c in (0, 1)) else rows.where("apart")
    clean, toxic = (sizes.get((c, False), 0) + (sizes.get((c, True), 0) if learned is rows else 0) for c in (0, 1))
    learner = Learner(_start(_occurrences(learned), toxic, clean, np.random.default_rng(SEED)))
    for number in range(ROUNDS):
        _round(learned, learner, number, clean, toxic)
    model = learner.model
    model.thresholds = _judge(judged, model)
    return model


def _labels_of(piece: pa.RecordBatch) -> np.ndarray:
    return piece.column("toxic").to_numpy().astype(np.int64)


def _occurrences(rows: DataFrame) -> np.ndarray:
    shape = 2, TABLES, BUCKETS + 1

    def count(batches):
        held = np.zeros(shape, np.int64)
        for piece in _pieces(batches):
            held += occurrences(*words_of(piece.column("text"))[:3], _labels_of(piece))
        cell = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(held.ravel()[cell])], ["cell", "n"])

    found = rows.mapInArrow(releasing(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape, np.int64)
    out.ravel()[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


_MOVES = "key int, part int, place binary, weight binary, move binary"


def _moves_row(key: int, part: int, place: np.ndarray, weight: np.ndarray, move: np.ndarray) -> pa.RecordBatch:
    pack = lambda x, kind: pa.array([np.ascontiguousarray(x, kind).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([part], pa.int32()), pack(place, "<i4"),
                                       pack(weight, "<i8"), pack(move, "<f4")], ["key", "part", "place", "weight", "move"])


def _moves_of(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = np.frombuffer(row["place"], "<i4")
    return place, np.frombuffer(row["weight"], "<i8"), np.frombuffer(row["move"], "<f4").reshape(len(place), -1)


def _round(rows: DataFrame, learner: Learner, number: int, clean: int, toxic: int) -> None:
    """One round: every task learns from its rows, and the averages of all moves are made."""
    learner.begin()
    shared = rows.sparkSession.sparkContext.broadcast((learner.model, learner.seen, learner.rest_seen))

    def learn(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        model, seen, rest_seen = pickle.loads(pickle.dumps(shared.value))       # other tasks of the process start from it too
        mine = Learner(model)
        mine.seen, mine.rest_seen = seen, rest_seen
        mine.begin()
        rng = np.random.default_rng((SEED, number, part))
        for piece in _pieces(batches):
            y = _labels_of(piece)
            mine.learn(*words_of(piece.column("text"))[:3], y, _class_weights(y, clean, toxic), rng, PASSES)
        for key, *what in mine.moves():
            yield _moves_row(key, part, *what)

    def together(key, table):
        parts = [_moves_of(r) for r in sorted(table.to_pylist(), key=lambda r: r["part"])]      # sums in a fixed order
        place, into = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        weight, move = np.zeros(len(place), np.int64), np.zeros((len(place), parts[0][2].shape[1]))
        np.add.at(weight, into, np.concatenate([p[1] for p in parts]))
        np.add.at(move, into, np.concatenate([p[2] for p in parts]))
        part = key[1].as_py() if len(key) > 1 else 0
        return pa.Table.from_batches([_moves_row(key[0].as_py(), part, place, weight, move)])

    moves = rows.mapInArrow(releasing(learn), _MOVES)
    some = moves.groupBy("key", F.floor(F.col("part") / MERGED_TOGETHER).cast("int").alias("some")).applyInArrow(together, _MOVES)
    for row in some.groupBy("key").applyInArrow(together, _MOVES).collect():            # spans of the tables, as bytes
        learner.take(row["key"], *_moves_of(row))
    learner.begin()
    shared.destroy()


def _judge(rows: DataFrame, model: Model) -> np.ndarray:
    """Thresholds from the logits of all ``rows``, counted in cells."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for piece in _pieces(batches):
            index, per_text, buckets, marks = words_of(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(languages_of(index, per_text, marks).astype(np.int32)), pa.array(_labels_of(piece)),
                 pa.array(shared.value.logits(index, per_text, buckets).astype(np.float64))], ["language", "toxic", "logit"])

    cell = F.floor(F.least(F.greatest("logit", F.lit(-float(FARTHEST))), F.lit(float(FARTHEST))) * CELLS).alias("cell")
    found = (rows.mapInArrow(releasing(judge), "language int, toxic long, logit double").groupBy("language", "toxic", cell)
             .agg(F.min("logit").alias("low"), F.max("logit").alias("high"), F.count(F.lit(1)).alias("n")).toArrow())
    shared.destroy()
    return _thresholds(*(found.column(c).to_numpy() for c in ("low", "high", "toxic", "n", "language")))


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of batches with texts of at most ``most`` bytes, or one longer text."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def _batches(batches: Iterator[pa.RecordBatch], model: Model):
    for piece in _pieces(batches):
        yield piece, *model.scores(piece.column("text"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher: more likely toxic) and guessed language per row of ``docs`` (doc_id, text).

    Whole texts are scored; null texts as empty ones. Only the text is read: other columns, clashing or not, are ignored.
    Repeated rows get equal scores; an empty table gives no rows. Without labels of both classes every text scores 1 if
    all labels are toxic, else 0.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece, scores, language in _batches(batches, shared.value):
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(scores, pa.float64()), pa.array([LANGUAGES[k] for k in language])],
                ["doc_id", "score", "language"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(releasing(run), f"doc_id {kind}, score double, language string")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that score below 0.5."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece, scores, _ in _batches(batches, shared.value):
            yield piece.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(releasing(run), docs.schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "language")
