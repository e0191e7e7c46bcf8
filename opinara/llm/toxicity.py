"""Toxicity of texts by a support vector machine on a subsequence string kernel.

The kernel of two words counts the sequences of four characters they share in order, with gaps: one that spans n
characters weighs DECAY ** n, up to a span of SPAN, and the sums are normalised to one for equal words. So
an insult with a letter slipped in, or with one replaced, stays close to itself. Nyström landmarks, words of
the labelled sentences, turn the kernel into features; a linear machine with squared hinge loss is trained on
them. Its function is a weighted sum of sequences over the word's norm, so that scoring a word looks up its
sequences in one table, whatever the number of landmarks.

Training takes a bounded sample of labelled texts (at most about `SAMPLE` of each label, by the hash of their
ids). Labels are of whole texts; a toxic text's witnesses are words that follow far more different words in
toxic than in other texts (copies of a text add nothing to that count).
Witnesses, also with a character slipped in, are the positive words, the words of other texts the
negative ones; twice the negative words that the machine takes for toxic are made landmarks and it is trained
again. A quarter of the sample is kept back to turn a text's three largest word scores into a probability.

A text is scored as a whole: every word, words without the characters that are no letters or digits, and
runs of single letters joined. Its worst words decide.

Defined results: a missing or empty text has no words and gets the score of a text without any sequence of the
table; without labelled texts of both kinds every score is 0; repeated rows get equal scores; extra columns
pass through, those named as a result column are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import text_bytes

SAMPLE = 3000
SPAN = 6
DECAY = 0.7
LANDMARKS = 120  # of witnesses, and as many of other words
NEGATIVES = 15_000
ROUNDS = 2
RIDGE = 1e-3
CACHE = 300_000
STEP = 4000  # words whose sequences are laid out at once
TOP, MARGIN = 3.0, 1.0
FEATURES = 5
MIN_SEEN = 4
MIN_ODDS = 2.0
BITS = 20
GAPS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]
_MARKS = ".,;:!?\"'()[]{}<>-_*#"  # the commonest of what _EDGE finds
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)\w(?:[ \t]\w){2,}(?!\S)")


def words_of(text: str) -> set[str]:
    """The distinct words of a text, lower-cased, with the characters between their letters."""
    low = text.lower()
    words = low.split()
    found = set(words)
    alone = [i for i, w in enumerate(words) if len(w) == 1]
    # a spelled word is three letters in a row at least
    if any(a + 2 == b for a, b in zip(alone, alone[2:], strict=False)):
        found.update("".join(m.group().split()) for m in _SPELLED.finditer(low))
    return found


def units(word: str) -> list[str]:
    """A raw word without outer punctuation, and if others stand inside, also its letters alone."""
    plain = word.strip(_MARKS)
    if plain.isalnum():
        return [plain]
    plain = _EDGE.sub("", word)
    bare = _INNER.sub("", plain)
    return [plain] if bare == plain else [plain, bare] if plain else []


@dataclass
class Sequences:
    """Weighted sequences of words: flat arrays, with the word of each."""

    code: np.ndarray
    weight: np.ndarray
    word: np.ndarray
    n: int

    def least_norms(self) -> np.ndarray:
        """Root of each word's sums of squares: its norm, if no sequence occurs twice in it, else less."""
        return np.sqrt(np.bincount(self.word, self.weight * self.weight, self.n))

    def norms(self) -> np.ndarray:
        """Root of each word's kernel with itself."""
        total = self.weight * self.weight
        again = self.repeated()
        order = again[np.lexsort((self.code[again], self.word[again]))]
        code, word = self.code[order], self.word[order]
        new = np.append(True, (np.diff(code) != 0) | (np.diff(word) != 0)) if len(code) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        total[order] = 0
        if len(first):
            total[order[first]] = np.add.reduceat(self.weight[order], first) ** 2
        return np.sqrt(np.bincount(self.word, total, self.n))

    def repeated(self) -> np.ndarray:
        """Places of the sequences that occur twice in their word, by a sort of numbers alone."""
        key = self.code * np.uint64(0x9E3779B97F4A7C15) + self.word.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return np.zeros(0, np.int64)
        low = np.uint64(0xFFFF)
        seen = np.zeros(1 << 16, bool)
        seen[(twice & low).astype(np.int64)] = True
        maybe = np.flatnonzero(seen[(key & low).astype(np.int64)])
        at = np.minimum(np.searchsorted(twice, key[maybe]), len(twice) - 1)
        return maybe[twice[at] == key[maybe]]


def sequences(words: list[str]) -> Sequences:
    """Sequences of four characters, in order, with gaps, of the words between a mark at either end."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    chars = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    chars = np.where(chars > 0xFFFF, chars % np.uint64(65521), chars)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    shift = [np.uint64(16 * i) for i in range(4)]
    codes, weights, owners = [], [], []
    for a, b, c in GAPS:
        size = len(chars) - c
        if size <= 0:
            continue
        ok = np.flatnonzero(word[:size] == word[c:])
        four = (chars[ok] << shift[3]) | (chars[ok + a] << shift[2]) | (chars[ok + b] << shift[1]) | chars[ok + c]
        codes.append(four)
        weights.append(np.full(len(ok), DECAY ** (c + 1)))
        owners.append(word[ok])
    if not codes:
        none = np.zeros(0, np.int64)
        return Sequences(none.astype(np.uint64), none.astype(float), none, len(words))
    return Sequences(np.concatenate(codes), np.concatenate(weights), np.concatenate(owners), len(words))


def cell_of(code: np.ndarray) -> np.ndarray:
    return (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


class Table:
    """Places of sorted sequences by cells of a hash; only those that share a cell are searched for."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        cells = cell_of(codes)
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[cells] = np.where(np.bincount(cells, minlength=1 << BITS)[cells] > 1, -2, np.arange(len(codes)))

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in code, places in the table) of the sequences it holds."""
        if not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self.place[cell_of(code)]
        maybe = np.flatnonzero(at != -1)
        at = at[maybe].astype(np.int64)
        shared = np.flatnonzero(at == -2)
        at[shared] = np.minimum(np.searchsorted(self.codes, code[maybe[shared]]), len(self.codes) - 1)
        hit = self.codes[at] == code[maybe]
        return maybe[hit], at[hit]


def kernel(words: list[str], landmarks: list[str], step: int = 100) -> np.ndarray:
    """Normalised kernel of words with landmarks."""
    base = sequences(landmarks)
    codes, place = np.unique(base.code, return_inverse=True)
    table = Table(codes)
    values = np.zeros((len(codes), len(landmarks)), np.float32)
    np.add.at(values, (place, base.word), base.weight)
    values /= np.maximum(base.norms(), 1e-9)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for i in range(0, len(words), step):
        t = sequences(words[i : i + step])
        here, there = table.find(t.code)
        order = np.argsort(t.word[here], kind="stable")
        here, there = here[order], there[order]
        if len(here):
            first = np.flatnonzero(np.diff(t.word[here], prepend=-1))
            rows = np.add.reduceat(values[there] * t.weight[here, None].astype(np.float32), first, axis=0)
            out[i + t.word[here[first]]] = rows
        out[i : i + t.n] /= np.maximum(t.norms(), 1e-9)[:, None]
    return out


@dataclass
class Model:
    codes: np.ndarray  # sorted sequences
    weights: np.ndarray
    bias: float
    slopes: np.ndarray  # of a text's features
    known: bool = True

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word."""
        if not words:
            return np.zeros(0)
        t = sequences(words)
        here, there = self.table().find(t.code)
        total = np.bincount(t.word[here], t.weight[here] * self.weights[there], t.n)
        # sums of squares cannot exceed the norm's square: below the line no word needs its norm
        low = t.least_norms()
        need = (total / np.maximum(low, 1e-9) + self.bias > -1) & (low > 0)
        out = np.full(t.n, -1.0)
        if need.any():
            own = need[t.word]
            norms = Sequences(t.code[own], t.weight[own], t.word[own], t.n).norms()
            out[need] = np.maximum(total[need] / norms[need] + self.bias, -1.0)
        return out

    def table(self) -> Table:
        if not hasattr(self, "_table"):
            self._table = Table(self.codes)
        return self._table

    def scorer(self) -> Scorer:
        if not hasattr(self, "_scorer"):
            self._scorer = Scorer(self)
        return self._scorer

    def probability(self, worst: np.ndarray) -> np.ndarray:
        """From rows of `features`."""
        if not self.known:
            return np.zeros(len(worst))
        return 1 / (1 + np.exp(-np.clip(worst @ self.slopes, -30, 30)))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear machine by Newton steps on the rows within the margin; the last column is the bias."""
    width = x.shape[1] + 1
    w, inside = np.zeros(width), np.ones(len(x), bool)
    for _ in range(30):
        square, target = np.diag(np.append(np.full(width - 1, ridge), 1e-6)), np.zeros(width)
        for i in range(0, len(x), 1000):
            own = np.flatnonzero(inside[i : i + 1000]) + i
            part = np.hstack([x[own], np.ones((len(own), 1))]).astype(np.float64)
            scaled = part * weight[own, None]
            square += part.T @ scaled
            target += scaled.T @ y[own]
        w = np.linalg.solve(square, target)
        now = y * (x @ w[:-1] + w[-1]) < 1
        if (now == inside).all():
            break
        inside = now
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        v = weight * p * (1 - p)
        step = np.linalg.solve(x.T @ (x * v[:, None]) + 1e-2 * np.eye(len(w)), x.T @ (weight * (p - y)) + 1e-2 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def features(scores: Iterable[float]) -> tuple[float, ...]:
    """The largest of word scores up to the margin and up to TOP, the means of the three largest so
    bounded (-1 where there are fewer), one."""
    top = ([min(s, TOP) for s in heapq.nlargest(3, scores)] + [-1.0] * 3)[:3]
    sure = [min(s, MARGIN) for s in top]
    return sure[0], top[0], sum(sure) / 3, sum(top) / 3, 1.0


def worst_word(words: list[str], scores: list[float]) -> str | None:
    """The word of the highest score, None where no word has one; ties by the word, so that runs agree."""
    top = max(scores, default=-1.0)
    return max(w for w, s in zip(words, scores, strict=True) if s == top) if top > -1 else None


def slipped(word: str, random: np.random.Generator) -> str:
    """The word with one character slipped in."""
    at = int(random.integers(1, max(2, len(word))))
    return word[:at] + chr(int(random.integers(97, 123))) + word[at:]


def all_units(text: str) -> set[str]:
    return {u for w in words_of(text) for u in units(w)}


def worst_of(model: Model, texts: Iterable[set[str]]) -> np.ndarray:
    """A row of features for each text, given as its set of units."""
    texts = list(texts)
    every = sorted(set().union(*texts)) if texts else []
    scores: dict[str, float] = {}
    for i in range(0, len(every), STEP):
        part = every[i : i + STEP]
        scores.update(zip(part, model.word_scores(part).tolist(), strict=True))
    return np.array([features(scores[u] for u in t) for t in texts])


@dataclass
class Corpus:
    """Labelled texts as numbers, which take little room on the driver."""

    units: list[str]
    of: np.ndarray  # (raw word, 2): its units, -1 for none
    texts: list[np.ndarray]  # distinct raw words of each text
    after: list[np.ndarray]  # by label, of texts not kept back: distinct (unit, raw word before it)

    @staticmethod
    def read(texts: list[str], labels: list[int], kept_back: np.ndarray) -> Corpus:
        raw: dict[str, int] = {}
        numbers: dict[str, int] = {}
        of, rows = [], []
        pairs: list[list[np.ndarray]] = [[], []]

        def number(word: str) -> int:
            if word not in raw:
                raw[word] = len(of)
                own = [numbers.setdefault(u, len(numbers)) for u in units(word)]
                of.append((own + [-1, -1])[:2])
            return raw[word]

        number("")
        for text, label, back in zip(texts, labels, kept_back, strict=True):
            row = np.array([number(w) for w in text.lower().split()], np.int64)
            if not back:
                pairs[label].append(np.unique(row << 32 | np.append(0, row[:-1])))
            more = [number(w) for w in words_of(text) if w not in raw]
            rows.append(np.unique(np.append(row, more)).astype(np.int32))
        table = np.array(of, np.int64).reshape(-1, 2)
        after = []
        for own in pairs:
            pair = np.concatenate([np.zeros(0, np.int64), *own])
            unit = table[pair >> 32]
            before = (pair & 0xFFFFFFFF)[:, None]
            after.append(np.unique(((unit << 32) | before)[unit >= 0]) >> 32)
        return Corpus(list(numbers), table, rows, after)

    def features(self, model: Model, which: np.ndarray) -> np.ndarray:
        scores = np.concatenate(
            [model.word_scores(self.units[i : i + STEP]) for i in range(0, len(self.units), STEP)] + [[-1.0]]
        )
        raw = scores[self.of].max(1)
        return np.array([features(raw[self.texts[i]].tolist()) for i in which]).reshape(-1, FEATURES)


def train(texts: list[str], labels: list[int], clean_weight: float = 1.0, seed: int = 7) -> Model:
    """Machine from labelled texts. clean_weight: texts of label 0 that one of them stands for; scores
    stand half way between even shares of both labels and these."""
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -1.0, np.zeros(FEATURES), known=False)
    if len(set(labels)) < 2:
        return nothing
    random = np.random.default_rng(seed)
    kept_back = np.arange(len(texts)) % 4 == 3
    corpus = Corpus.read(texts, labels, kept_back)
    clean, toxic = (np.bincount(a, minlength=len(corpus.units)) for a in corpus.after)
    n_clean, n_toxic = (max(1, int(x.sum())) for x in (clean, toxic))
    odds = np.log((toxic + 0.5) / n_toxic) - np.log((clean + 0.5) / n_clean)
    witness = np.flatnonzero((toxic >= MIN_SEEN) & (odds > MIN_ODDS))
    if not len(witness):
        return nothing
    name = corpus.units.__getitem__
    positive = sorted(witness.tolist(), key=lambda i: (-toxic[i], name(i)))
    others = np.setdiff1d(np.flatnonzero(clean), witness)
    others = np.array(sorted(others.tolist(), key=name), np.int64)
    random.shuffle(others)
    negative = others[:NEGATIVES].tolist()
    landmarks = [name(i) for i in positive[:LANDMARKS] + negative[:LANDMARKS]]
    known = {name(i) for i in others}
    varied = [w for i in positive for w in (slipped(name(i), random) for _ in range(2)) if w not in known]
    model = nothing
    for again in range(ROUNDS + 1):
        inner = kernel(landmarks, landmarks).astype(np.float64)
        value, vector = np.linalg.eigh(inner)
        keep = value > 1e-6
        root = vector[:, keep] / np.sqrt(value[keep])
        words = [name(i) for i in positive] + varied + [name(i) for i in negative]
        y = np.array([1.0] * (len(positive) + len(varied)) + [-1.0] * len(negative))
        counts = np.concatenate([toxic[positive], np.ones(len(varied)), clean[negative]])
        weight = np.sqrt(counts)
        weight[y > 0] *= weight[y < 0].sum() / weight[y > 0].sum()
        w = squared_hinge(kernel(words, landmarks) @ root.astype(np.float32), y, weight / weight.sum() * 100, RIDGE)
        beta = root @ w[:-1]
        base = sequences(landmarks)
        codes, place = np.unique(base.code, return_inverse=True)
        share = base.weight * (beta / np.maximum(base.norms(), 1e-9))[base.word]
        model = Model(codes, np.bincount(place, share, len(codes)), float(w[-1]), np.zeros(FEATURES))
        if again == ROUNDS:
            break
        scores = np.concatenate(
            [model.word_scores([name(j) for j in others[i : i + STEP]]) for i in range(0, len(others), STEP)]
        )
        hard = [int(others[i]) for i in np.argsort(-scores, kind="stable")[:1000] if scores[i] > -0.5]
        chosen, held = set(negative), set(landmarks)
        negative = negative + [h for h in hard if h not in chosen]
        landmarks = landmarks + [name(h) for h in hard if name(h) not in held][:LANDMARKS]
    back = np.flatnonzero(kept_back)
    if len({labels[i] for i in back}) < 2:
        back = np.arange(len(texts))
    y = np.array([labels[i] for i in back], float)
    model.slopes = logistic(corpus.features(model, back), y, np.where(y > 0, 1.0, clean_weight**0.5))
    return model


def fit(docs: DataFrame, per_label: int = SAMPLE) -> Model:
    """Machine from documents with a column toxic (0, 1; others are not learned from)."""
    labelled = docs.where("toxic in (0, 1) and text is not null")
    counts = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    chosen = F.lit(False)
    for label, n in counts.items():
        chosen = chosen | ((F.col("toxic") == label) & (place < F.lit(min(1 << 40, (per_label << 40) // n))))
    rows = labelled.where(chosen).select("doc_id", "toxic", "text").collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    taken = Counter(r["toxic"] for r in rows)
    ratio = lambda x: counts.get(x, 0) / max(1, taken[x])
    return train([r["text"] for r in rows], [r["toxic"] for r in rows], ratio(0) / max(ratio(1), 1e-9))


class Recent:
    """Values of keys seen lately: two generations of about CACHE keys."""

    def __init__(self):
        self.now: dict[str, float] = {}
        self.before: dict[str, float] = {}

    def turn(self) -> None:
        if len(self.now) > CACHE:
            self.before, self.now = self.now, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys without a value; all others stand in `now` after this."""
        rest = keys - self.now.keys()
        old = rest & self.before.keys()
        self.now.update((k, self.before[k]) for k in old)
        return list(rest - old)


class Scorer:
    """Values of words by a machine. A worker keeps it over its tasks, so that common words are scored once."""

    def __init__(self, machine: Model):
        self.machine, self.words, self.units = machine, Recent(), Recent()

    def values(self, texts: list[list[str]]) -> list[list[float]]:
        """The value of each word of each text: the largest of its units'."""
        self.words.turn()
        self.units.turn()
        parts = {w: units(w) for w in self.words.missing(set().union(*texts))}
        new = self.units.missing({u for p in parts.values() for u in p})
        known, scored = self.words.now, self.units.now
        for i in range(0, len(new), STEP):
            own = new[i : i + STEP]
            scored.update(zip(own, self.machine.word_scores(own).tolist(), strict=True))
        for w, p in parts.items():
            known[w] = scored[p[0]] if len(p) == 1 else max((scored[u] for u in p), default=-1.0)
        return [list(map(known.__getitem__, t)) for t in texts]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds score (0 to 1) and worst_word, the word that decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("score", "worst_word")]
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), text_bytes().alias("t"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [list(words_of(t.as_py().decode("utf-8", "replace"))) for t in part.column(1)]
                scores = machine.scorer().values(texts)
                values = np.array([features(sorted(s)[-3:]) for s in scores]).reshape(-1, FEATURES)
                worst = [worst_word(t, s) for t, s in zip(texts, scores, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(machine.probability(values), pa.float64()),
                        pa.array(worst, pa.string()),
                    ],
                    names=["row", "score", "worst_word"],
                )

    kind = given.schema["row"].dataType.simpleString()
    found = given.mapInArrow(read, f"row {kind}, score double, worst_word string")
    return found.select("row.*", "score", "worst_word")
