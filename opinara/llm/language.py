"""Language of texts and of their parts.

A model holds, per language, the log probability of the character 1- to 3-grams of words (hashed to a
table of fixed size), and the scripts it is written in. Scripts narrow the candidates: a language that
does not use the scripts of a word's letters cannot label it. Every word gets a score per language, the
summed log probabilities of its grams; the Viterbi path over the words, with a penalty for each change of
language, labels spans. Words without letters say nothing and take the label of their surroundings. A
document's language is the one whose spans hold most letters, its score their share of all letters.

The model is fitted on a bounded sample: per language at most about `SAMPLE` labelled texts, chosen by
the hash of their ids; its table has `TABLE` cells per language, and languages are few. Prediction covers
every whole text.

Defined results: a missing text and one without a letter get `und`, score 0 and no spans; a text with
letters, but none in the script of a learned language, gets the language of its nearest grams, with score 0 and no spans; ties go to the language that sorts first; rows without
language are not learned from; without any labelled text everything is `und`; repeated rows are labelled
alike; extra columns pass through, those named as a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import as_list_array, byte_chunks, collect_arrays, text_bytes, trimmed
from opinara.llm.tokens import SPACE

SAMPLE = 2000
TABLE_BITS = 18
TABLE = 1 << TABLE_BITS
ORDERS = 3
PENALTY = 12.0
SMOOTH = 0.05
SCRIPT_SHARE = 0.01
MIN_SCORE = 0.4
CHUNK = 2 << 20  # bytes of the texts whose paths are found together
PART = 1 << 19
FAR = np.float32(-1e4)

# Blocks of letters by script (Unicode), first and last code point.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
OTHER = len(SCRIPTS) + 1


def script_table() -> np.ndarray:
    """Script number of every code point: 0 for what is no letter, OTHER for letters of no named one."""
    out = np.zeros(0x110000, np.uint8)
    letters = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    out[letters] = OTHER
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            out[a : b + 1][out[a : b + 1] > 0] = number
    return out


_SCRIPT: list[np.ndarray] = []


def scripts() -> np.ndarray:
    if not _SCRIPT:
        _SCRIPT.append(script_table())
    return _SCRIPT[0]


@dataclass
class Text:
    """Characters of a run of texts; text i has words first[i] to first[i + 1]."""

    chars: np.ndarray  # code points, lower case, a newline before each text and after the last
    begins: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def is_space(chars: np.ndarray) -> np.ndarray:
    return np.append(SPACE, False)[np.minimum(chars, 256)]


def lowered(text: str) -> str:
    """Lower case that keeps the number of code points, so that offsets stay those of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def read_texts(texts: list[bytes]) -> Text:
    plain = [lowered(t.decode("utf-8", "replace")) for t in texts]
    chars = np.frombuffer(("\n" + "\n".join(plain) + "\n").encode("utf-32-le", "replace"), np.uint32)
    begins = np.cumsum([1, *(len(t) + 1 for t in plain)])
    change = np.flatnonzero(np.diff(~is_space(chars)))
    starts, ends = change[::2] + 1, change[1::2] + 1
    return Text(chars, begins[:-1], starts, ends, np.searchsorted(starts, begins))


def gram_cells(text: Text) -> Iterator[np.ndarray]:
    """For each order the table cell of the gram that begins at each character.

    A space may be a gram's first or last character; what else holds a space, and what would reach
    beyond the end, gets the cell TABLE, which counts for nothing.
    """
    c = text.chars
    space = is_space(c)
    clean = np.where(space, np.uint32(32), c).astype(np.uint64)
    code = np.zeros(len(c), np.uint64)
    blocked = space.copy()
    for n in range(1, ORDERS + 1):
        size = len(c) - n + 1
        if size <= 0:
            return
        code = (code[:size] + clean[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        if n == 2:
            blocked = space[:size] & space[1:]
        elif n > 2:
            blocked = (space[1 : 1 + size] if n == 3 else blocked[:size]) | space[n - 2 : n - 2 + size]
        cell = np.full(len(c), TABLE, np.int64)
        cell[:size] = np.where(blocked, TABLE, code >> np.uint64(64 - TABLE_BITS))
        yield cell


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (TABLE + 1, languages): log probability of a gram, without the languages' mean
    strange: np.ndarray  # (scripts, languages): letters that the language is not written with


def sample_of(docs: DataFrame, per_language: int) -> tuple[list[str], DataFrame]:
    """The languages, and (lang, t) of labelled texts, about per_language of each at most."""
    labelled = docs.where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    chosen = F.lit(False)
    for lang, n in counts.items():
        bound = F.lit(min(1 << 40, (per_language << 40) // n))
        chosen = chosen | ((F.col("lang") == lang) & (place < bound))
    rows = labelled.where(chosen).select("lang", F.col("text").cast("binary").alias("t"))
    return sorted(counts, key=lambda lang: lang.encode()), rows


def fit(docs: DataFrame, per_language: int = SAMPLE) -> Model:
    """Model from the documents that have a language."""
    langs, sample = sample_of(docs, per_language)

    @trimmed
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for lang in sorted(set(labels)):
                own = batch.column(1).filter(pa.array([x == lang for x in labels]))
                cells = totals.setdefault(lang, np.zeros(TABLE + OTHER + 1, np.int64))
                for _, texts in byte_chunks(own, PART):
                    text = read_texts(texts)
                    for cell in gram_cells(text):
                        cells[:TABLE] += np.bincount(cell, minlength=TABLE + 1)[:TABLE]
                    cells[TABLE:] += np.bincount(scripts()[text.chars], minlength=OTHER + 1)
        for lang, cells in totals.items():
            found = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), langs.index(lang)), pa.int32()),
                    pa.array(found, pa.int64()),
                    pa.array(cells[found]),
                ],
                names=["lang", "cell", "n"],
            )

    counted = sample.mapInArrow(count, "lang int, cell long, n long")
    cells = collect_arrays(counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    counts = np.zeros((TABLE + OTHER + 1, len(langs)))
    counts[cells["cell"], cells["lang"]] = cells["n"]
    grams, letters = counts[:TABLE], counts[TABLE:]
    letters[0] = 0
    table = np.zeros((TABLE + 1, len(langs)), np.float32)
    strange = letters < SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    strange[0] = False
    if langs:
        smooth = grams + SMOOTH
        table[:TABLE] = np.log(smooth / smooth.sum(0))
        # what no language has seen is no evidence, and only differences between languages are
        table[:TABLE][grams.sum(1) == 0] = 0
        table -= table.mean(1, keepdims=True)
    return Model(langs, table, strange)


def word_scores(text: Text, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(scores per word and language, FAR where a script rules the language out; letters of each word;
    the same where some language is possible, else 0; the language of the best grams, whatever the script)."""
    n, width = len(text.starts), len(model.langs)
    # a gram counts for the word of its first character, or of its second after a space
    sums = np.zeros((len(text.chars), width), np.float32)
    for cell in gram_cells(text):
        sums += model.table[cell]
    scores = np.add.reduceat(sums, text.starts - 1, axis=0)
    script = scripts()[text.chars]
    letters = np.add.reduceat(script > 0, text.starts, dtype=np.int64)
    strange = np.add.reduceat(model.strange[script], text.starts, axis=0, dtype=np.int64) > 0
    possible = ~strange.all(1) & (letters > 0)
    nearest = scores.argmax(1)
    scores[strange] = FAR
    scores[~possible] = 0
    return scores, letters, np.where(possible, letters, 0), nearest


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word, all texts at once: step t takes word t of every text that has one."""
    n, width = scores.shape
    state_type = np.min_scalar_type(max(width - 1, 0))
    came = np.zeros((n, width), state_type)
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = first[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    best = np.zeros((len(lengths), width), np.float32)
    stay = np.arange(width, dtype=state_type)
    for t in range(longest):
        k = active[t]
        at = begins[:k] + t
        if t:
            past = best[:k]
            top = past.argmax(1)
            value = past[np.arange(k), top] - penalty
            switch = value[:, None] > past
            came[at] = np.where(switch, top[:, None].astype(state_type), stay)
            best[:k] = np.where(switch, value[:, None], past) + scores[at]
        else:
            best[:k] = scores[at]
    path = np.zeros(n, state_type)
    state = np.zeros(len(lengths), np.int64)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        ending = lengths[:k] == t + 1
        state[:k][ending] = best[:k][ending].argmax(1)
        at = begins[:k] + t
        path[at] = state[:k]
        state[:k] = came[at, state[:k]]
    return path


def scored_words(texts: list[bytes], model: Model):
    """Of all words: scores, letters, letters if any language is possible, nearest language, start and end in their text;
    and the first word of each text. Read in parts, so that arrays over characters stay small."""
    columns, first = [], [np.zeros(1, np.int64)]
    for _, part in byte_chunks(texts, PART):
        text = read_texts(part)
        first.append(first[-1][-1] + text.first[1:])
        if len(text.starts):
            begins = np.repeat(text.begins, np.diff(text.first))
            # a text holds less than 2^31 characters
            places = (text.starts - begins, text.ends - begins)
            scores, *numbers = word_scores(text, model)
            columns.append((scores, *(x.astype(np.int32) for x in (*numbers, *places))))
    if not columns:
        return None
    return *(np.concatenate(x) for x in zip(*columns, strict=True)), np.concatenate(first)


def label(texts: list[bytes], model: Model, penalty: float):
    """(language index or -1, score, span starts, span ends, span languages, spans' first) of texts.

    A text with letters, none of them in the script of a known language, gets the language of its words' best grams
    by number of letters, with score 0 and no spans.
    """
    rows = len(texts)
    found = scored_words(texts, model) if model.langs else None
    if found is None:
        none = np.zeros(0, np.int64)
        return np.full(rows, -1), np.zeros(rows), none, none, none, np.zeros(rows + 1, np.int64)
    scores, letters, known, nearest, starts, ends, first = found
    path = viterbi(scores, first, penalty).astype(np.int64)
    width = len(model.langs)
    row = np.repeat(np.arange(rows), np.diff(first))
    share = np.bincount(row * width + path, known, rows * width).reshape(rows, width)
    total = np.bincount(row, letters, rows)
    foreign = np.bincount(row * width + nearest, letters, rows * width).reshape(rows, width)
    fallback = np.where(total > 0, foreign.argmax(1), -1)
    lang = np.where(share.max(1) > 0, share.argmax(1), fallback)
    score = share.max(1) / np.maximum(total, 1)
    new = np.append(True, (np.diff(path) != 0) | (np.diff(row) != 0))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(path)) - 1
    shown = score[row[begin]] > 0
    begin, end = begin[shown], end[shown]
    counts = np.bincount(row[begin], minlength=rows)
    return lang, score, starts[begin], ends[end], path[begin], np.append(0, np.cumsum(counts))


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """Adds lang_pred, score and spans, an array of (start, end, lang) with offsets in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ("lang_pred", "score", "spans")
    rest = [c for c in docs.columns if c not in added]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")
    given = docs.select(row, text_bytes().alias("t"))

    @trimmed
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.langs, "und"], object)
        for batch in batches:
            # texts of like length together, as the path is found for all of a chunk step by step
            order = np.argsort(-np.array(pc.binary_length(batch.column(1)).to_numpy(False)), kind="stable")
            rows, given = batch.column(0), batch.column(1)
            for first, texts in byte_chunks((given[i] for i in order.tolist()), CHUNK):
                lang, score, start, end, of, bounds = label(texts, shared.value, penalty)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.take(pa.array(order[first : first + len(texts)])),
                        pa.array(names[lang], pa.string()),
                        pa.array(score, pa.float64()),
                        as_list_array(start, bounds, pa.int64()),
                        as_list_array(end, bounds, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(names[of], pa.string())
                        ),
                    ],
                    names=["row", "lang_pred", "score", "start", "end", "lang"],
                )

    kind = given.schema["row"].dataType.simpleString()
    found = given.mapInArrow(
        read,
        f"row {kind}, lang_pred string, score double, start array<bigint>, end array<bigint>, lang array<string>",
    )
    return found.select("row.*", "lang_pred", "score", F.arrays_zip("start", "end", "lang").alias("spans"))


def language_stage(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Pipeline form: same columns. Documents without a language, or whose language holds less than
    min_score of their letters, go; a missing `lang` is filled in."""
    found = identify(docs, fit(docs)).where((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)
