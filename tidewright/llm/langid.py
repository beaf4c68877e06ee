"""Language identification of mixed text.

The script of a word narrows the candidates, hashed letter trigrams score it in
each, and a Viterbi pass over the words, with a penalty for switching, labels
spans. Counting and labelling run in Arrow batches; the counts are summed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.names import column

UNKNOWN = "und"
BUCKETS = 1 << 16
# Letters are scored a chunk at a time, which bounds what a task holds; texts are labelled in groups.
_CHUNK_CHARS = 250_000
_GROUP_CHARS = 2_000_000

# First and last code points of scripts, from Unicode's blocks (fixed values).
SCRIPT_RANGES = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "ethiopic": ((0x1200, 0x139F),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case, the number of its script."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letters).tolist():
        if len(small := chr(i).lower()) == 1:
            lower[i] = ord(small)
    scripts = np.zeros(0x110000, np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for first, last in ranges:
            scripts[first : last + 1] = number
    return letters, lower, scripts


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """A text in pieces of a bounded length, cut at white space where there is any."""
    at = 0
    while len(text) - at > _CHUNK_CHARS:
        cut = text.rfind(" ", at + 1, at + _CHUNK_CHARS)
        cut = at + _CHUNK_CHARS if cut < 0 else cut
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


def _chunks(texts: list[str]) -> Iterator[list[tuple[int, int, str]]]:
    """(number of the text, offset, piece), as many at a time as make a chunk."""
    held, size = [], 0
    for number, text in enumerate(texts):
        for at, piece in _pieces(text):
            held.append((number, at, piece))
            size += len(piece)
            if size >= _CHUNK_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(number of the first text, texts): neighbours in groups of a bounded size, or a text alone."""
    start, held, size = 0, [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= _GROUP_CHARS:
            yield start, held
            start, held, size = start + len(held), [], 0
    if held:
        yield start, held


def _letters(chunk: list[tuple[int, int, str]]):
    """Of a chunk: the trigram of each letter, where words start among the letters, the
    script of each word, and the text, start and end of each word."""
    is_letter, lower, scripts = _tables()
    points = np.frombuffer("\n".join([p for _, _, p in chunk]).encode("utf-32-le", "surrogatepass"), "<u4")
    mask = is_letter[points]
    places = np.flatnonzero(mask)
    small = lower[points[places]].astype(np.uint64)
    first = np.ones(len(places), bool)
    first[1:] = places[1:] != places[:-1] + 1
    last = np.ones(len(places), bool)
    last[:-1] = first[1:]
    before, after = np.roll(small, 1), np.roll(small, -1)
    before[first], after[last] = 0, 0
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (small * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    trigrams = (mixed >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    starts = np.flatnonzero(first)
    lengths = np.array([len(p) for _, _, p in chunk], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    word_start, word_end = places[starts], places[np.flatnonzero(last)] + 1
    piece = np.searchsorted(begins, word_start, "right") - 1
    shift = np.array([at for _, at, _ in chunk], np.int64)[piece] - begins[piece]
    owner = np.array([number for number, _, _ in chunk], np.int64)[piece]
    return trigrams, starts, scripts[points[word_start]], owner, word_start + shift, word_end + shift


@dataclass(frozen=True)
class Model:
    """Log probabilities of trigrams and the scripts in use, by language."""

    languages: tuple[str, ...]
    trigrams: np.ndarray  # buckets x languages
    allowed: np.ndarray  # scripts x languages


def train(df: DataFrame, *, text_column: str = "text", lang_column: str = "lang", least_share: float = 0.01) -> Model:
    """Count trigrams and scripts of all rows whose text and language aren't null.

    What reaches the driver is at most 65,536 trigram buckets and the scripts for each
    language, whatever the size of the table. A script is a language's if it has at least
    ``least_share`` of its letters. An empty table gives a model without languages.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        width = BUCKETS + len(SCRIPT_RANGES) + 1
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, group in _groups(batch.column(1)):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(langs[first:], group):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    own = counts.setdefault(lang, np.zeros(width, np.int64))
                    for chunk in _chunks(texts):
                        trigrams, starts, scripts, _, begin, end = _letters(chunk)
                        own[:BUCKETS] += np.bincount(trigrams, minlength=BUCKETS)
                        own[BUCKETS:] += np.bincount(scripts, end - begin, width - BUCKETS).astype(np.int64)
        for lang, own in counts.items():
            found = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(own[found])],
                ["lang", "feature", "n"],
            )

    rows = df.select(column(lang_column).alias("lang"), column(text_column).alias("text")).dropna()
    sums = rows.mapInArrow(counted, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    numbers = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((BUCKETS + len(SCRIPT_RANGES) + 1, len(languages)))
    if languages:
        table[found["feature"].to_numpy(), found["lang"].map(numbers).to_numpy()] = found["n"].to_numpy()
    counts = table[:BUCKETS] + 0.1
    letters = table[BUCKETS:]
    return Model(
        languages,
        np.log(counts / counts.sum(axis=0)).astype(np.float32),
        letters >= least_share * np.maximum(letters.sum(axis=0), 1),
    )


def _word_scores(model: Model, trigrams: np.ndarray, starts: np.ndarray, scripts: np.ndarray) -> np.ndarray:
    """Log likelihoods of words below that of the best candidate, bounded, by language."""
    if not len(starts):
        return np.zeros((0, len(model.languages)), np.float32)
    scores = np.add.reduceat(model.trigrams[trigrams], starts, axis=0)
    allowed = model.allowed[scripts]
    # A script no language uses tells nothing.
    allowed |= ~allowed.any(axis=1, keepdims=True)
    scores[~allowed] = -np.inf
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, np.float32(-12.0))


def _best_paths(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word on the best path through its text, for all texts in step.

    Texts lie one after the other in ``scores``. A tie stays with the language
    before, or else goes to the first.
    """
    n_words, n_langs = scores.shape
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    # How many texts still have a word at each step.
    active = np.searchsorted(-sizes, -np.arange(steps), "left")
    came_from = np.zeros((n_words, n_langs), np.int8 if n_langs < 128 else np.int32)
    own = np.arange(n_langs, dtype=came_from.dtype)
    value = np.zeros((len(sizes), n_langs), np.float32)
    for step in range(steps):
        n = active[step]
        at, now = begin[:n] + step, value[:n]
        if step:
            best = now.argmax(axis=1)
            switched = np.take_along_axis(now, best[:, None], 1) - np.float32(penalty)
            stays = now >= switched
            came_from[at] = np.where(stays, own, best[:, None].astype(came_from.dtype))
            np.maximum(now, switched, out=now)
        now += scores[at]
    path = np.zeros(n_words, came_from.dtype)
    label = value.argmax(axis=1).astype(came_from.dtype)
    for step in range(steps - 1, -1, -1):
        n = active[step]
        at = begin[:n] + step
        path[at] = label[:n]
        label[:n] = came_from[at, label[:n]]
    return path


def label_texts(model: Model, texts: list[str | None], penalty: float):
    """For each text: language, score, and spans as (start, end, number of the language)."""
    n_langs = len(model.languages)
    parts = []
    for chunk in _chunks([text or "" for text in texts]) if n_langs else ():
        trigrams, starts, scripts, *places = _letters(chunk)
        if len(starts):
            parts.append((_word_scores(model, trigrams, starts, scripts), *places))
    if not parts:
        return [(UNKNOWN, 0.0, []) for _ in texts]
    scores, owner, start, end = (np.concatenate(found) for found in zip(*parts))
    lengths = np.bincount(owner, minlength=len(texts))
    path = _best_paths(scores, lengths, penalty)
    letters = np.bincount(owner * n_langs + path, end - start, len(texts) * n_langs).reshape(len(texts), n_langs)
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    turns = np.ones(len(owner), bool)
    turns[1:] = (owner[1:] != owner[:-1]) | (path[1:] != path[:-1])
    first = np.flatnonzero(turns)
    past = np.append(first[1:], len(owner)) - 1
    spans: list[list] = [[] for _ in texts]
    for number, a, b, label in zip(owner[first].tolist(), start[first].tolist(), end[past].tolist(), path[first].tolist()):
        spans[number].append((a, b, label))
    return [
        (model.languages[best[i]], float(letters[i, best[i]] / total[i]), spans[i]) if total[i] else (UNKNOWN, 0.0, [])
        for i in range(len(texts))
    ]


def identify(
    df: DataFrame, model: Model, *, keep: list[str], text_column: str = "text", penalty: float = 8.0
) -> DataFrame:
    """The columns in ``keep`` with ``lang_pred``, ``score`` and ``spans`` for every row.

    ``spans`` is array<struct<start, end, lang>> in code points, from the first letter of a
    span's first word to the last of its last. ``lang_pred`` has the most letters (ties: the
    first by name), ``score`` is its share of them. A text that is null or has no
    letter, and any text if nothing was learned, is ``und`` with score 0. Words in a
    script that no language uses count alike for all. ``penalty`` is in nats; a
    word tells 12 at most. An empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = df.select(*[column(name) for name in keep]).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            groups = _groups(batch.column(batch.num_columns - 1))
            found = [row for _, group in groups for row in label_texts(learned, group, penalty)]
            made = [
                pa.array([lang for lang, _, _ in found], pa.string()),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array(
                    [[{"start": a, "end": b, "lang": learned.languages[n]} for a, b, n in spans] for _, _, spans in found],
                    pa.list_(span),
                ),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *made], [*batch.schema.names[:-1], "lang_pred", "score", "spans"]
            )

    selected = df.select(*[column(name) for name in keep], column(text_column).alias("_text"))
    out = "lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>"
    return selected.mapInArrow(labelled, f"{schema}, {out}")
