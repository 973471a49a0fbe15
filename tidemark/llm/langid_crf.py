"""Language of words and texts by a linear-chain conditional random field.

A word is a run of letters. Its evidence for each language is a sum of learned weights of
its prefixes, suffixes, byte trigrams and its entry in a learned lexicon; transitions
between languages are learned too. Forward-backward gives each word's distribution over
the languages, also in code-switched text; a text's language is that of the largest share.

Training sequences are spliced from labelled texts of different languages, so that
switches are seen. They come from at most about ``TRAIN_TEXTS`` whole texts of each language.
Training runs on the driver and takes features of the words in its sequences alone.

Inference runs forward-backward for many texts at once: texts are cut into blocks of
``BLOCK`` words, block transfer matrices are chained along each text, and all blocks then
take their steps together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import LETTER, LOWER, Powers, held_out, pieces, words

#: Bound of the learning sample: texts per language.
TRAIN_TEXTS = 250
#: Words of a training sequence and mean words between switches in it.
SEQUENCE, STRETCH = 48, 16
#: Sequences drawn for each language, steps of gradient ascent and their size.
SEQUENCES, STEPS, RATE = 700, 50, 0.15
RIDGE = 1e-3
#: Occurrences in the sample from which a word enters the lexicon.
LEXICON_COUNT = 4

TRIGRAM_BITS, AFFIX_BITS = 15, 13
PREFIXES, SUFFIXES = (1, 2, 3), (1, 2, 3, 4)
BLOCK = 32
UNKNOWN = "und"


class Evidence(NamedTuple):
    """Feature numbers of consecutive words."""

    trigram: np.ndarray
    trigram_word: np.ndarray
    affixes: np.ndarray
    hashes: np.ndarray


def letter_words(data: np.ndarray, offsets: np.ndarray):
    return words(data, offsets, LETTER[data])


def evidence(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> Evidence:
    inside = np.zeros(len(lowered) + 1, np.int32)
    inside[starts] += 1
    word_of = np.cumsum(inside[:-1], dtype=np.int32) - 1
    letter = LETTER[lowered]
    here = np.flatnonzero(letter[:-2] & letter[2:] & (word_of[:-2] == word_of[2:]))
    wide = lowered.astype(np.uint32)
    code = wide[here] | wide[here + 1] << np.uint32(8) | wide[here + 2] << np.uint32(16)
    trigram = (code * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)
    affixes = np.empty((len(starts), len(PREFIXES) + len(SUFFIXES)), np.int32)
    column = 0
    last = max(len(lowered) - 1, 0)
    for from_end, lengths in ((False, PREFIXES), (True, SUFFIXES)):
        code = np.zeros(len(starts), np.uint32)
        for k in range(max(lengths)):
            at = ends - 1 - k if from_end else starts + k
            known = (at >= starts) & (at < ends)
            byte = np.where(known, wide[np.clip(at, 0, last)] + 1, 0).astype(np.uint32)
            code = code * np.uint32(257) + byte
            if k + 1 in lengths:
                place = (code * np.uint32(2654435761)) >> np.uint32(32 - AFFIX_BITS)
                affixes[:, column] = place.astype(np.int32) + (column << AFFIX_BITS)
                column += 1
    hashes = powers.spans(powers.prefix(lowered), starts, ends)
    return Evidence(trigram.astype(np.int64), word_of[here], affixes, hashes)


class Model(NamedTuple):
    languages: list[str]
    trigrams: np.ndarray
    affixes: np.ndarray
    lexicon: np.ndarray
    entries: np.ndarray
    transitions: np.ndarray

    def entry(self, hashes: np.ndarray) -> np.ndarray:
        """Row of ``entries``; the last row stands for words outside the lexicon."""
        if not len(self.lexicon):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def weigh(self, found: Evidence) -> np.ndarray:
        """Evidence of each word for each language."""
        total = self.entries[self.entry(found.hashes)]
        for column in range(found.affixes.shape[1]):
            total = total + self.affixes[found.affixes[:, column]]
        if len(found.trigram):
            at = np.flatnonzero(np.diff(found.trigram_word, prepend=-1))
            sums = np.add.reduceat(self.trigrams[found.trigram], at, axis=0)
            total[found.trigram_word[at]] += sums
        return total


def unit(table: np.ndarray, axes=-1) -> np.ndarray:
    return table / np.maximum(table.sum(axis=axes, keepdims=True), 1e-30)


def marginals(weights: np.ndarray, transitions: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distribution of each word's language; ``rows`` tells the sequences apart, in order."""
    n, k = weights.shape
    if not n:
        return np.zeros((0, k))
    potential = np.exp(weights - weights.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    begins = np.flatnonzero(np.diff(rows, prepend=rows[0] - 1))
    sizes = np.diff(np.append(begins, n))
    blocks = -(-sizes // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(n) - begins[owner]
    block, place = first_block[owner] + within // BLOCK, within % BLOCK
    total = int(blocks.sum())
    there = np.zeros((BLOCK, total), bool)
    there[place, block] = True
    steps = np.ones((BLOCK, total, k))
    steps[place, block] = potential

    transfer = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for j in range(BLOCK):
        live = there[j]
        if not live.any():
            break
        moved = (transfer[live].reshape(-1, k) @ step).reshape(-1, k, k)
        transfer[live] = unit(moved * steps[j, live][:, None, :], (1, 2))

    enter, leave = np.empty((total, k)), np.empty((total, k))
    long_first = np.argsort(-blocks, kind="stable")
    counts = blocks[long_first]
    state = np.full((len(sizes), k), 1 / k)
    for i in range(int(counts[0])):
        live = int(np.searchsorted(-counts, -i, "left"))
        at = first_block[long_first[:live]] + i
        enter[at] = state[:live]
        state[:live] = unit(np.einsum("bi,bij->bj", state[:live], transfer[at]))
    state = np.full((len(sizes), k), 1 / k)
    for i in range(int(counts[0])):
        live = int(np.searchsorted(-counts, -i, "left"))
        own = long_first[:live]
        at = first_block[own] + blocks[own] - 1 - i
        leave[at] = state[:live]
        state[:live] = unit(np.einsum("bij,bj->bi", transfer[at], state[:live]))

    forward = np.empty((BLOCK, total, k))
    state = enter
    for j in range(BLOCK):
        state = np.where(there[j][:, None], unit((state @ step) * steps[j]), state)
        forward[j] = state
    result = np.empty((BLOCK, total, k))
    state = leave
    for j in range(BLOCK - 1, -1, -1):
        result[j] = unit(forward[j] * state)
        state = np.where(there[j][:, None], unit((steps[j] * state) @ step.T), state)
    return result[place, block]


def spliced(labels: np.ndarray, k: int, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and languages of training sequences cut from words of each language."""
    own = [np.flatnonzero(labels == language) for language in range(k)]
    count = SEQUENCES * k
    number = np.empty((count, SEQUENCE), np.int64)
    target = np.empty((count, SEQUENCE), np.int64)
    for row in range(count):
        at = 0
        while at < SEQUENCE:
            length = min(1 + int(draw.geometric(1 / STRETCH)), SEQUENCE - at)
            language = int(draw.integers(k))
            start = int(draw.integers(len(own[language])))
            number[row, at : at + length] = own[language].take(
                range(start, start + length), mode="wrap"
            )
            target[row, at : at + length] = language
            at += length
    return number, target


def slopes(weights: np.ndarray, transitions: np.ndarray, target: np.ndarray):
    """Gradients of the log likelihood of ``target`` by word weights and by transitions."""
    rows, size, k = weights.shape
    potential = np.exp(weights - weights.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    forward = np.empty_like(potential)
    state = np.full((rows, k), 1 / k)
    for t in range(size):
        state = unit((state @ step) * potential[:, t])
        forward[:, t] = state
    known = np.eye(k)[target]
    by_word = np.empty_like(potential)
    by_step = np.zeros((k, k))
    state = np.full((rows, k), 1 / k)
    for t in range(size - 1, -1, -1):
        by_word[:, t] = known[:, t] - unit(forward[:, t] * state)
        ahead = potential[:, t] * state
        before = forward[:, t - 1] if t else np.full((rows, k), 1 / k)
        both = unit(before[:, :, None] * step * ahead[:, None, :], (1, 2))
        if t:
            by_step += known[:, t - 1].T @ known[:, t]
            by_step -= both.sum(axis=0)
        state = unit(ahead @ step.T)
    return by_word, by_step


def chosen(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The bytes of some words one after the other, a space behind each, and their bounds."""
    sizes = ends - starts + 1
    stops = np.cumsum(sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(stops - sizes, sizes)
    text = data[np.minimum(np.repeat(starts, sizes) + place, len(data) - 1)]
    text[stops - 1] = 32
    return text, stops - sizes, stops - 1


def train(texts: list[str], labels: list[str]) -> Model | None:
    """A model of the labelled texts; none where no text has a word."""
    powers = Powers()
    data = [LOWER[np.frombuffer(text.encode(), np.uint8)] for text in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    lowered = np.concatenate(data) if data else np.zeros(0, np.uint8)
    starts, ends, rows = letter_words(lowered, offsets)
    languages = sorted({labels[row] for row in np.unique(rows)})
    if not languages:
        return None
    k = len(languages)
    label = np.array([languages.index(name) if name in languages else -1 for name in labels])[rows]
    bounds = np.searchsorted(starts, offsets)
    hashes = np.empty(len(starts), np.uint64)
    for text, offset, first, last in zip(data, offsets, bounds, bounds[1:]):
        own = slice(first, last)
        sums = powers.prefix(text)
        hashes[own] = powers.spans(sums, starts[own] - offset, ends[own] - offset)
    keys, counts = np.unique(hashes, return_counts=True)
    lexicon = keys[counts >= LEXICON_COUNT]
    model = Model(
        languages,
        np.zeros((1 << TRIGRAM_BITS, k)),
        np.zeros((len(PREFIXES + SUFFIXES) << AFFIX_BITS, k)),
        lexicon,
        np.zeros((len(lexicon) + 1, k)),
        np.zeros((k, k)),
    )
    if k == 1:
        return model
    number, target = spliced(label, k, np.random.default_rng(1))
    used, number = np.unique(number, return_inverse=True)
    number = number.reshape(target.shape)
    found = evidence(*chosen(lowered, starts[used], ends[used]), powers)
    entry = model.entry(found.hashes)
    uses = np.bincount(number.ravel(), minlength=len(used)).astype(float)
    parameters = [model.trigrams, model.affixes, model.entries, model.transitions]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    for turn in range(1, STEPS + 1):
        by_word, by_step = slopes(model.weigh(found)[number], model.transitions, target)
        own = np.stack(
            [np.bincount(number.ravel(), by_word[:, :, j].ravel(), len(used)) for j in range(k)],
            axis=1,
        )

        def gathered(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
            return np.stack([np.bincount(index, values[:, j], size) for j in range(k)], axis=1)

        by_affix = sum(
            gathered(found.affixes[:, c], own, len(model.affixes))
            for c in range(found.affixes.shape[1])
        )
        gradients = [
            gathered(found.trigram, own[found.trigram_word], len(model.trigrams)),
            by_affix,
            gathered(entry, own, len(model.entries)),
            by_step,
        ]
        for parameter, gradient, (mean, square) in zip(parameters, gradients, moments):
            gradient = gradient / uses.sum() * 1000 - RIDGE * parameter
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            rate = RATE / (1 - 0.9**turn) * np.sqrt(1 - 0.99**turn)
            parameter += rate * mean / (np.sqrt(square) + 1e-8)
    return model._replace(
        trigrams=model.trigrams.astype(np.float32), affixes=model.affixes.astype(np.float32)
    )


def label_words(model: Model, data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """Starts, ends and rows of the words and each word's distribution."""
    lowered = LOWER[data]
    starts, ends, rows = letter_words(lowered, offsets)
    if not len(starts):
        return starts, ends, rows, np.zeros((0, len(model.languages)))
    weights = model.weigh(evidence(lowered, starts, ends, powers))
    return starts, ends, rows, marginals(weights, model.transitions, rows)


def has_letter(data: np.ndarray) -> bool:
    """Whether the UTF-8 text has a letter of any script."""
    own = data[LETTER[data]]
    if not len(own):
        return False
    if (own < 128).any():
        return True
    return any(character.isalpha() for character in data.tobytes().decode())


def sample(documents: DataFrame) -> tuple[list[str], list[str]]:
    """Texts and languages to learn from: bounded, drawn by a hash of id and text."""
    fit = documents.where("lang is not null and text <> ''")
    counts = {row["lang"]: row["count"] for row in fit.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    shares = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, TRAIN_TEXTS / n))]
    )
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20))
    drawn = fit.where(place < shares[F.col("lang")] * (1 << 20))
    rows = drawn.select("text", "lang").collect()
    rows.sort()
    return [row["text"] for row in rows], [row["lang"] for row in rows]


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, n_words long"


def languages(documents: DataFrame, modulus: int = 4) -> DataFrame:
    """The language of every whole text.

    Learned from the ``text`` and ``lang`` of rows that are not held out; predictions read
    the text alone. ``lang_pred`` is ``und`` with score 0 where the text is null or has no
    letter, or where nothing could be learned. The score is the mean probability of the
    predicted language over the words; equal shares go to the first language by name.
    Every row gives a row, repeated ones too. Only ``doc_id``, ``text`` and ``lang`` are
    read.

    Columns: ``doc_id, held_out, lang_pred, score, n_words``.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id").cast("long"), modulus).alias("held_out"),
        "text",
        "lang",
    )
    model = train(*sample(rows.where("not held_out")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            names, scores, sizes = [], [], []
            for piece in pieces(batch.column(2)):
                shares = np.zeros((piece.rows, len(model.languages) if model else 1))
                counts = np.zeros(piece.rows, np.int64)
                if model:
                    _, _, owner, table = label_words(model, piece.data, piece.offsets, powers)
                    counts = np.bincount(owner, minlength=piece.rows)
                    for j in range(shares.shape[1]):
                        shares[:, j] = np.bincount(owner, table[:, j], piece.rows)
                shares /= np.maximum(counts, 1)[:, None]
                best = shares.argmax(axis=1)
                for i in range(piece.rows):
                    own = piece.data[piece.offsets[i] : piece.offsets[i + 1]]
                    known = counts[i] > 0 and has_letter(own)
                    names.append(model.languages[best[i]] if known else UNKNOWN)
                    scores.append(min(1.0, float(shares[i, best[i]])) if known else 0.0)
                    sizes.append(int(counts[i]) if known else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(sizes, pa.int64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "n_words"],
            )

    return rows.drop("lang").mapInArrow(run, PREDICTED)


def word_labels(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, words``: the words of every text with language and probability."""
    kind = pa.list_(
        pa.struct([("word", pa.string()), ("lang", pa.string()), ("probability", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            lists: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for piece in pieces(batch.column(1)):
                starts, ends, rows, table = label_words(model, piece.data, piece.offsets, powers)
                for start, end, row, own in zip(starts, ends, rows, table):
                    best = int(own.argmax())
                    word = piece.data[start:end].tobytes().decode(errors="replace")
                    name = model.languages[best]
                    lists[piece.first + row].append(
                        {"word": word, "lang": name, "probability": float(own[best])}
                    )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, kind)], ["doc_id", "words"]
            )

    schema = "doc_id long, words array<struct<word: string, lang: string, probability: double>>"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, schema
    )
