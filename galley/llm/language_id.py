"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's words are its runs of letters, lower-cased. The byte 3-, 4- and 5-grams of a word between
``<`` and ``>`` are hashed into buckets, each with an embedding; the embeddings of all subwords of a
text are averaged and a linear softmax gives the language. Embeddings and weights are trained by
stochastic gradient descent in numpy on the driver, from a sample of ``sample_rows`` texts of at most
``sampling.LONGEST_SAMPLED`` bytes, cut into snippets so that short texts are learnt too. A fifth of
the sampled texts is kept back: it calibrates the temperature of the softmax and the score below which
a text is rejected.

As the average and the softmax's input are linear, the model is one row of numbers a bucket. A task
adds up the rows of a word once, and scores whole texts by adding up their words.

Texts that are null or have no letter get ``und`` and score 0, with ``reject=True`` also those below
the calibrated score. With no labelled row every text is ``und``. Ties go to the alphabetically first
language. Repeated rows are scored each on its own, other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import slices
from galley.llm.sampling import LONGEST_SAMPLED, held_out, sampled

UNKNOWN = "und"
BUCKETS = 1 << 16
SIZES = (3, 4, 5)
SNIPPET_WORDS = 20
SNIPPETS_PER_TEXT = 8
REMEMBERED = 200_000
_WORDS = regex.compile(r"\p{L}+").findall


def letters(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, and the number of the word of each."""
    parts = [f"<{word}>".encode() for word in words]
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(parts)), sizes)
    rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes of the word from here on
    buckets, owners = [], []
    for size in SIZES:
        at = np.flatnonzero(rest >= size)
        value = np.full(len(at), size, np.uint64)
        for step in range(size):
            value = (value + data[at + step]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(31)
        buckets.append((value % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[at])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class LanguageModel:
    languages: list[str]
    rows: np.ndarray  #: per bucket, its share of the softmax's input for each language
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def scores(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities from summed rows and numbers of subwords."""
        logits = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        raised = np.exp(logits - logits.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], dimensions: int = 16, epochs: int = 4, rate: float = 0.5, seed: int = 7) -> LanguageModel:
    """Fit by stochastic gradient descent on snippets; calibrate on every fifth text."""
    languages = sorted(set(labels))
    number = {lang: i for i, lang in enumerate(languages)}
    words = [letters(t) for t in texts]
    known = [i for i, found in enumerate(words) if found]
    fit, kept = [i for i in known if i % 5], [i for i in known if i % 5 == 0]
    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.1, (BUCKETS, dimensions))
    weights, bias = np.zeros((dimensions, len(languages))), np.zeros(len(languages))
    snippets = []
    for i in fit:  # snippets from all over the text
        starts = np.arange(0, len(words[i]), SNIPPET_WORDS)
        chosen = rng.choice(starts, min(len(starts), SNIPPETS_PER_TEXT), replace=False)
        snippets += [(words[i][a : a + SNIPPET_WORDS], number[labels[i]]) for a in sorted(chosen.tolist())]
    samples = [(subwords(found)[0], label) for found, label in snippets]
    for epoch in range(epochs):
        order = rng.permutation(len(samples))
        step = rate * (1 - epoch / epochs)
        for chosen in np.array_split(order, max(1, len(order) // 32)):
            buckets = [samples[i][0] for i in chosen]
            owner = np.repeat(np.arange(len(chosen)), [len(b) for b in buckets])
            joined = np.concatenate(buckets) if len(buckets) else np.empty(0, np.int64)
            if not len(joined):
                continue
            share = 1.0 / np.bincount(owner, minlength=len(chosen))[owner]
            mean = np.zeros((len(chosen), dimensions))
            gathered = embeddings[joined] * share[:, None]
            np.add.at(mean, owner, gathered)
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(chosen)), [samples[i][1] for i in chosen]] -= 1
            back = error @ weights.T
            weights -= step * mean.T @ error / len(chosen) * 4
            bias -= step * error.mean(axis=0)
            np.add.at(embeddings, joined, -step * 4 * back[owner] * share[:, None])
    model = LanguageModel(languages, embeddings @ weights, bias)
    if kept:
        logits = np.array([model.rows[subwords(words[i])[0]].mean(axis=0) + bias for i in kept])
        truth = np.array([number[labels[i]] for i in kept])
        pick = np.arange(len(kept))
        grid = [0.25, 0.5, 1.0, 2.0, 4.0]
        model.temperature = min(grid, key=lambda t: -np.log(_softmax(logits / t)[pick, truth] + 1e-12).mean())
        found = _softmax(logits / model.temperature)
        right = found.max(axis=1)[found.argmax(axis=1) == truth]
        model.reject_below = float(np.quantile(right, 0.01)) if len(right) else 0.0
    return model


def fit(docs: DataFrame, sample_rows: int = 3000, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from rows that are not held out and have a language; ``sample_rows`` bounds what is collected."""
    labelled = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id")
    )
    rows = sampled(labelled, sample_rows, "id", "language").where(F.octet_length("text") <= LONGEST_SAMPLED).collect()
    rows.sort(key=lambda r: (r.id is None, r.id or 0, r.text))
    return train([r.text for r in rows], [r.lang for r in rows]) if rows else LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))


def predict(docs: DataFrame, model: LanguageModel, reject: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, held_out, lang_pred, score)``, one per row of ``docs``."""
    frame = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(f"`{text}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of one number a language

    def run(batches):
        model, number = sent.value, {}
        width = len(model.languages)
        table, counts = np.zeros((0, width)), np.zeros(0)
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in slices(batches, "text"):
            if len(number) > REMEMBERED:
                number, table, counts = {}, np.zeros((0, width)), np.zeros(0)
            words = [letters(t) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(found) for found in words], np.int64)
            joined = [word for found in words for word in found]
            if new := [w for w in dict.fromkeys(joined) if w not in number]:
                number.update(zip(new, range(len(number), len(number) + len(new))))
                buckets, owner = subwords(new)
                added = np.stack([np.bincount(owner, model.rows[buckets, k], len(new)) for k in range(width)], 1) if width else np.zeros((len(new), 0))
                table = np.concatenate([table, added])
                counts = np.concatenate([counts, np.bincount(owner, minlength=len(new))])
            numbers = np.fromiter(map(number.__getitem__, joined), np.int64, len(joined))
            row = np.repeat(np.arange(len(words)), sizes)
            best, score = np.full(len(words), width), np.zeros(len(words))
            if width:
                sums = np.stack([np.bincount(row, table[numbers, k], len(words)) for k in range(width)], 1)
                found = model.scores(sums, np.bincount(row, counts[numbers], len(words)))
                seen = sizes > 0
                best[seen], score[seen] = found.argmax(axis=1)[seen], found.max(axis=1)[seen]
                if reject:
                    best[score < model.reject_below] = width
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return frame.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
