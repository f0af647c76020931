"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions, labels every
byte with a distribution over languages, and a document's distribution is the
mean over all its bytes; nothing is cut off. Weights are learned in numpy by
backpropagation through time from a bounded sample of labelled rows: at most
``PER_LANGUAGE`` documents of each language, those with the smallest hash of
their id, and of each at most ``SAMPLE_CHARS`` characters at a place that the
hash picks. Rows with crc32(id as text) mod 4 = 2 are held out and never learned
from. Predictions look at the text alone.

A null text and a text without a letter is ``und`` with score 0; so is every
text if no row is labelled. Letters are those of Unicode's category L: not digits,
number forms such as Ⅷ, fractions or circled numbers. A null id counts as the text of no characters for the
hold-out rule. Every row gives a row, repeats included; an empty table gives an
empty result; other columns are never looked at. The sample is ordered, so equal
tables give equal weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.common import table, text_or_empty

WINDOW = 128
HIDDEN = 8
PER_LANGUAGE = 160
SAMPLE_CHARS = 1024
STEPS = 240
BATCH = 192
RATE = 0.02
#: Windows read at once.
ROWS = 4096
#: Documents whose best language has less than this share are rejected by the pipeline.
MIN_SCORE = 0.3

LETTER = regex.compile(r"\p{L}")


def windows(data: bytes, width: int = WINDOW) -> np.ndarray:
    """``data`` in rows of ``width`` bytes, the last one filled with zeros."""
    rows = -(-len(data) // width)
    filled = np.zeros(rows * width, np.uint8)
    filled[: len(data)] = np.frombuffer(data, np.uint8)
    return filled.reshape(rows, width)


@dataclass
class Network:
    """Per direction: inputs (3H, 256), recurrent (3H, H); then output (L, 2H) and bias (L,).

    Gates are update, reset and candidate. Gates use the piecewise linear
    sigmoid, the candidate x / (1 + |x|).
    """

    languages: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)
        return Network(
            languages,
            [draw.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32) for _ in range(2)],
            [draw.normal(0, 0.3, (3 * hidden, hidden)).astype(np.float32) for _ in range(2)],
            draw.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias]

    def read(self, columns: np.ndarray, way: int, tape: list | None = None) -> np.ndarray:
        """States (T, N, H) after each byte of ``columns`` (T, N), read forwards (0) or backwards (1)."""
        hidden, (steps, n) = self.recurrent[way].shape[1], columns.shape
        update_in, reset_in, new_in = (np.ascontiguousarray(w.T) for w in np.split(self.inputs[way], 3))
        update_own, reset_own, new_own = (np.ascontiguousarray(w.T) for w in np.split(self.recurrent[way], 3))
        states = np.empty((steps, n, hidden), np.float32)
        state = np.zeros((n, hidden), np.float32)
        update, reset, new, raw, carried = (np.empty((n, hidden), np.float32) for _ in range(5))
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            for gate, fed, own in ((update, update_in, update_own), (reset, reset_in, reset_own)):
                np.take(fed, columns[t], axis=0, out=gate, mode="clip")
                gate += np.matmul(state, own, out=carried)
                gate *= 0.25
                gate += 0.5
                np.clip(gate, 0, 1, out=gate)
            np.matmul(state, new_own, out=raw)
            if tape is not None:
                tape.append((t, state.T, np.concatenate([update, reset], 1).T, raw.T.copy()))
            np.take(new_in, columns[t], axis=0, out=new, mode="clip")
            raw *= reset
            raw += new
            np.abs(raw, out=new)
            new += 1
            raw /= new
            raw -= state
            raw *= update
            state = np.add(state, raw, out=states[t])
        return states

    def label(self, columns: np.ndarray) -> np.ndarray:
        """Language probabilities (T, L, N) of every byte of ``columns`` (T, N)."""
        hidden = self.recurrent[0].shape[1]
        scores = np.matmul(self.output[:, :hidden], self.read(columns, 0).transpose(0, 2, 1))
        scores += np.matmul(self.output[:, hidden:], self.read(columns, 1).transpose(0, 2, 1))
        scores += self.bias[:, None]
        scores -= scores.max(1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(1, keepdims=True)
        return scores


def gradients(net: Network, columns: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients of all weights, by backpropagation through time; padding bytes do not count."""
    tapes: list[list] = [[], []]
    both = [net.read(columns, way, tapes[way]) for way in (0, 1)]
    hidden, (steps, n) = net.recurrent[0].shape[1], columns.shape
    joined = np.concatenate(both, 2).transpose(0, 2, 1)
    scores = np.matmul(net.output, joined) + net.bias[:, None]
    scores -= scores.max(1, keepdims=True)
    prob = np.exp(scores)
    prob /= prob.sum(1, keepdims=True)
    counted = (columns > 0).astype(np.float32)
    total = max(1.0, float(counted.sum()))
    loss = -float((np.log(prob[:, truth, np.arange(n)] + 1e-9) * counted).sum()) / total
    prob[:, truth, np.arange(n)] -= 1
    error = prob * (counted / total)[:, None, :]
    d_output = np.einsum("tln,thn->lh", error, joined)
    d_joined = np.matmul(net.output.T, error)
    d_inputs, d_recurrent = [], []
    for way in (0, 1):
        d_in, d_rec = np.zeros((256, 3 * hidden), np.float32), np.zeros_like(net.recurrent[way])
        d_state = np.zeros((hidden, n), np.float32)
        for t, before, gates, raw in reversed(tapes[way]):
            d_state = d_state + d_joined[t, way * hidden : (way + 1) * hidden]
            update, reset = gates[:hidden], gates[hidden:]
            fed = net.inputs[way][2 * hidden :, columns[t]]
            sharp = 1 + np.abs(fed + reset * raw)
            candidate = (fed + reset * raw) / sharp
            d_candidate = d_state * update / sharp**2
            d_update = d_state * (candidate - before)
            d_reset = d_candidate * raw
            d_gates = 0.25 * np.concatenate([d_update, d_reset]) * ((gates > 0) & (gates < 1))
            d_raw = np.concatenate([d_gates, d_candidate * reset])
            d_rec += d_raw @ before.T
            np.add.at(d_in, columns[t], np.concatenate([d_gates, d_candidate]).T)
            d_state = d_state * (1 - update) + net.recurrent[way].T @ d_raw
        d_inputs.append(d_in.T)
        d_recurrent.append(d_rec)
    return loss, [*d_inputs, *d_recurrent, d_output, error.sum((0, 2))]


def train(samples: list[tuple[str, str]], steps: int = STEPS, batch: int = BATCH, seed: int = 7) -> Network | None:
    """Learn from (language, text) pairs; None if there are none."""
    languages = sorted({language for language, _ in samples})
    by_language = [
        np.concatenate([windows(t.encode()) for own, t in samples if own == language]) for language in languages
    ]
    if not languages:
        return None
    net, draw = Network.fresh(languages), np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    share = max(1, batch // len(languages))
    for step in range(1, steps + 1):
        picked = [rows[draw.integers(len(rows), size=share)] for rows in by_language]
        truth = np.repeat(np.arange(len(languages)), share)
        cut = int(draw.integers(WINDOW // 2 + 1))
        _, grads = gradients(net, np.concatenate(picked)[:, cut : cut + WINDOW // 2].T.copy(), truth)
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
        rate = RATE * min(1.0, 3 * (1 - step / (steps + 1)))
        for weight, grad, (first, second) in zip(net.weights(), grads, moments):
            grad = grad / max(1.0, norm)
            first += 0.1 * (grad - first)
            second += 0.005 * (grad**2 - second)
            weight -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.995**step)) + 1e-8)
    return net


def label_positions(net: Network, text: str) -> list[str]:
    """The language of every byte of one text."""
    data = text.encode()
    if not data:
        return []
    best = net.label(windows(data).T.copy()).argmax(1).T.reshape(-1)[: len(data)]
    return [net.languages[i] for i in best]


def pooled(net: Network, texts: list[str]) -> np.ndarray:
    """The mean distribution over the bytes of each text, (texts, L); zeros for an empty one."""
    result = np.zeros((len(texts), len(net.languages)))
    held, owners, count = [], [], 0

    def flush() -> None:
        rows = np.concatenate(held)
        own = np.concatenate(owners)
        for at in range(0, len(rows), ROWS):
            columns = rows[at : at + ROWS].T.copy()
            labels = net.label(columns)
            labels *= (columns > 0)[:, None, :]
            np.add.at(result, own[at : at + ROWS], labels.sum(0, dtype=np.float64).T)

    for i, text in enumerate(texts):
        rows = windows(text.replace("\0", " ").encode())
        held.append(rows)
        owners.append(np.full(len(rows), i))
        count += len(rows)
        if count >= ROWS:
            flush()
            held, owners, count = [], [], 0
    if count:
        flush()
    return result / np.maximum(result.sum(1, keepdims=True), 1e-12)


def held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_sample(docs: DataFrame, id: str, text: str, lang: str) -> list[tuple[str, str]]:
    """At most ``PER_LANGUAGE`` pieces of text per language, in a fixed order."""
    draw = F.xxhash64(F.col("id"))
    room = F.greatest(F.lit(0), F.char_length("text") - SAMPLE_CHARS)
    order = Window.partitionBy("lang").orderBy("draw", "id", F.xxhash64("text"))
    rows = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
        .filter(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.col("text").rlike(r"\p{L}"))
        .select("lang", "id", draw.alias("draw"),
                F.substring(F.col("text"), (F.pmod(draw, room + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= PER_LANGUAGE)
        .select("lang", "place", "text")
    )
    return [(r["lang"], r["text"]) for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["place"]))]


def predictor(net: Network | None):
    """A column function from text to (lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            spoken = [net is not None and bool(LETTER.search(t)) for t in texts]
            names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            if any(spoken):
                known = np.flatnonzero(spoken)
                shares = pooled(net, [texts.iloc[i] for i in known])
                names[known] = np.array(net.languages, object)[shares.argmax(1)]
                scores[known] = np.minimum(shares.max(1), 1.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def predicted(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred and score, learned from ``docs`` itself."""
    predict = predictor(train(training_sample(docs, id, text, lang)))
    rows = docs.select(F.col(id).alias("id"), predict(text_or_empty(F.col(text))).alias("found"))
    return rows.select("id", held_out(F.col("id")).alias("held_out"), "found.lang_pred", "found.score")


def recognised(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", min_score: float = MIN_SCORE
) -> DataFrame:
    """The rows of ``docs`` whose language is found with at least ``min_score``, with all their columns."""
    predict = predictor(train(training_sample(docs, id, text, lang)))
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    rows = rows.withColumn("found", predict(text_or_empty(F.col(f"doc.{text}"))))
    return rows.filter((F.col("found.lang_pred") != "und") & (F.col("found.score") >= min_score)).select("doc.*")


def op8(spark, sf_dir: str) -> DataFrame:
    return predicted(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
