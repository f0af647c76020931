"""Token counts with a public tokenizer, without keeping the tokens.

Arrow functions take the texts in batches of about ``BATCH_BYTES`` and return
only lengths. A long text is split where no token can cross: at a space between
two ASCII letters or digits, which the tokenizer turns into the mark that opens
the next word. The piece after the cut goes without that space, since the
tokenizer puts the same mark before every input. This holds for models that
keep that mark at the front of a piece, which is checked when the model is
loaded; with any other model texts are encoded whole.

A null text counts as empty and has no tokens. Every row gives a row, repeats
included; an empty table gives an empty result; other columns are never looked
at. The model is read once by the driver and travels with the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import table, text_or_empty

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Bytes encoded in one call.
BATCH_BYTES = 1 << 20
#: Texts longer than so many characters are split.
SPLIT_CHARS = 16_384

SAFE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])", re.ASCII)
MARK = "▁"


def splittable(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether a space between two words always starts a piece, and an input starts like a word."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    inner = any(MARK in p.lstrip(MARK) for p in pieces)
    return not inner and model.encode("a b", out_type=str) == model.encode("a", out_type=str) + model.encode("b", out_type=str)


def safe_pieces(text: str, most: int = SPLIT_CHARS) -> list[str]:
    """``text`` in pieces of about ``most`` characters; the spaces at the cuts are left out."""
    pieces, at = [], 0
    while len(text) - at > most:
        cut = SAFE.search(text, at + most)
        if not cut:
            break
        pieces.append(text[at : cut.start()])
        at = cut.end()
    return [*pieces, text[at:]]


def by_bytes(pieces: Iterator[tuple[int, str]], most: int = BATCH_BYTES) -> Iterator[list[tuple[int, str]]]:
    batch, held = [], 0
    for row, piece in pieces:
        batch.append((row, piece))
        held += len(piece) if piece.isascii() else len(piece.encode("utf-8", "surrogatepass"))
        if held >= most:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def token_counter(model_bytes: bytes):
    """A column function from text to its number of tokens."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
        most = SPLIT_CHARS if splittable(model) else 1 << 62
        for texts in batches:
            counts = [0] * len(texts)
            pieces = ((i, p) for i, t in enumerate(texts) for p in safe_pieces(t, most))
            for batch in by_bytes(pieces):
                for (i, _), ids in zip(batch, model.encode([p for _, p in batch], num_threads=1)):
                    counts[i] += len(ids)
            yield pd.Series(counts, dtype="int64")

    return count


def count_tokens(
    docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens and over_limit."""
    with open(model_path, "rb") as file:
        count = token_counter(file.read())
    whole = text_or_empty(F.col(text))
    counted = docs.select(
        F.col(id).alias("id"), F.octet_length(whole).cast("long").alias("n_bytes"), count(whole).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op10(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL)).withColumnRenamed("id", "doc_id")
