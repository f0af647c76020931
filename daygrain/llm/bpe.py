"""Byte-level BPE encoding and decoding by merge replay over a corpus of words.

Every batch of texts is one corpus: the words it adds, each once, are laid end
to end, and an inverted index leads from a pair of neighbouring tokens, known by
the rank of its merge, to the places where it stands. Ranks are replayed in
ascending order; all places of a rank are merged at once, left before right where
they overlap, and only the two pairs around each are looked up anew. Where a merge
opens a pair of equal or lower rank, the rest of the word waits until that rank has
been replayed, so each word sees its merges in the order of a word encoded alone. A
word that is a token by itself is not merged at all.

Words are the matches of the tokenizer's pattern. Since a match always begins at
a space before a visible character, texts are first cut there, and the pattern
runs over the different pieces only. Encoded pieces are remembered up to
``MEMORY`` of them and then forgotten together.

A null text counts as empty and has no ids. Every row gives a row, repeats
included; an empty table gives an empty result; other columns pass through. Ids
are held as little-endian unsigned 32-bit integers in one binary value. The rank
file is read once by the driver and travels with the tasks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import table, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
#: Encoded pieces that a task remembers.
MEMORY = 250_000
#: Characters of text whose new words make one corpus.
CORPUS_CHARS = 4_000_000

#: What may follow letters in a piece without joining them in a match.
COMMON_ENDS = (",", ".")

BEFORE_WORD = re.compile(r" (?=\S)")
#: A space before white space or the end; texts with one are cut by BEFORE_WORD, others at every space.
ODD_SPACE = r" ([\x09-\x0D\x1C-\x20\x{85}\p{Z}]|$)"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Merges:
    """Ranks as arrays: the token of each byte, and the rank of each pair of tokens that merges."""

    NONE = np.iinfo(np.int32).max

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_token = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        pairs = {
            (ranks[token[:i]] << 32) | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self.NONE)


def _every_other(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Drop each place whose left token the kept place before it takes."""
    number = np.arange(len(places))
    opens = np.append(True, following[:-1] != places[1:])
    return places[(number - np.maximum.accumulate(np.where(opens, number, 0))) % 2 == 0]


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """The packed ids of each word, all words merged together in rank order."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    token = merges.byte_token[np.frombuffer(b"".join(words), np.uint8)]
    size, none = len(token), merges.NONE
    ends = np.cumsum(lengths)
    home = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    follows, precedes = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
    follows[ends[lengths > 0] - 1] = -1
    precedes[(ends - lengths)[lengths > 0]] = -1
    alive, pair = np.ones(size, bool), np.full(size, none, np.int32)
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def note(places: np.ndarray) -> None:
        """File places under the rank of the pair that begins there."""
        places = places[pair[places] != none]
        if not len(places):
            return
        found = pair[places]
        order = np.argsort(found, kind="stable")
        places, found = places[order], found[order]
        bounds = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
        for rank, a, b in zip(found[bounds[:-1]].tolist(), bounds, bounds[1:]):
            if rank in index:
                index[rank].append(places[a:b])
            else:
                index[rank] = [places[a:b]]
                heapq.heappush(waiting, rank)

    inner = np.flatnonzero(follows >= 0).astype(np.int32)
    pair[inner] = merges.rank(token[inner], token[inner + 1])
    note(inner)
    while waiting:
        rank = heapq.heappop(waiting)
        filed = index.pop(rank)
        places = filed[0] if len(filed) == 1 else np.concatenate(filed)
        places = np.unique(places[pair[places] == rank])  # the others have gone since
        if not len(places):
            continue
        if len(places) > 1:
            chosen = _every_other(places, follows[places])
            again = home[chosen[1:]] == home[chosen[:-1]]
            if again.any():
                # A merge that opens a pair of this rank or a lower one must be followed up before the next in its word.
                right, after, before = follows[chosen], follows[follows[chosen]], precedes[chosen]
                after = np.where(right >= 0, after, -1)
                before_token = np.where(np.append(False, before[1:] == right[:-1]), rank, token[before])
                opened = np.minimum(
                    np.where(after >= 0, merges.rank(np.full(len(chosen), rank), token[after]), none),
                    np.where(before >= 0, merges.rank(before_token, np.full(len(chosen), rank)), none),
                )
                held = np.unique(home[chosen[opened <= rank]])
                wait = np.append(False, again) & np.isin(home[chosen], held)
                if wait.any():
                    chosen = chosen[~wait]
                    index[rank] = [places[np.isin(home[places], held)]]
                    heapq.heappush(waiting, rank)
            places = chosen
        right = follows[places]
        after = follows[right]
        token[places], follows[places] = rank, after
        alive[right], pair[right], pair[places] = False, none, none
        inside = after >= 0
        precedes[after[inside]] = places[inside]
        left = precedes[places]
        left, led = left[left >= 0], places[inside]
        pair[led] = merges.rank(token[led], token[after[inside]])
        pair[left] = merges.rank(token[left], token[follows[left]])
        note(np.concatenate([led, left]))
    packed = token[alive].astype("<u4").tobytes()
    tails = np.cumsum(4 * np.bincount(home[alive], minlength=len(words))).tolist()
    return [packed[a:b] for a, b in zip([0, *tails], tails)]


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, end to end."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def cut_before_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Each text cut at the spaces before visible characters, which are left out: all pieces, and how many each has."""
    array = pa.array(texts, pa.large_string())
    plain = pc.invert(pc.match_substring_regex(array, ODD_SPACE)).to_numpy(zero_copy_only=False)
    if plain.all():
        pieces = pc.split_pattern(array, " ")
        return pieces.flatten(), pc.list_value_length(pieces).to_numpy()
    groups, counts = [], np.zeros(len(texts), np.int64)
    for at, text in enumerate(texts):
        groups.append(text.split(" ") if plain[at] else BEFORE_WORD.split(text))
        counts[at] = len(groups[-1])
    return pa.array([p for g in groups for p in g], pa.large_string()), counts


class Encoder:
    """Texts to packed ids, with a memory of encoded pieces."""

    def __init__(self, ranks: dict[bytes, int], merges: Merges, pattern: str, memory: int = MEMORY):
        self.ranks, self.merges, self.memory = ranks, merges, memory
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}  # pieces that follow a space, without it

    def words(self, piece: str, prefix: str) -> list[str]:
        """The matches of the pattern; letters, also before a comma or full stop, need no search."""
        if piece.isalpha():
            return [prefix + piece]
        if piece[-1:] in COMMON_ENDS and piece[:-1].isalpha():
            return [prefix + piece[:-1], piece[-1]]
        return self.pattern.findall(prefix + piece)

    def learned(self, pieces: list[str], prefix: str) -> list[bytes]:
        """The packed ids of each piece."""
        split = [self.words(piece, prefix) for piece in pieces]
        packed = {"": b""}
        longer: dict[str, bytes] = {}
        for found in split:
            for word in found:
                if word not in packed and word not in longer:
                    encoded = word.encode()
                    if encoded in self.ranks:
                        packed[word] = self.ranks[encoded].to_bytes(4, "little")
                    else:
                        longer[word] = encoded
        packed.update(zip(longer, replay(list(longer.values()), self.merges)))
        return [packed[f[0]] if len(f) == 1 else b"".join([packed[w] for w in f]) for f in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces, counts = cut_before_words(texts)
        heads = np.cumsum(counts) - counts
        firsts = self.learned(pieces.take(pa.array(heads)).to_pylist(), "")
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_pylist()
        if len(self.known) > self.memory:
            self.known = {}
        new = [p for p in different if p not in self.known]
        self.known.update(zip(new, self.learned(new, " ")))
        ids = [self.known[p] for p in different]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        code = coded.indices.to_numpy()
        rest = np.ones(len(code), bool)
        rest[heads] = False  # the first piece of a text has no space before it
        code, owner = code[rest], np.repeat(np.arange(len(texts)), counts - 1)
        body = gathered(flat, (np.cumsum(sizes) - sizes)[code], sizes[code]).tobytes()
        tails = (4 * np.cumsum(np.bincount(owner, sizes[code], len(texts)).astype(np.int64))).tolist()
        return [first + body[a:b] for first, a, b in zip(firsts, [0, *tails], tails)]


class Decoder:
    """Packed ids to the bytes they stand for."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        return gathered(self.flat, self.starts[ids], self.sizes[ids]).tobytes()


def corpora(texts: list[str], most: int = CORPUS_CHARS) -> Iterator[list[str]]:
    at = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= most:
            yield texts[at : i + 1]
            at, held = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def encoder(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
    """A column function from text to packed ids."""
    merges = Merges(ranks)

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Encoder(ranks, merges, pattern)
        for texts in batches:
            yield pd.Series([ids for some in corpora(texts.tolist()) for ids in own.encode(some)], dtype=object)

    return encode


def decoder(ranks: dict[bytes, int]):
    """A column function from packed ids to the bytes they stand for."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Decoder(ranks)
        for packed in batches:
            yield pd.Series([own.decode(ids) for ids in packed], dtype=object)

    return decode


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the packed ids of the whole text in a new column named ``ids``; one of that name is refused."""
    if ids in docs.columns:
        raise ValueError(f"documents have a column {ids!r} already")
    return docs.withColumn(ids, encoder(ranks)(text_or_empty(F.col(text))))


def digester(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
    """A column function from text to the digests of its ids and of the bytes decoded from them.

    Ids and decoded bytes stay in the task, a corpus at a time.
    """
    merges = Merges(ranks)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, back = Encoder(ranks, merges, pattern), Decoder(ranks)
        for texts in batches:
            rows = [
                (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.decode(ids)).hexdigest())
                for some in corpora(texts.tolist())
                for ids in own.encode(some)
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encoded_digests(docs: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256 and decoded_sha256, decoded from the ids."""
    found = docs.select(F.col(id).alias("id"), digester(ranks)(text_or_empty(F.col(text))).alias("found"))
    return found.select("id", "found.*")


def op5(spark, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path(RANKS))
    return encoded_digests(table(spark, sf_dir, "documents"), ranks).withColumnRenamed("id", "doc_id")
