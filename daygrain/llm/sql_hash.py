"""Checksums and hashes spelled out in DuckDB's SQL, for queries whose order or result rests on them.

Each function returns SQL text. Products of 64-bit numbers are taken in 128 bits and cut back.
"""

from __future__ import annotations

# The primes of XXH64, and the seed that Spark's function takes.
P1, P2, P3, P4, P5 = (
    11400714785074694791,
    14029467366897019727,
    1609587929392839161,
    9650029242287828579,
    2870177450012600261,
)
SEED = 42
#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 3988292384

_BITS = 1 << 64


def wide(n: int) -> str:
    return f"{n % _BITS}::UHUGEINT"


def cut(x: str) -> str:
    return f"({x}) & {_BITS - 1}::UHUGEINT"


def turned(x: str, bits: int) -> str:
    """``x`` rotated to the left."""
    return f"((({x}) * {wide(1 << bits)} & {_BITS - 1}::UHUGEINT) | (({x}) >> {64 - bits}::UHUGEINT))"


def folded(x: str, bits: int) -> str:
    """``x`` with its upper bits laid over the lower ones."""
    return f"xor({x}, ({x}) >> {bits}::UHUGEINT)"


def _round(lane: str, word: str) -> str:
    return cut(f"{turned(cut(f'{lane} + {word} * {wide(P2)}'), 31)} * {wide(P1)}")


def _word(h: str, word: str) -> str:
    return cut(f"{turned(f'xor({h}, {_round(wide(0), word)})', 27)} * {wide(P1)} + {wide(P4)}")


def _little_endian(digits: str, n: int) -> str:
    """The number that ``n`` bytes in hex stand for, lowest byte first."""
    swapped = "".join(f"\\{i}" for i in range(n, 0, -1))
    return f"('0x' || regexp_replace({digits}, '{'(..)' * n}', '{swapped}'))::UBIGINT::UHUGEINT"


def _closed(name: str) -> str:
    """The last steps, from (k, h) of ``<name>_6`` to (k, h) of ``<name>``, unsigned."""
    return f"""
{name}_7 AS (SELECT k, {cut(f"{folded('h', 33)} * {wide(P2)}")} AS h FROM {name}_6),
{name}_8 AS (SELECT k, {cut(f"{folded('h', 29)} * {wide(P3)}")} AS h FROM {name}_7),
{name} AS (SELECT k, ({folded('h', 32)})::UBIGINT AS h FROM {name}_8)"""


def xxh64_of_texts(name: str, keys: str, seed: int = SEED) -> str:
    """Tables that end in ``name`` (k, h): the unsigned XXH64 of each text that the query ``keys`` returns as k."""
    lanes = [seed + P1 + P2, seed + P2, seed, seed - P1]
    ran = [
        f"list_reduce([{wide(start)}] || w[{i}:n // 32 * 4:4], lambda v, x: {_round('v', 'x')})"
        for i, start in enumerate(lanes, 1)
    ]
    merged = cut(f"xor(h, {_round(wide(0), 'v')}) * {wide(P1)} + {wide(P4)}")
    together = cut(" + ".join(turned(f"v[{i}]", bits) for i, bits in enumerate((1, 7, 12, 18), 1)))
    four = cut(f"{turned(f'xor(h, {cut(f'four * {wide(P1)}')})', 23)} * {wide(P2)} + {wide(P3)}")
    byte = cut(f"{turned(f'xor(h, {cut(f'b * {wide(P5)}')})', 11)} * {wide(P1)}")
    return f"""
{name}_0 AS (SELECT k, hex(encode(k)) AS x FROM (SELECT DISTINCT k FROM ({keys}))),
{name}_1 AS (
  SELECT k, length(x) // 2 AS n, substr(x, length(x) // 16 * 16 + 1) AS rest,
         list_transform(regexp_extract_all(x, '.{{16}}'), lambda d: {_little_endian("d", 8)}) AS w
  FROM {name}_0),
{name}_2 AS (SELECT k, n, rest, w[n // 32 * 4 + 1:] AS w, CASE WHEN n >= 32 THEN [{", ".join(ran)}] END AS v FROM {name}_1),
{name}_3 AS (
  SELECT k, rest, w, {cut(f'''CASE WHEN v IS NULL THEN {wide(seed + P5)}
           ELSE list_reduce([{together}] || v, lambda h, v: {merged}) END + n::UHUGEINT''')} AS h
  FROM {name}_2),
{name}_4 AS (
  SELECT k, rest, list_reduce([h] || w, lambda h, x: {_word("h", "x")}) AS h,
         CASE WHEN length(rest) >= 8 THEN {_little_endian("substr(rest, 1, 8)", 4)} END AS four
  FROM {name}_3),
{name}_5 AS (
  SELECT k, CASE WHEN four IS NULL THEN h ELSE {four} END AS h,
         list_transform(regexp_extract_all(CASE WHEN four IS NULL THEN rest ELSE substr(rest, 9) END, '..'),
                        lambda d: ('0x' || d)::UBIGINT::UHUGEINT) AS b
  FROM {name}_4),
{name}_6 AS (SELECT k, list_reduce([h] || b, lambda h, b: {byte}) AS h FROM {name}_5),{_closed(name)}"""


def _bound(x: str, then) -> str:
    """``then`` of a value that is computed once."""
    return f"list_transform([{x}], lambda h: {then('h')})[1]"


def _ended(h: str) -> str:
    """The last steps, as one expression."""
    h = _bound(h, lambda x: cut(f"{folded(x, 33)} * {wide(P2)}"))
    h = _bound(h, lambda x: cut(f"{folded(x, 29)} * {wide(P3)}"))
    return _bound(h, lambda x: folded(x, 32))


def xxh64_of_long(x: str, seed: str = wide(SEED)) -> str:
    """Spark's XXH64 of a signed 64-bit number after ``seed``, which is left alone by a null."""
    bits = f"(CASE WHEN {x} < 0 THEN {x}::HUGEINT + {_BITS}::HUGEINT ELSE {x}::HUGEINT END)::UHUGEINT"
    start = cut(f"{seed} + {wide(P5 + 8)}")
    return f"CASE WHEN {x} IS NULL THEN {seed} ELSE {_ended(_word(f'({start})', bits))} END"


def xxh64_of_int(x: str, seed: str = wide(SEED)) -> str:
    """Spark's XXH64 of a number of 0 to 2 ** 31 - 1 of 32 bits after ``seed``."""
    start = f"xor({cut(f'{seed} + {wide(P5 + 4)}')}, {cut(f'{x}::UHUGEINT * {wide(P1)}')})"
    return _ended(cut(f"{turned(start, 23)} * {wide(P2)} + {wide(P3)}"))


def signed(h: str) -> str:
    """An unsigned 64-bit number as the signed one of the same bits."""
    return f"(CASE WHEN {h} >= {1 << 63} THEN {h}::HUGEINT - {_BITS}::HUGEINT ELSE {h}::HUGEINT END)::BIGINT"


#: A table ``crc`` of one row, the steps of CRC-32 for each byte.
CRC_TABLE = f"""crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {POLYNOMIAL}) ELSE c >> 1 END)) AS tab)"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, beside the table ``crc``."""
    steps = "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda d: ('0x' || d)::BIGINT)"
    return f"xor(4294967295, list_reduce([4294967295] || {data}, {steps}))"
