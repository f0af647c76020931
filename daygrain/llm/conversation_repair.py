"""Repair of conversations: the cheapest edits that give a turn order a grammar accepts.

A conversation should hold an optional system turn, then user and assistant in alternation,
and end with the assistant; it may also be empty. Rows may be kept, given another role,
deleted or preceded by inserted turns without text. The grammar is in Chomsky normal form
over repairs: its symbols are pairs (p, q) of places in a conversation, a rule
``(p, q) -> (p, r) (r, q)`` joins neighbouring spans, and a row alone gives (p, q) if an edit
of it leads from p to q. Insertions give (p, q) without any row; they are closed once and
put around each row.

A cell holds, for a span and each symbol, the least (cost, audit), where the audit lists the
edits by their initials. Costs follow from audit and rows, so of two audits of one span with
one cost neither begins with the other, and joining keeps the order. Cells are combined
bottom-up by span length, as in CYK parsing. Every symbol (p, q) splits at any row through
some r, so all splits of a span give the same cell and one is enough: spans have 1, 2,
4, ... ``PIECE`` rows, then ``FAN`` times that, and so on. Pieces are parsed in tasks of
their own and joined level by level, so a conversation of any length is spread over the
cluster, and no step holds more of it than ``PIECE`` rows or ``FAN`` cells. The audit of a
span is as long as the span, as is the one asked for.

Rows are laid out by conversation and turn with range partitions, and a row's place is its
place in its stretch plus the rows of its conversation in the stretches before. The digest
of the repaired text is sequential by nature: texts stream through one task per
conversation in order, one Arrow batch at a time.

Null conversations are one conversation. A null turn sorts first and takes no part in
gaps. Null role and text count as one space. A role starts with its first character; a row
whose role is empty cannot be kept, and rows of other roles can only be given a new role or
be deleted. Rows of one turn are ordered by role, then by the digest of their text; rows
equal in all of these are interchangeable. Rows that repeat are rows of their own. An empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from daygrain.llm.common import shuffle_partitions, stored, table
from daygrain.operators.series import meet

#: Rows parsed in one piece, and cells joined in one step.
PIECE = 64
FAN = 16

# Faults, in the order in which the first one counts.
FAULTS = ("blank", "duplicate", "truncated")
INK = r"[^\x20\x09-\x0D]"
CLOSING = ".!?"

# Costs of the edits, and what an unfinished turn costs that stays.
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
UNFINISHED = 3

#: Places: at the start, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn leads from a place. Roles are known by their initials.
MOVES = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: Places a conversation may end at.
ENDS = (START, ASSISTANT)
#: The symbols: pairs of places of which the second can be reached from the first.
SYMBOLS = [(p, q) for p in range(4) for q in range(4) if q >= p or (p, q) == (ASSISTANT, USER)]
#: The rules, by number: symbol <- symbol symbol.
RULES = [
    (SYMBOLS.index((p, q)), SYMBOLS.index((p, r)), SYMBOLS.index((r, q)))
    for p, r in SYMBOLS
    for q in range(4)
    if (r, q) in SYMBOLS and (p, q) in SYMBOLS
]

#: Initials as the parser sees them; any other role is the last one.
INITIALS = "sua?"

Best = tuple[int, str]
Cell = tuple["Best | None", ...]


def _least(entries: list[tuple[int, Best]]) -> Cell:
    cell: list[Best | None] = [None] * len(SYMBOLS)
    for symbol, best in entries:
        if cell[symbol] is None or best < cell[symbol]:
            cell[symbol] = best
    return tuple(cell)


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans together."""
    cell: list[Best | None] = [None] * len(SYMBOLS)
    for whole, first, second in RULES:
        a, b = left[first], right[second]
        if a is None or b is None:
            continue
        cost, now = a[0] + b[0], cell[whole]
        if now is None or cost < now[0] or cost == now[0] and a[1] + b[1] < now[1]:
            cell[whole] = (cost, a[1] + b[1])
    return tuple(cell)


def _closure() -> Cell:
    """What insertions alone lead to, until no more of them is cheaper."""
    stay = [(SYMBOLS.index((p, p)), (0, "")) for p in range(4)]
    once = [(SYMBOLS.index((p, q)), (COSTS["I"], "I")) for (p, role), q in MOVES.items() if role in "ua"]
    cell = _least(stay + once)
    while (more := join(cell, cell)) != cell:
        cell = more
    return cell


INSERTED = _closure()


def symbol(initial: Column, fault: Column) -> Column:
    """One character for what the parser needs to know of a row."""
    role = F.when(initial.isin(*INITIALS[:3]), initial).otherwise(F.lit(INITIALS[3]))
    number = F.instr(F.lit(INITIALS), role) * 4 + F.coalesce(F.array_position(F.array(*map(F.lit, FAULTS)), fault), F.lit(0))
    return F.char(F.lit(60) + number)


def meaning(row: str) -> tuple[str, str | None]:
    """Initial and fault that :func:`symbol` put into a character."""
    number = ord(row) - 60
    return INITIALS[number // 4 - 1], (None, *FAULTS)[number % 4]


@lru_cache(maxsize=None)  # one entry per character in use, 16 at most
def of_row(row: str) -> Cell:
    """The cell of a row alone, with insertions around it."""
    initial, fault = meaning(row)
    edits = [(SYMBOLS.index((p, p)), (COSTS["D"], "D")) for p in range(4)]
    if fault not in ("blank", "duplicate"):
        extra = UNFINISHED if fault == "truncated" else 0
        for (p, role), q in MOVES.items():
            if role == initial:
                edits.append((SYMBOLS.index((p, q)), (COSTS["K"] + extra, "K")))
            if role in "ua":
                edits.append((SYMBOLS.index((p, q)), (COSTS["R"] + extra, "R")))
    return join(join(INSERTED, _least(edits)), INSERTED)


@lru_cache(maxsize=1 << 14)
def parse(rows: str) -> Cell:
    """The cell of a run of rows; shorter spans first, each of two halves."""
    if len(rows) == 1:
        return of_row(rows)
    half = 1 << (len(rows) - 1).bit_length() - 1
    return join(parse(rows[:half]), parse(rows[half:]))


def illegal_pairs(rows: str) -> int:
    roles = [meaning(r)[0] for r in rows]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


# the rows


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, copy): rows after the damage that a checksum of their key decides."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    hit = F.crc32(key.cast("binary")) % 20
    said = F.coalesce(F.col(text), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(hit == 4, F.lit("user")).otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        F.explode(F.when(hit == 0, F.array().cast("array<int>")).when(hit == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"),
    )


#: The order of a conversation's rows.
ORDER = ("turn", "role", "digest", "copy")


def slim(rows: DataFrame) -> DataFrame:
    """Rows without their text: what ordering, faults and parsing need."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return rows.select(
        "conv",
        "turn",
        "role",
        "copy",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(~F.col("text").rlike(INK), FAULTS[0]).when(~last.isin(*CLOSING), FAULTS[2]).alias("own_fault"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, their place in their conversation.

    Range partitions give every task a stretch of the order of all rows. A conversation that
    runs over several stretches adds the rows it has in those before; there are fewer such
    (conversation, stretch) pairs than partitions, so they are broadcast.
    """
    parts = shuffle_partitions(rows.sparkSession)
    placed = stored(
        rows.repartitionByRange(parts, "conv", *ORDER)
        .sortWithinPartitions("conv", *ORDER)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        "placed",
    )
    before = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        placed.groupBy("conv", "part")
        .agg(F.count("*").alias("n"))
        .withColumn("base", F.sum("n").over(before))
        .filter("base IS NOT NULL")
        .select("conv", "part", "base")
    )
    inside = W.partitionBy("part", "conv").orderBy("at")
    own = placed.withColumn("nth", F.row_number().over(inside) - 1)
    return meet(own, F.broadcast(bases), ["conv", "part"], "left").select(
        "conv", "turn", "role", "digest", "own_fault", (F.coalesce("base", F.lit(0)) + F.col("nth")).alias("pos")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv, pos, turn, symbol, fault): a row's first fault; repeats of an earlier row of its conversation included."""
    # Only what occurs twice is joined. It is written first, so that the join can split a frequent text.
    first = stored(
        rows.filter("own_fault IS NULL OR own_fault != 'blank'")
        .groupBy("conv", "role", "digest")
        .agg(F.min("pos").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "repeats",
    )
    again = meet(rows, first, ["conv", "role", "digest"], "left")
    fault = (
        F.when(F.col("own_fault") == FAULTS[0], FAULTS[0])
        .when(F.col("pos") > F.col("first"), FAULTS[1])
        .otherwise(F.col("own_fault"))
    )
    marked = again.withColumn("fault", fault)
    return marked.select(
        "conv", "pos", "turn", "fault", symbol(F.substring("role", 1, 1), F.col("fault")).alias("symbol")
    )


# the parse

_BEST = StructType().add("cost", LongType()).add("audit", StringType())
CELL = (
    StructType().add("best", ArrayType(_BEST)).add("illegal", LongType()).add("first", StringType()).add("last", StringType())
)


def _packed(cells: list[tuple[Cell, int, str, str]]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "best": [[b and {"cost": b[0], "audit": b[1]} for b in cell] for cell, *_ in cells],
            "illegal": [c[1] for c in cells],
            "first": [c[2] for c in cells],
            "last": [c[3] for c in cells],
        }
    )


@F.pandas_udf(CELL)
def parsed(runs: pd.Series) -> pd.DataFrame:
    return _packed([(parse(run), illegal_pairs(run), run[0], run[-1]) for run in runs])


@F.pandas_udf(CELL)
def joined(groups: pd.Series) -> pd.DataFrame:
    """Neighbouring cells into one, in pairs of growing length."""
    done = []
    for group in groups:
        cells = [
            (tuple(b and (b["cost"], b["audit"]) for b in c["best"]), c["illegal"], c["first"], c["last"]) for c in group
        ]
        while len(cells) > 1:
            pairs = [
                (join(a[0], b[0]), a[1] + b[1] + illegal_pairs(a[3] + b[2]), a[2], b[3])
                for a, b in zip(cells[::2], cells[1::2])
            ]
            cells = pairs + cells[len(pairs) * 2 :]
        done += cells
    return _packed(done)


def cells(rows: DataFrame, piece: int = PIECE, fan: int = FAN) -> DataFrame:
    """(conv, cell): one cell per conversation."""
    spelled = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "symbol"))), lambda r: r["symbol"]), "")
    runs = rows.groupBy("conv", F.floor(F.col("pos") / piece).alias("piece")).agg(spelled.alias("run"))
    now = stored(runs.select("conv", "piece", parsed("run").alias("cell")), "cells")
    while (now.agg(F.max("piece")).first()[0] or 0) > 0:
        in_order = F.sort_array(F.collect_list(F.struct("piece", "cell.*")))
        together = now.groupBy("conv", F.floor(F.col("piece") / fan).alias("piece")).agg(in_order.alias("group"))
        now = stored(together.select("conv", "piece", joined("group").alias("cell")), "cells")
    return now.select("conv", "cell")


def audits(whole: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit): the cheapest way to a permitted end, ties to the smaller audit."""
    ways = F.array(*[F.col("cell.best")[SYMBOLS.index((START, end))] for end in ENDS])
    best = F.array_min(F.filter(ways, lambda way: way.isNotNull()))
    return whole.select("conv", F.col("cell.illegal").alias("illegal"), best.alias("best")).select(
        "conv", "illegal", "best.cost", "best.audit"
    )


# the repaired text


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation; its audit comes first, its rows in order after it."""
    names = {"u": "user", "a": "assistant"}
    conv = edits = digest = None
    at = turns = 0
    place = START
    kind = None

    def say(role: str, text: str) -> None:
        nonlocal turns, place
        digest.update((("\n" if turns else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        turns += 1
        place = MOVES[place, role[0]]

    def expected() -> str:
        return names["a" if place == USER else "u"]

    def insertions() -> None:
        nonlocal at
        while at < len(edits) and edits[at] == "I":
            say(expected(), "")
            at += 1

    for batch in batches:
        kind = batch.schema.field("conv").type
        done: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")]
        for its_conv, audit, role, text in zip(*columns):
            if audit is not None:
                if digest is not None:
                    insertions()
                    done.append((conv, digest.hexdigest()))
                conv, edits, digest, at, turns, place = its_conv, audit, hashlib.sha256(), 0, 0, START
                continue
            insertions()
            if edits[at] == "K":
                say(role, text)
            elif edits[at] == "R":
                say(expected(), text)
            at += 1
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in done], kind), pa.array([h for _, h in done], pa.string())],
                names=["conv", "repaired_sha256"],
            )
    if digest is not None:
        insertions()
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv", "repaired_sha256"]
        )


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the damaged rows under their audits."""
    texts = rows.select(
        "conv", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copy",
        "text", F.lit(None).cast("string").alias("audit"),
    )
    heads = found.select("conv", F.lit(0).alias("kind"), "audit")
    stream = texts.unionByName(heads, allowMissingColumns=True)
    in_order = stream.repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)
    schema = rows.select("conv").schema.add("repaired_sha256", "string")
    return in_order.select("conv", "audit", "role", "text").mapInArrow(_hashed, schema)


def repair(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    damage: bool = True,
    piece: int = PIECE,
    fan: int = FAN,
) -> DataFrame:
    """One row per conversation: conv, what is wrong with it, and its cheapest repair.

    ``damage`` first harms the rows by checksum, as a repair's test needs. Without it rows are
    taken as they are.
    """
    if damage:
        rows = damaged(conversations, conv, turn, role, text)
    else:
        rows = conversations.select(
            F.col(conv).alias("conv"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text), F.lit(" ")).alias("text"),
            F.lit(0).alias("copy"),
        )
    marked = stored(with_faults(numbered(stored(slim(rows), "slim"))), "faults")
    found = stored(audits(cells(marked, piece, fan)), "audits")
    # Turns first, then conversations: a long conversation is counted in many tasks.
    per_turn = marked.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in FAULTS])
    counts = stored(
        per_turn.groupBy("conv").agg(
            *[F.sum(f).alias(f) for f in FAULTS],
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        ),
        "counts",
    )
    digests = stored(repaired_digests(rows, found), "digests")
    every = conversations.select(F.col(conv).alias("conv")).distinct()
    result = every
    for part in (counts, found, digests):
        result = meet(result, part, ["conv"], "left")
    zero = F.lit(0).cast("long")
    return result.select(
        "conv",
        *[F.coalesce(c, zero).cast("long").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def op12(spark, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


def _after(way: str, letter: str, extra: str = "0") -> str:
    """A struct (c, a) of cost and audit, with one more edit."""
    cost = f"{way}.c + {COSTS[letter]} + {extra}"
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {cost}, 'a': {way}.a || '{letter}'}} END"


def _keep(role: str, *ways: str) -> list[str]:
    return [f"CASE WHEN initial = '{role}' AND NOT must_go THEN {_after(w, 'K', 'unfinished')} END" for w in ways]


def _rename(*ways: str) -> list[str]:
    return [f"CASE WHEN NOT must_go THEN {_after(w, 'R', 'unfinished')} END" for w in ways]


def _min(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _inserted(way: str) -> str:
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {2 * COSTS['I']}, 'a': {way}.a || 'II'}} END"


#: The same costs row by row, over the places a conversation can be at, and DuckDB's checksum by hand.
OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
hits AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           [4294967295] || list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
             lambda x: ascii(x)::BIGINT),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 20 AS hit
  FROM conversations, crc),
harmed AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE hit WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hits),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
         left(role, 1) AS initial,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS closing
  FROM harmed),
marked AS (
  SELECT *, CASE WHEN closing = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN closing NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair
  FROM placed),
rated AS (
  SELECT conv_id, pos, initial, coalesce(fault IN ('blank', 'duplicate'), false) AS must_go,
         CASE WHEN fault = 'truncated' THEN {UNFINISHED} ELSE 0 END AS unfinished
  FROM marked),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, {{'c': 0, 'a': ''}} AS s, NULL::STRUCT(c INT, a VARCHAR) AS y,
         {{'c': {COSTS['I']}, 'a': 'I'}} AS u, {{'c': {2 * COSTS['I']}, 'a': 'II'}} AS t
  FROM rated
  UNION ALL
  SELECT conv_id, pos, s, y,
         {_min('u', _after('s', 'I'), _after('y', 'I'), _after('t', 'I'))} AS u,
         {_min('t', _after('u', 'I'), _inserted('s'), _inserted('y'))} AS t
  FROM (
    SELECT w.conv_id, r.pos,
           {_after('s', 'D')} AS s,
           {_min(_after('y', 'D'), *_keep('s', 's'))} AS y,
           {_min(_after('u', 'D'), *_keep('u', 's', 'y', 't'), *_rename('s', 'y', 't'))} AS u,
           {_min(_after('t', 'D'), *_keep('a', 'u'), *_rename('u'))} AS t
    FROM walk w JOIN rated r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1)),
solved AS (
  SELECT conv_id, arg_max(list_min([s, t]), pos) AS best FROM walk GROUP BY conv_id),
letters AS (
  SELECT conv_id, i, letter, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY i) AS pos
  FROM (SELECT conv_id, unnest(string_split(best.a, '')) AS letter, unnest(range(length(best.a))) AS i FROM solved)
  WHERE letter <> ''),
said AS (
  SELECT l.conv_id, i, letter, m.role, CASE WHEN letter = 'I' THEN '' ELSE m.text END AS text,
         row_number() OVER (PARTITION BY l.conv_id ORDER BY i) - 1 AS j,
         first_value(letter = 'K' AND m.initial = 's') OVER (PARTITION BY l.conv_id ORDER BY i) AS opened
  FROM letters l LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM l.conv_id AND m.pos = l.pos
  WHERE letter <> 'D'),
repaired AS (
  SELECT conv_id, sha256(string_agg(
           CASE WHEN letter = 'K' THEN role WHEN (j - opened::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || text, chr(10) ORDER BY i)) AS repaired_sha256
  FROM said GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN solved v ON v.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM e.conv_id
"""
