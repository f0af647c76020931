"""Mix sources to target weights, in blocks of a fixed number of words.

Each source's documents are packed end to end into blocks of ``block`` words;
the last block of a source may be shorter. A source's target in words becomes a
number of output slots. Slots of all sources draw a keyed random number, and its
rank over all slots is the slot's place in the output, which is cut into shards
of ``SHARD_SLOTS`` slots: so the numbers of slots that the sources get in a shard
are a multinomial draw given the totals. Totals stay on target, shards vary. The
slots of a source are counted through the shards, and the k-th maps through a
pseudorandom permutation of its block numbers, a new one for every pass over the
source; blocks join slots by (source, block number). In every pass each block is
used at most once, so nothing is used more than ``cap`` times.

Targets share the total by weight; a target stops at ``cap`` times its source's
size and the excess is shared by weight among the others. Sources are ordered by
code point, null last, and take the weights in turn.

A null text has no words and a document without words takes part with 0. Rows
that repeat an id are separate documents. An empty table gives an empty result.
Permutations are keyed by seed, source and pass, so reruns agree. The number of
distinct sources is taken to be small: their totals, a row each, are ordered in
one task. A hot source is spread over buckets of its documents, by a hash of id
and text, and its slots over range partitions of the draw.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.common import WORD, shuffle_partitions, stored, table, text_or_empty
from daygrain.llm.sql_hash import signed, wide, xxh64_of_int, xxh64_of_long, xxh64_of_texts

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 1024
CAP = 3
SEED = 17
SHARD_SLOTS = 256
#: Documents whose running sums one task takes.
BUCKET_ROWS = 50_000
#: Slots that one row of the slot generator expands to, and rows that one task expands.
RUN = 8192
TASK_RUNS = 16
#: Places below which a permutation walks until it ends, and steps of a walk from there on.
SMALL = 4096
STEPS = 24
ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in so many bits
MODULUS = 2147483647

#: A word with the white space after it, the first one also with what stands before it.
PIECE = r"(?:^[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def permuted(index: str, n: str, key: str) -> str:
    """SQL for the place of ``index`` in a pseudorandom permutation of 0 to n - 1.

    Four Feistel rounds over a square of at least n places; a place beyond n is sent round
    again. Under ``SMALL`` places there is a step for every place outside, so that all walks
    end. From there on at most a share of 1/32 is outside, and of all walks ``STEPS`` long a
    share of 32 ** -STEPS is not at its end, which raises. So a slot costs the same whatever n is.
    """
    side = f"greatest(1L, cast(ceil(sqrt({n})) AS bigint))"

    def once(x: str) -> str:
        mixed = f"((state.r * 48271 + {key} + round * 1299709) % {MODULUS})"
        drawn = f"(({mixed} * {mixed} + state.r * 69621) % {MODULUS})"
        return (
            f"aggregate(sequence(1, 4), named_struct('l', {x} div {side}, 'r', {x} % {side}), (state, round) ->"
            f" named_struct('l', state.r, 'r', (state.l + {drawn}) % {side}), state -> state.l * {side} + state.r)"
        )

    steps = f"least({side} * {side} - {n}, if({n} < {SMALL}, {SMALL}L, {STEPS}L))"
    return (
        f"aggregate(sequence(0L, greatest(0L, {steps})), cast(-1 AS bigint), (walker, step) ->"
        f" CASE WHEN step = 0 THEN {once(index)} WHEN walker < {n} THEN walker ELSE {once('walker')} END,"
        f" walker -> if(walker < greatest({n}, 1), walker, cast(raise_error('a walk has not ended') AS bigint)))"
    )


def source_targets(totals: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``totals`` (source, source_size) with sid and target: the total shared by weight under the cap."""
    everything = Window.partitionBy()
    ranked = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ).withColumn("most", cap * F.col("source_size"))
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    filled = ranked.withColumn("place", F.row_number().over(by_room)).withColumn("level", level)
    free = F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("place"))
    filled = filled.withColumn("free", F.min(free).over(everything))
    filled = filled.withColumn("water", F.max(F.when(F.col("place") == F.col("free"), F.col("level"))).over(everything))
    target = F.when(F.col("place") >= F.col("free"), F.col("water") * F.col("weight")).otherwise(
        F.col("most").cast("double")
    )
    return filled.select("source", "sid", "source_size", target.alias("target"))


def positions(sized: DataFrame, weights, cap: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in their source's word stream, and the sources with their targets.

    ``sized`` is a written table of row, doc_id, source, size and mark.
    """
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    keyed = sized.withColumn("skey", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(buckets))
    )
    cells = stored(
        keyed.groupBy("skey", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source")), "cells"
    )
    totals = cells.groupBy("skey").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    sources = stored(source_targets(totals.drop("skey"), weights, cap), "sources")
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        cells.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(sources, cells["source"].eqNullSafe(sources["source"]))
        .select("skey", "bucket", "base", "sid", "source_size", "target")
    )
    inside = Window.partitionBy("skey", "bucket").orderBy("doc_id", "size", "mark", "row").rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = (
        keyed.join(bases, ["skey", "bucket"])
        .withColumn("start", F.col("base") + F.sum("size").over(inside) - F.col("size"))
        .select("row", "doc_id", "size", "sid", "source_size", "target", "start")
    )
    return placed, sources


def planned_slots(sources: DataFrame, block: int) -> DataFrame:
    """Sources with their blocks, whole passes, words of the last pass, and number of slots."""
    return (
        sources.withColumn("want", F.floor(F.col("target") + 0.5).cast("long"))
        .filter("want > 0")
        .selectExpr("sid", f"source_size div {block} AS whole", f"source_size % {block} AS tail",
                    "want div source_size AS passes", "want % source_size AS rest")
        .selectExpr("*", "whole + if(tail > 0, 1, 0) AS blocks")
        .selectExpr("*", f"passes * blocks + (rest + {block - 1}) div {block} AS n_slots")
    )


def drawn_places(planned: DataFrame, seed: int) -> DataFrame:
    """(sid, place, k): the place of every slot in the output, and how many of its source come before it.

    Places are ranks of a keyed draw, found in range partitions of it: a slot's rank is its row
    in its partition plus the rows of the partitions before. ``k`` is found the same way, from
    rows per partition and source.
    """
    runs = planned.select("sid", "n_slots", F.explode(F.expr(f"sequence(0L, (n_slots - 1) div {RUN})")).alias("run"))
    total = planned.agg(F.sum(F.expr(f"(n_slots - 1) div {RUN} + 1"))).first()[0] or 0
    each = runs.repartition(max(1, -(-total // TASK_RUNS))).selectExpr(
        "sid", f"explode(sequence(run * {RUN}, least(n_slots, (run + 1) * {RUN}) - 1)) AS nth"
    )
    # Integers alone are hashed, so the draw is the same wherever a slot is made.
    ordered = ("draw", "sid", "nth")
    placed = stored(
        each.withColumn("draw", F.xxhash64(F.lit(seed), "sid", "nth"))
        .repartitionByRange(shuffle_partitions(planned.sparkSession), *ordered)
        .sortWithinPartitions(*ordered)
        .select("sid", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "places",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    parts = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    own_before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_source = placed.groupBy("sid", "part").agg(F.count("*").alias("n"))
    bases = per_source.select("sid", "part", F.coalesce(F.sum("n").over(own_before), F.lit(0)).alias("own_before"))
    inside = Window.partitionBy("part", "sid").orderBy("at")
    return (
        placed.withColumn("own", F.row_number().over(inside) - 1)
        .join(F.broadcast(parts), "part")
        .join(bases, ["part", "sid"])
        .select(
            "sid",
            (F.col("rows_before") + F.col("at").bitwiseAND((1 << ROW_BITS) - 1)).alias("place"),
            (F.col("own_before") + F.col("own")).alias("k"),
        )
    )


def slots(sources: DataFrame, block: int, seed: int, shard_slots: int) -> DataFrame:
    """One row per output slot: shard, slot, sid, pass, block number and the words taken from the block."""
    planned = planned_slots(sources, block)
    each = drawn_places(planned, seed).join(F.broadcast(planned), "sid")  # a row per source
    each = each.selectExpr("*", "k div blocks AS pass", "k % blocks AS i")
    each = each.selectExpr(
        "*",
        f"(sid * 7919 + pass * 104729 + {seed} * 15485863) % {MODULUS} AS key",
        f"CASE WHEN pass < passes THEN if(i < whole, {block}, tail) ELSE least({block}, rest - i * {block}) END AS words",
        f"if(i < whole, {block}, tail) AS length",
    )
    return each.selectExpr(
        "sid", "pass", f"CASE WHEN i < whole THEN {permuted('i', 'whole', 'key')} ELSE whole END AS block",
        "words", "length", f"place div {shard_slots} AS shard", f"place % {shard_slots} AS slot",
    )


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """The part of each block that each document fills; a document without words gives one row without a block."""
    covered = placed.selectExpr(
        "*",
        f"explode_outer(if(size > 0, sequence(start div {block}, (start + size - 1) div {block}), NULL)) AS block",
    )
    return covered.selectExpr(
        "*", f"greatest(start, block * {block}) AS head", f"least(start + size, (block + 1) * {block}) AS end"
    )


def sized_rows(docs: DataFrame, id: str, text: str, source: str, keep: list) -> DataFrame:
    words = F.regexp_count(text_or_empty(F.col(text)), F.lit(WORD)).cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        words.alias("size"),
        F.xxhash64(F.col(text)).alias("mark"),
        *keep,
    )


def words_taken(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, block: int = BLOCK, cap: int = CAP, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken and n_shards.

    ``taken`` counts the words the mix takes from it, ``n_shards`` the output shards that hold any of them.
    """
    placed, sources = positions(stored(sized_rows(docs, id, text, source, []), "sizes"), weights, cap)
    uses = slots(sources, block, seed, SHARD_SLOTS).groupBy("sid", "block").agg(
        F.count_if(F.col("words") == F.col("length")).alias("uses"),
        F.max(F.when(F.col("words") < F.col("length"), F.col("words"))).alias("cut"),
        # A block has a slot in each pass, of which there are few.
        F.collect_list(F.struct("shard", "words")).alias("places"),
    )
    part = F.coalesce(F.col("uses"), F.lit(0)) * (F.col("end") - F.col("head")) + F.greatest(
        F.lit(0), F.least("end", F.col("block") * block + F.coalesce(F.col("cut"), F.lit(0))) - F.col("head")
    )
    reached = F.filter("places", lambda p: F.col("block") * block + p["words"] > F.col("head"))
    shards = F.array_distinct(F.flatten(F.collect_list(F.transform(reached, lambda p: p["shard"]))))
    return (
        pieces(placed, block)
        .join(uses, ["sid", "block"], "left")
        .groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(F.coalesce(F.sum(part), F.lit(0)).cast("long").alias("taken"), F.size(shards).cast("long").alias("n_shards"))
        .drop("row")
    )


def mixed_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, block: int = BLOCK, cap: int = CAP, seed: int = SEED,
) -> DataFrame:
    """``docs`` as the mix takes them, with the same columns.

    A document appears once for every pass that takes any of its words, with
    the text of the blocks taken in that pass; taken whole, its text is
    unchanged. ``n_chars``, if there, is counted anew.
    """
    held = stored(
        sized_rows(docs, id, text, source, [F.struct(*docs.columns).alias("doc")]), "mix-input"
    )
    placed, sources = positions(held.select("row", "doc_id", "source", "size", "mark"), weights, cap)
    used = (
        pieces(placed, block)
        .join(slots(sources, block, seed, SHARD_SLOTS), ["sid", "block"])
        .withColumn("end", F.least("end", F.col("block") * block + F.col("words")))
        .filter("end > head")
        .groupBy("row", "pass")
        .agg(
            F.sum(F.col("end") - F.col("head")).alias("taken"),
            F.array_sort(F.collect_list(F.struct((F.col("head") - F.col("start")).cast("int").alias("head"),
                                                 (F.col("end") - F.col("head")).cast("int").alias("n")))).alias("spans"),
        )
    )
    words = F.regexp_extract_all(F.col(f"doc.{text}"), F.lit(PIECE), F.lit(0))
    cut = F.transform(  # over one array, so that the words are found once
        F.array(words),
        lambda all_words: F.array_join(
            F.flatten(F.transform("spans", lambda s: F.slice(all_words, s["head"] + 1, s["n"]))), ""
        ),
    )[0]
    mixed = F.when(F.col("taken") == F.col("size"), F.col(f"doc.{text}")).otherwise(cut)
    rows = held.select("row", "size", "doc").join(used, "row").withColumn("mixed", mixed)
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col("mixed").alias(name))
        elif name == "n_chars":
            columns.append(F.char_length("mixed").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("doc").getField(name).alias(name))
    return rows.select(*columns)


def op1(spark, sf_dir: str) -> DataFrame:
    return words_taken(table(spark, sf_dir, "documents"))


def _once_sql(x: str) -> str:
    """Four rounds over a place of a square, whose sides are kept as one number."""
    mixed = f"(((x % side) * 48271 + key + round * 1299709) % {MODULUS})"
    drawn = f"(({mixed} * {mixed} + (x % side) * 69621) % {MODULUS})"
    return f"list_reduce([{x}, 1, 2, 3, 4], lambda x, round: (x % side) * side + (x // side + {drawn}) % side)"


#: The draw slot by slot, ranks over all slots, and walks that end when they reach a place.
OP1_SQL = f"""
WITH RECURSIVE {xxh64_of_texts("hashed", "SELECT text AS k FROM documents WHERE text IS NOT NULL")},
sized AS (
  SELECT row_number() OVER () AS row, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         {signed(f"coalesce(h, {wide(42)})")} AS mark
  FROM documents LEFT JOIN hashed ON k = text),
bucketed AS (
  SELECT s.*, (({signed("h")}) % n + n) % n AS bucket
  FROM (SELECT *, {xxh64_of_long("mark", f"({xxh64_of_long('doc_id')})")} AS h FROM sized) s,
       (SELECT greatest(1, (count(*) + {BUCKET_ROWS - 1}) // {BUCKET_ROWS}) AS n FROM sized)),
ranked AS (
  SELECT *, list_value({", ".join(f"{w}::DOUBLE" for w in WEIGHTS)})[sid % {len(WEIGHTS)} + 1] AS weight, {CAP} * source_size AS most
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
        FROM sized GROUP BY source)),
levels AS (
  SELECT *, row_number() OVER by_room AS place,
         (sum(source_size) OVER ()::BIGINT - coalesce(sum(most) OVER before, 0)::BIGINT)::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ranked
  WINDOW by_room AS (ORDER BY most / weight, sid),
         before AS (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sources AS (
  SELECT source, sid, source_size,
         CASE WHEN place >= (SELECT min(place) FROM levels WHERE most > level * weight)
              THEN weight * (SELECT arg_min(level, place) FROM levels WHERE most > level * weight)
              ELSE most::DOUBLE END AS target
  FROM levels),
planned AS (
  SELECT *, passes * blocks + (rest + {BLOCK - 1}) // {BLOCK} AS n_slots
  FROM (SELECT sid, source_size // {BLOCK} AS whole, source_size % {BLOCK} AS tail, want // source_size AS passes,
               want % source_size AS rest, (source_size + {BLOCK - 1}) // {BLOCK} AS blocks
        FROM (SELECT *, floor(target + 0.5)::BIGINT AS want FROM sources) WHERE want > 0)),
drawn AS (
  SELECT p.*, nth, {signed("h")} AS draw
  FROM (SELECT *, {xxh64_of_long("nth", f"({xxh64_of_int('sid', f'({xxh64_of_int(str(SEED))})')})")} AS h
        FROM (SELECT *, unnest(range(n_slots)) AS nth FROM planned)) p),
slots AS (
  SELECT *, (row_number() OVER (ORDER BY draw, sid, nth) - 1) // {SHARD_SLOTS} AS shard,
         row_number() OVER (PARTITION BY sid ORDER BY draw, nth) - 1 AS k
  FROM drawn),
turns AS (
  SELECT *, greatest(1, ceil(sqrt(whole)))::BIGINT AS side, k // blocks AS pass, k % blocks AS i,
         (sid * 7919 + k // blocks * 104729 + {SEED * 15485863}) % {MODULUS} AS key,
         CASE WHEN k // blocks < passes THEN CASE WHEN k % blocks < whole THEN {BLOCK} ELSE tail END
              ELSE least({BLOCK}, rest - k % blocks * {BLOCK}) END AS words
  FROM slots),
walks AS (
  SELECT sid, k, whole, side, key, {_once_sql("i")} AS spot FROM turns WHERE i < whole
  UNION ALL SELECT sid, k, whole, side, key, {_once_sql("spot")} FROM walks WHERE spot >= whole),
used AS (
  SELECT t.sid, t.shard, t.words, coalesce(w.spot, t.whole) * {BLOCK} AS first
  FROM turns t LEFT JOIN walks w ON w.sid = t.sid AND w.k = t.k AND w.spot < w.whole),
placed AS (
  SELECT row, doc_id, size, sid, source_size, target,
         (sum(size) OVER (PARTITION BY sid ORDER BY bucket, doc_id NULLS FIRST, size, mark, row ROWS UNBOUNDED PRECEDING)
          - size)::BIGINT AS start
  FROM bucketed b JOIN sources s ON b.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       coalesce(sum(least(start + size, first + words) - greatest(start, first)) FILTER (first IS NOT NULL), 0)::BIGINT AS taken,
       count(DISTINCT shard) AS n_shards
FROM placed p LEFT JOIN used u ON u.sid = p.sid AND size > 0 AND first < start + size AND first + words > start
GROUP BY row, doc_id, size, source_size, target
"""
