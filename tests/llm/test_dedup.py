from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm.conftest import LONG, PASSAGE, ROWS, smallest_reachable
from daygrain.llm import embedding_dedup, exact_dedup, graph, simhash, substring_dedup


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# exact


def exact_truth(rows):
    groups = defaultdict(list)
    for id, text in rows:
        groups[lowered(text)].append(id)
    result = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for n, id in enumerate(sorted(ids, key=lambda x: (x is not None, x), reverse=True)):
            result.append((id, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(result)


@pytest.mark.parametrize("support", [0.001, 0.06, 0.5])
def test_exact_labels_match_brute_force(edge_docs, support):
    got = exact_dedup.label_duplicates(edge_docs, support=support).withColumn("digest", F.lower(F.hex("digest")))
    rows = [tuple(r) for r in got.select("id", "keep_id", "group_size", "kept", "digest").collect()]
    assert Counter(rows) == exact_truth([(i, t) for i, t, _, _ in ROWS])


def test_exact_survivors_keep_their_columns(edge_docs):
    for support in (0.001, 0.06):
        left = exact_dedup.drop_duplicates(edge_docs, support=support)
        assert left.columns == edge_docs.columns
        kept = {k for k in exact_truth([(i, t) for i, t, _, _ in ROWS]) if k[3]}
        assert Counter((r["doc_id"], hashlib.sha256(lowered(r["text"]).encode()).hexdigest()) for r in left.collect()) == Counter(
            (k[0], k[4]) for k in kept
        )
        assert {r["digest"] for r in left.select("digest").collect()} == {"other"}


def test_exact_heavy_digests_are_found_and_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    slim = docs.select(F.col("doc_id").alias("id"), exact_dedup.text_digest(F.col("text")).alias("digest"), F.col("doc_id").alias("row"))
    heavy = exact_dedup.heavy_digests(slim, 0.01).collect()
    assert [(r["group_size"], r["keep_id"]) for r in heavy] == [(1000, 2997)]


def test_exact_empty(no_docs):
    assert exact_dedup.label_duplicates(no_docs).count() == 0
    assert exact_dedup.drop_duplicates(no_docs).count() == 0


# components


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 400)] + [(100, 100), (101, 100)]
    edges = spark.createDataFrame([*chain, *star, (900, 500)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 400)}, 500: 500, 900: 500}
    assert graph.components(edges.limit(0)).count() == 0


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_plain_code(spark, edge_docs, documents):
    texts = [t for _, t, _, _ in ROWS] + [r["text"] for r in documents.limit(40).collect()]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    # The hash is also the one Spark computes.
    assert spark.range(1).select(F.xxhash64(F.lit("été à la"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("été à la".encode(), 42)


def near(fps, bits=3):
    return [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= bits]


def test_simhash_matches_brute_force(edge_docs, documents):
    for docs in (edge_docs, documents):
        rows = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
        truth = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
        least = smallest_reachable([t[0] for t in truth], near([t[1] for t in truth]))
        assert Counter((i, fp % 2**64, c) for i, fp, c in rows) == Counter((i, fp, c) for (i, fp), c in zip(truth, least))


@pytest.mark.parametrize("hot, giant", [(64, 20_000), (2, 20_000), (2, 3), (0, 0)])
def test_simhash_buckets_lose_no_link(spark, hot, giant):
    draw = np.random.default_rng(5)
    fps = {0}
    for centre in draw.integers(0, 1 << 63, 12).tolist():
        for _ in range(40):
            flips = draw.choice(64, draw.integers(0, 5), replace=False).tolist()
            fps.add(centre ^ sum(1 << b for b in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), hot=hot, giant=giant)
    found = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert [found.get(f, f) for f in signed] == smallest_reachable(signed, near(fps))
    for a, b in edges.distinct().collect():
        assert found[a] == found[b]


def test_simhash_keeps_one_of_each_group(edge_docs):
    left = simhash.keep_one(edge_docs)
    assert left.columns == edge_docs.columns
    rows = simhash.near_duplicates(edge_docs).collect()
    assert {r["doc_id"] for r in left.collect()} == {r["component"] for r in rows}


def test_simhash_keeps_one_where_ids_repeat_or_are_missing(spark):
    one, two = "a b c d e f g", "h i j k l m n o"
    rows = [(1, one), (1, one), (1, one.upper()), (2, one), (1, two), (0, two), (None, one), (None, "p q r s"),
            (None, "p q r s"), (None, "t u v w"), (3, None), (4, ""), (None, " ")]
    left = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(left) == 5
    assert {(r["doc_id"], (r["text"] or "").lower()) for r in left} == {
        (1, one), (0, two), (None, "p q r s"), (None, "t u v w"), (3, "")}


def test_simhash_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


# embeddings


def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for centre in draw.normal(size=(30, 8)):
        for _ in range(12):
            rows.append((centre + draw.normal(scale=draw.uniform(0, 0.4), size=8)).astype(np.float32).tolist())
    rows += [rows[0]] * 40 + [[x * 7 for x in rows[1]]]
    rows += [None, [], [0.0] * 8, [1.0] * 7 + [float("nan")], [float("inf")] + [1.0] * 7, [1.0, None] + [1.0] * 6]
    rows += [[1.0, 2.0, 3.0], [1.0, 2.0, 3.01], [1e38] * 8, [1e-38] * 8]
    return rows


def vector_truth(rows, ids, cosine=0.95):
    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float32).astype(float) if sound(v) else None for v in rows]
    unit = [None if u is None else u / np.abs(u).max() for u in unit]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine
    ]
    n = Counter(x for p in pairs for x in p)
    return [(id, n[k], c) for k, (id, c) in enumerate(zip(ids, smallest_reachable(ids, pairs)))]


@pytest.mark.parametrize("block, most", [(4096, 2048), (64, 2048), (16, 2048), (64, 3)])
def test_embeddings_match_brute_force(spark, block, most):
    rows = vectors()
    ids = list(range(len(rows) - 2)) + [0, None]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, rows)], "vec_id long, embedding array<float>, label int, hash string")
    got = [tuple(r) for r in embedding_dedup.near_duplicates(df.repartition(4), block=block, most=most).collect()]
    assert Counter(got) == Counter(vector_truth(rows, ids))


@pytest.mark.parametrize("dense", [False, True])
def test_near_pairs_are_those_of_double_precision(dense):
    draw = np.random.default_rng(5)
    rows = draw.normal(size=(400, 24)) * (0.2 if dense else 1.0) + (1.0 if dense else 0.0)
    rows = np.concatenate([rows, rows[:50] + draw.normal(scale=0.05, size=(50, 24))])
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    for cosine in [0.95, 0.999, *(rows[:50] * rows[400:]).sum(1)]:  # also cuts that pairs lie on
        single = rows.astype(np.float32)
        got = embedding_dedup.near_pairs(rows[:225], rows[225:], cosine, (single[:225], single[225:]))
        away = np.abs(rows[:225] @ rows[225:].T - cosine) > 1e-12
        assert (got == (rows[:225] @ rows[225:].T >= cosine))[away].all()


def test_embeddings_of_the_table(spark, data_dir):
    df = spark.read.parquet(f"{data_dir}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    got = [tuple(r) for r in embedding_dedup.near_duplicates(df).collect()]
    assert Counter(got) == Counter(vector_truth([r["embedding"] for r in rows], [r["vec_id"] for r in rows]))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


# substrings


def substring_truth(rows, min_words=20):
    """Removed spans by plain code; rows are (id, text), rows that repeat both count once."""
    units = {}
    for id, text in set(rows):
        units[id, text] = [
            (m.start(), m.end(), " ".join(m.group().lower().split()))
            for m in re.finditer(r"(?:[^.!?\n]|[.!?]+(?=[^\s.!?]))*(?:[.!?]+(?=\s|$)|\n|$)\s*", text or "")
            if m.group().strip()
        ]
    first = {}
    for (id, text), found in units.items():
        for pos, (_, _, unit) in enumerate(found):
            rank = (id is None, id or 0)
            first[unit] = min(first.get(unit, (rank,)), (rank,))
    result = {}
    for (id, text), found in units.items():
        seen, spans, run = set(), [], []
        for head, tail, unit in [*found, (0, 0, None)]:
            keeper = unit is None or (first[unit] == ((id is None, id or 0),) and unit not in seen)
            seen.add(unit)
            if keeper:
                if sum(len(u.split()) for _, _, u in run) >= min_words:
                    spans.append((run[0][0], run[-1][1]))
                run = []
            else:
                run.append((head, tail, unit))
        result[id, text] = spans
    return result


def test_substrings_remove_later_passages(edge_docs):
    got = {r["id"]: r for r in substring_dedup.repeated_passages(edge_docs).collect()}
    assert got[14]["removed"] == []
    (span,) = got[15]["removed"]
    text = dict((i, t) for i, t, _, _ in ROWS)[15]
    assert text[span["head"] : span["tail"]] == PASSAGE + "\n" and span["keep_id"] == 14
    assert len(got[7]["removed"]) == 1 and got[7]["removed_chars"] > 0.99 * len(LONG)
    assert got[4]["n_units"] == got[5]["n_units"] == got[6]["n_units"] == 0
    clean = {r["doc_id"]: r["text"] for r in substring_dedup.cleaned(edge_docs).collect()}
    assert clean[15] == "Another start here.\nAnother end." and clean[14] == dict((i, t) for i, t, _, _ in ROWS)[14]
    assert substring_dedup.cleaned(edge_docs).columns == edge_docs.columns
    assert substring_dedup.cleaned(edge_docs).count() == len(ROWS)


def test_substrings_match_plain_code(edge_docs, documents):
    for docs in (documents, edge_docs.filter("doc_id is null or doc_id not in (12)")):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        truth = Counter((id, tuple(spans)) for (id, text) in rows for spans in [substring_truth(rows)[id, text]]) if len(rows) < 30 else None
        known = substring_truth(rows)
        truth = Counter((id, tuple(known[id, text])) for id, text in rows)
        got = Counter(
            (r["id"], tuple((s["head"], s["tail"]) for s in r["removed"])) for r in substring_dedup.repeated_passages(docs).collect()
        )
        assert got == truth


def test_a_hot_line_is_split(spark):
    """The join with the counts of units is split by adaptive execution where one unit is frequent."""
    hot = "this line stands in every document of the table. "
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat(repeat('{hot}', 4), 'line ', id, ' stands here. and ', id, ' there.') AS text")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = substring_dedup.repeats(substring_dedup.found_units(docs.repartition(20)).filter("pos >= 0"))
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 4 * 3000 - 1 and {r["keep_id"] for r in rows} == {0}


def test_units_tile_every_text(documents):
    for text in [t or "" for _, t, _, _ in ROWS] + [r["text"] for r in documents.select("text").collect()]:
        assert "".join(m.group() for m in substring_dedup.UNIT.finditer(text)) == text


def test_substrings_empty(no_docs):
    assert substring_dedup.repeated_passages(no_docs).count() == 0
    assert substring_dedup.cleaned(no_docs).count() == 0
