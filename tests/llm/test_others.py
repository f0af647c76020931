from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F

from daygrain.llm import bpe, language_id, mixing, sharding, token_counts, warc
from daygrain.llm.common import stored
from llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# mixing


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight, with the excess over the cap shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= cap * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("block", [1, 7, 64, 1024])
def test_mix_meets_targets(edge_docs, documents, block):
    for docs in (edge_docs, documents):
        rows = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.select("doc_id", "source", "text").collect()]
        sizes = defaultdict(int)
        for _, source, n in rows:
            sizes[source] += n
        truth = targets(dict(sizes))
        got = mixing.words_taken(docs, block=block).collect()
        assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n) for i, _, n in rows)
        assert all(r["taken"] <= 3 * r["size"] for r in got)
        # Equal targets and sizes stand for the source here.
        taken, wanted = defaultdict(int), {(round(truth[s], 6), sizes[s]): 0 for s in sizes}
        for s in sizes:
            wanted[round(truth[s], 6), sizes[s]] += truth[s]
        for r in got:
            taken[round(r["target"], 6), r["source_size"]] += r["taken"]
        assert set(taken) == set(wanted)
        assert all(abs(taken[k] - wanted[k]) <= len(sizes) for k in wanted)


def test_mix_reruns_agree_however_the_input_is_split(edge_docs):
    runs = [Counter(tuple(r) for r in mixing.words_taken(edge_docs.repartition(n), block=5).collect()) for n in (1, 4)]
    assert runs[0] == runs[1]


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        df = spark.range(n).withColumn("n", F.lit(n).cast("long"))
        drawn = [r[0] for r in df.selectExpr(mixing.permuted("id", "n", "12345") + " AS p").collect()]
        assert sorted(drawn) == list(range(n)) and (n < 90 or drawn != sorted(drawn))


def test_permutations_of_any_size_cost_the_same(spark):
    """Steps per slot do not grow, and far places are still permuted without a clash."""
    for n in (4095, 4096, 10**6, 10**9, 10**11):
        df = spark.range(3000).withColumn("n", F.lit(n).cast("long"))
        drawn = [r[0] for r in df.selectExpr(mixing.permuted("id", "n", "777") + " AS p").collect()]
        assert len(set(drawn)) == 3000 and all(0 <= p < n for p in drawn)


def test_draw_reaches_the_result(edge_docs):
    plan = mixing.words_taken(edge_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "place" in plan and "shard" in plan
    _, sources = mixing.positions(stored(mixing.sized_rows(edge_docs, "doc_id", "text", "source", []), "sizes"), mixing.WEIGHTS, 3)
    block, shard_slots = 8, 16
    planned = {r["sid"]: r for r in mixing.planned_slots(sources, block).collect()}
    rows = mixing.slots(sources, block, 1, shard_slots).collect()
    # A plain replay: slots in the order of their places, each the next of its source.
    seen = Counter()
    for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])):
        k, p = seen[r["sid"]], planned[r["sid"]]
        assert r["pass"] == k // p["blocks"]
        last = r["pass"] == p["passes"]
        i = k % p["blocks"]
        assert r["length"] == (block if i < p["whole"] else p["tail"])
        assert r["words"] == (min(block, p["rest"] - i * block) if last else r["length"])
        assert (r["block"] == p["whole"]) == (i == p["whole"])
        seen[r["sid"]] += 1
    assert seen == Counter({s: p["n_slots"] for s, p in planned.items()})
    # Shards differ from one another as random draws do: neither all alike nor sorted by source.
    shards = defaultdict(Counter)
    for r in rows:
        shards[r["shard"]][r["sid"]] += 1
    full = [c for c in shards.values() if sum(c.values()) == shard_slots]
    big = max(planned, key=lambda s: planned[s]["n_slots"])
    share = planned[big]["n_slots"] / len(rows)
    counts = np.array([c[big] for c in full])
    assert len(full) > 20 and abs(counts.mean() - share * shard_slots) < 1.0
    spread = shard_slots * share * (1 - share)
    assert 0.4 * spread < counts.var() < 2.2 * spread


@pytest.mark.parametrize("block", [7, 1024])
def test_taken_equals_a_plain_count_over_blocks(edge_docs, block):
    """Every document's words and shards, from the slots and the layout of its source, one word at a time."""
    placed, sources = mixing.positions(stored(mixing.sized_rows(edge_docs, "doc_id", "text", "source", []), "sizes"), mixing.WEIGHTS, 3)
    slots = defaultdict(list)
    for r in mixing.slots(sources, block, mixing.SEED, mixing.SHARD_SLOTS).collect():
        slots[r["sid"], r["block"]].append((r["words"], r["shard"]))
    expected = Counter()
    layout = defaultdict(list)
    for r in placed.collect():
        uses = [s for at in range(r["start"], r["start"] + r["size"]) for w, s in slots[r["sid"], at // block] if at % block < w]
        expected[r["doc_id"], r["size"], len(uses), len(set(uses))] += 1
        layout[r["sid"]] += range(r["start"], r["start"] + r["size"])
    assert all(sorted(words) == list(range(len(words))) for words in layout.values())
    got = mixing.words_taken(edge_docs, block=block).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"], r["n_shards"]) for r in got) == expected


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    rows = [(None, f"text {i} of many", "s") for i in range(400)] + [(1, f"word {i}", "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    sized = stored(mixing.sized_rows(docs, "doc_id", "text", "source", []), "sizes")
    placed, _ = mixing.positions(sized, mixing.WEIGHTS, 3)
    assert "bucket" in placed._jdf.queryExecution().analyzed().toString()
    words = sorted(w for r in placed.collect() for w in range(r["start"], r["start"] + r["size"]))
    assert words == list(range(len(words)))
    buckets = sized.selectExpr("pmod(xxhash64(doc_id, mark), 8) AS b").groupBy("b").count().collect()
    assert max(r["count"] for r in buckets) < 200


def test_slots_fill_shards_without_gaps(edge_docs):
    _, sources = mixing.positions(stored(mixing.sized_rows(edge_docs, "doc_id", "text", "source", []), "sizes"), mixing.WEIGHTS, 3)
    rows = mixing.slots(sources, 16, 1, 8).collect()
    assert sorted(8 * r["shard"] + r["slot"] for r in rows) == list(range(len(rows)))
    assert len({(r["sid"], r["pass"], r["block"]) for r in rows}) == len(rows)


@pytest.mark.parametrize("block", [5, 1024])
def test_mixed_texts_hold_the_words_taken(edge_docs, block):
    mixed = mixing.mixed_documents(edge_docs, block=block)
    assert mixed.columns == edge_docs.columns and mixed.schema["n_chars"].dataType == edge_docs.schema["n_chars"].dataType
    held = Counter()
    for r in mixed.collect():
        held[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"]) and r["size"] == "other"
    taken = Counter()
    for r in mixing.words_taken(edge_docs, block=block).collect():
        taken[r["doc_id"]] += r["taken"]
    assert +held == +taken


def test_mix_of_nothing(no_docs, edge_docs):
    assert mixing.words_taken(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    blank = edge_docs.filter("doc_id in (4, 5, 6)")
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.words_taken(blank).collect()} == {(0, 0.0, 0)}
    assert mixing.mixed_documents(blank).count() == 0


# sharding


def plain_shards(rows, n, snap=0.02, overhead=16):
    """(id, shard, slot) of a sorted list that is cut at equal byte targets, or at the edge of a group nearby."""
    keyed = []
    for id, text in rows:
        digest = xxhash.xxh64_intdigest(text.encode(), 42)
        size = len(text.encode()) + overhead
        keyed.append(((digest - (1 << 64) if digest >> 63 else digest), (id is not None, id or 0), size, id))
    keyed.sort(key=lambda r: r[:3])
    ends, at = [], 0
    for r in keyed:
        at += r[2]
        ends.append(at)
    targets = [at * k // n for k in range(1, n)]
    spans = [(r[0], end - r[2], end) for r, end in zip(keyed, ends)]
    crossed = {d for d, first, last in spans if any(first < t < last for t in targets)}
    groups = [
        (min(first for e, first, _ in spans if e == d), max(last for e, _, last in spans if e == d)) for d in crossed
    ]
    cuts = []
    for target in targets:
        cut = target
        for first, last in groups:
            edge = min((first, last), key=lambda x: (abs(x - target), x))
            if first < target < last and abs(edge - target) <= snap * at / n:
                cut = edge
        cuts.append(2 * cut)
    found, slots = [], Counter()
    for r, end in zip(keyed, ends):
        shard = sum(c <= 2 * end - r[2] for c in cuts)
        found.append((r[3], r[2], shard, slots[shard]))
        slots[shard] += 1
    return Counter(found)


@pytest.mark.parametrize("n, snap", [(4, 0.02), (3, 0.5), (40, 0.02)])
def test_shards_equal_a_sorted_list(edge_docs, n, snap):
    rows = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect()]
    got = sharding.shard_by_bytes(edge_docs, n, snap=snap).collect()
    # Rows equal in id and text lie side by side in either order.
    assert Counter((r["id"], r["size"], r["shard"], r["slot"]) for r in got) == plain_shards(rows, n, snap)


def test_shards_are_contiguous_and_balanced(spark, documents, edge_docs):
    for docs, n in ((documents, 40), (documents, 3), (edge_docs, 4), (edge_docs, 1)):
        rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
        got = sharding.shard_by_bytes(docs, n).collect()
        assert Counter((r["id"], r["size"], r["text_crc32"]) for r in got) == Counter(
            (i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in rows
        )
        slots, size = defaultdict(list), Counter()
        for r in got:
            slots[r["shard"]].append(r["slot"])
            size[r["shard"]] += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        largest, target = max(r["size"] for r in got), sum(size.values()) / n
        assert all(abs(size[k] - target) <= largest + 2 * 0.02 * target + 1 for k in range(n))


def test_shards_do_not_depend_on_partitions(spark, documents):
    wide = Counter(tuple(r) for r in sharding.shard_by_bytes(documents.repartition(7)).collect())
    assert wide == Counter(tuple(r) for r in sharding.shard_by_bytes(documents.coalesce(1)).collect())


def test_shards_of_nothing_and_of_one_hot_text(spark, no_docs):
    assert sharding.shard_by_bytes(no_docs).count() == 0
    hot = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    sizes = Counter(r["shard"] for r in sharding.shard_by_bytes(hot, 8).collect())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 2


# tokens


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(bpe.RANKS))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=1500):
    draw = random.Random(4)
    alphabet = "aab ccd   \n\t\r'sté12.,!\x0b\x1c\x85 \xa0本İ🙂<|>"
    return ["".join(draw.choice(alphabet) for _ in range(draw.randrange(50))) for _ in range(n)] + [
        "", " ", "a" * 3000, " " * 2000, "ab" * 2000 + "  x", "\n" * 900, "<|endoftext|>", "don't we'll I'M", "\0 \0"
    ]


def test_bpe_matches_the_library(ranks, reference):
    texts = odd_texts()
    encoder = bpe.Encoder(ranks, bpe.Merges(ranks), public_tokenizers.PATTERN, memory=50)
    decoder = bpe.Decoder(ranks)
    for some in bpe.corpora(texts, 5000):
        for text, ids in zip(some, encoder.encode(some)):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
            assert decoder.decode(ids).decode() == text


def test_bpe_of_tables(documents, edge_docs, no_docs, ranks, reference):
    for docs in (documents, edge_docs, no_docs):
        truth = []
        for id, text in [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]:
            ids = reference.encode_ordinary(text)
            truth.append((id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert Counter(tuple(r) for r in bpe.encoded_digests(docs, ranks).collect()) == Counter(truth)
    with pytest.raises(ValueError, match="already"):
        bpe.encode_documents(edge_docs, ranks)
    packed = bpe.encode_documents(edge_docs, ranks, ids="packed")
    assert packed.columns == [*edge_docs.columns, "packed"]
    for text, decoded in packed.select("text", bpe.decoder(ranks)("packed")).collect():
        assert decoded.decode() == (text or "")


def test_counts_match_the_library(documents, edge_docs, no_docs):
    path = public_tokenizers.path(token_counts.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for docs in (documents, edge_docs, no_docs):
        truth = [(r["doc_id"], len((r["text"] or "").encode()), n := len(model.encode(r["text"] or "")), n > 4096)
                 for r in docs.select("doc_id", "text").collect()]
        assert Counter(tuple(r) for r in token_counts.count_tokens(docs, path).collect()) == Counter(truth)


@pytest.mark.parametrize("most", [1, 20, 300])
def test_split_texts_count_the_same(documents, most):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    assert token_counts.splittable(model)
    for text in odd_texts(400) + [t or "" for _, t, _, _ in ROWS] + [r["text"] for r in documents.limit(60).collect()]:
        pieces = token_counts.safe_pieces(text, most)
        assert sum(len(model.encode(p)) for p in pieces) == len(model.encode(text))


# WARC


def page_rows():
    big = "<p>" + "long page " * 20_000
    rows = [(i, f"http://h{i % 3}/p {i}", f"<html>{'x' * (i % 7)}{i % 11}</html>") for i in range(60)]
    rows += [(100, None, None), (101, "http://a/\r\nb", ""), (102, "u", big), (103, "u", big), (None, "u", "no id"), (None, "u", big)]
    return rows + [(104, "u", "twice"), (104, "u", "twice"), (105, "u", "one"), (105, "u", "two"), (-3, "u", "two")]


def warc_truth(rows, least=0):
    first = {}
    for id, _, html in rows:
        if id is not None:
            first[html or ""] = min(first.get(html or "", id), id)
    result, seen = Counter(), Counter()
    for id, _, html in rows:
        data = (html or "").encode()
        alone = sum((h or "") == (html or "") for _, _, h in rows) == 1 or len(data) < least
        lead = first.get(html or "")
        revisit = not alone and (id != lead or seen[id, html or ""] > 0)
        seen[id, html or ""] += 1
        result[id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
               "revisit" if revisit else "response", lead if revisit else None] += 1
    return result


@pytest.mark.parametrize("least, shard, roll", [(0, 1 << 20, 1 << 20), (20, 4000, 300), (0, 2000, 1)])
def test_warc_round_trip(spark, least, shard, roll):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, size int").repartition(3)
    folder = warc.shared_folder(spark, "warc-test")
    manifest = warc.write_archive(pages, folder, min_bytes=least, shard_bytes=shard, roll_bytes=roll)
    got = warc.read_archive(manifest, folder).collect()
    assert Counter(tuple(r) for r in got) == warc_truth(rows, least)


def test_warc_bytes_do_not_depend_on_partitions(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    seen = []
    for n in (1, 5):
        folder = warc.shared_folder(spark, "warc-test")
        names = sorted(r["file"] for r in warc.write_archive(pages.repartition(n), folder, shard_bytes=5000, roll_bytes=400).collect())
        seen.append({name: open(f"{folder.removeprefix('file://')}/{name}", "rb").read() for name in names})
    assert seen[0] == seen[1] and len(seen[0]) > 3
    order = []
    for name in sorted(seen[0]):
        with gzip.GzipFile(fileobj=io.BytesIO(seen[0][name])) as stream:
            order += [warc.page_of(h["warc-record-id"]) for h, _ in warc.read_records(stream)]
    assert [i for i in order if i is not None] == sorted(i for i in order if i is not None)


@pytest.mark.parametrize("most", [1, 3, 100])
def test_warc_ranges_are_few_and_keep_whole_keys_and_shards(spark, most):
    rows = sorted([(i, f"{i % 5}", 100 + i % 7) for i in range(200)] + [(90, "x", 300)] * 40 + [(warc.LAST, "n", 50)] * 30)
    heads = warc.ranges(spark.createDataFrame(rows, "id long, digest string, size long").repartition(5), 1000, most)
    assert len(heads) <= most and heads[0] == (0, "0", 0, 0)
    starts = {}
    offset = 0
    for id, digest, size in rows:
        starts.setdefault((id, digest), offset)
        offset += size
    assert all(starts[id, digest] == start for id, digest, start, _ in heads)
    shards = [set() for _ in heads]
    keys = [h[:2] for h in heads]
    offset = 0
    for id, digest, size in rows:
        at = max(n for n, key in enumerate(keys) if key <= (id, digest))
        shards[at].add(max(heads[at][3], offset // 1000))
        offset += size
    assert sum(map(len, shards)) == len(set().union(*shards))  # no shard is written by two tasks


def test_warc_refuses_a_changed_record():
    record = warc.make_record(1, "u", b"payload", None, False, 0)
    ((headers, block),) = warc.read_records(io.BytesIO(record))
    assert warc.read_back(headers, block)[:2] == (1, 7)
    with pytest.raises(ValueError, match="digest"):
        warc.read_back(headers, block[:-1] + b"?")


def test_warc_of_nothing(spark):
    folder = warc.shared_folder(spark, "warc-test")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(warc.write_archive(pages, folder), folder).count() == 0


# language


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    net = language_id.Network.fresh(["a", "b", "c"], 4)
    columns, truth = draw.integers(1, 6, (5, 7)), draw.integers(0, 3, 7)
    _, grads = language_id.gradients(net, columns, truth)
    for weight, grad in zip(net.weights(), grads):
        for _ in range(5):
            at = tuple(int(draw.integers(0, min(s, 6))) for s in weight.shape)
            own = weight[at]
            losses = []
            for step in (1e-2, -1e-2):
                weight[at] = own + step
                losses.append(language_id.gradients(net, columns, truth)[0])
            weight[at] = own
            slope = (losses[0] - losses[1]) / 2e-2
            assert abs(slope - grad[at]) <= 3e-3 + 0.06 * abs(slope)


def test_language_of_held_out_documents(documents):
    got = {r["id"]: r for r in language_id.predicted(documents).collect()}
    rows = documents.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if got[r["doc_id"]]["held_out"] and r["lang"]]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in tested)
    assert right >= 0.95 * len(tested) and all(0 <= r["score"] <= 1 for r in got.values())


def test_language_never_looks_at_the_label(documents):
    hidden = documents.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.col("lang")))
    assert Counter(tuple(r) for r in language_id.predicted(documents).collect()) == Counter(
        tuple(r) for r in language_id.predicted(hidden).collect()
    )


def test_language_edges(edge_docs, no_docs):
    got = Counter((r["id"], r["lang_pred"] == "und") for r in language_id.predicted(edge_docs).collect())
    letters = {id for id, text, _, _ in ROWS if any(c.isalpha() for c in text or "")}
    assert got == Counter((id, id not in letters) for id, _, _, _ in ROWS)
    assert language_id.predicted(no_docs).count() == 0
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {tuple(r) for r in language_id.predicted(unlabelled).select("lang_pred", "score").collect()} == {("und", 0.0)}
    left = language_id.recognised(edge_docs, min_score=0.0)
    assert left.columns == edge_docs.columns and left.count() == sum(id in letters for id, _, _, _ in ROWS)


def plain_shares(net, text):
    """Mean distribution over the bytes of a text, byte by byte in double precision."""
    data = text.replace("\0", " ").encode()
    data += b"\0" * (-len(data) % language_id.WINDOW)
    hidden, sums = net.recurrent[0].shape[1], np.zeros(len(net.languages))
    for at in range(0, len(data), language_id.WINDOW):
        window = data[at : at + language_id.WINDOW]
        states = [{}, {}]
        for way in (0, 1):
            inputs, own, state = net.inputs[way].astype(float), net.recurrent[way].astype(float), np.zeros(hidden)
            for t in range(len(window)) if way == 0 else reversed(range(len(window))):
                fed = inputs[:, window[t]]
                gate = np.clip(0.25 * (fed[: 2 * hidden] + own[: 2 * hidden] @ state) + 0.5, 0, 1)
                new = fed[2 * hidden :] + gate[hidden:] * (own[2 * hidden :] @ state)
                state = state + gate[:hidden] * (new / (1 + abs(new)) - state)
                states[way][t] = state
        for t, byte in enumerate(window):
            if byte:
                score = net.output.astype(float) @ np.concatenate([states[0][t], states[1][t]]) + net.bias
                share = np.exp(score - score.max())
                sums += share / share.sum()
    return sums / sums.sum()


def test_language_equals_a_plain_pass_over_the_bytes(edge_docs):
    net = language_id.train(language_id.training_sample(edge_docs, "doc_id", "text", "lang"))
    got = Counter()
    for r in language_id.predicted(edge_docs.filter("length(text) < 2000 OR text IS NULL")).collect():
        got[r["id"], r["lang_pred"], round(r["score"], 3)] += 1
    expected = Counter()
    for id, text, _, _ in ROWS:
        if text is not None and len(text) >= 2000:
            continue
        if not any(c.isalpha() for c in text or ""):
            expected[id, "und", 0.0] += 1
            continue
        shares = plain_shares(net, text)
        expected[id, net.languages[shares.argmax()], round(float(shares.max()), 3)] += 1
    assert sum(got.values()) == sum(expected.values()) and sum((got - expected).values()) <= 1  # a rounding apart


def test_every_byte_gets_a_label():
    net = language_id.train([("de", "der die das und ist " * 30), ("fr", "le la les et est une " * 30)], steps=30)
    assert net.languages == ["de", "fr"]
    text = "die und das " * 40
    labels = language_id.label_positions(net, text)
    assert len(labels) == len(text.encode()) and labels.count("de") > 0.8 * len(labels)
    assert language_id.label_positions(net, "") == []
    pooled = language_id.pooled(net, [text, "", "la les et une " * 400])
    assert pooled.argmax(1)[[0, 2]].tolist() == [0, 1] and pooled[1].sum() == 0
