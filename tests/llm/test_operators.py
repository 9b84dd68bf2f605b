"""The corpus operators against brute force, exact round trips, public libraries and held-out labels."""

import base64
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark.llm import bpe, decontaminate, graph, hamming_topk, language_id, order_minhash, pii, quality_fm, queries, sharding, token_store, toxicity
from reelspark.llm.arrow_text import HashIndex, span_hashes, text_bytes

SF = "/root/testdata/sf0.001"
RANKS, TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'t", "'re", "'ve", "'ll", "'", "'S", " ", "  ", "\n", "\t", "　", "a", "é", "S", "re", "1", "½", "!", "..", "日", "😀", "\x1c", "\x85", "<|endoftext|>"]
#: Rows that every operator has to take: nulls, empty, wordless and long texts, repeated rows, clashing names.
EDGE = [(1, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, "!!! ..."), (5, "word " * 30000), (6, "one two three four five six seven eight nine ten"), (6, "one two three four five six seven eight nine ten"), (None, "one two"), (8, "x")]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "en", "src", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def texts(number, longest=30, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, longest))) for _ in range(number)]


def tiktoken_encoding():
    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- helpers


def test_hash_index_and_span_hashes():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 60, 5000))
    index = HashIndex()
    for part in np.array_split(keys, 7):
        index.add(part, part % 1000)
    assert (index.find(keys) == keys % 1000).all() and (index.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()
    raw = np.frombuffer(b"abc abc abd", np.uint8)
    a, b, c = span_hashes(raw, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert a == b != c


def test_components_against_union_find(spark):
    pick = random.Random(3)
    edges = [(pick.randint(0, 60), pick.randint(0, 60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)] + [(None, 5), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}


# --- 1


@pytest.mark.parametrize("bits", [7, 64, 100])
def test_topk_against_all_pairs(spark, bits):
    random_bits = np.random.default_rng(bits)
    base = random_bits.normal(size=(400, bits))
    base[100:200] = base[100] + random_bits.normal(0, 0.2, (100, bits))
    base[200:260] = base[200]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(base)] + [(7, [float(x) for x in base[7]]), (900, None), (901, []), (None, [1.0] * bits)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): (r.neighbour_id, r.distance) for r in hamming_topk.search(df, df.where("vec_id % 50 = 0"), k=5).collect()}
    sign = base > 0
    for q in range(0, 400, 50):
        best = sorted((int((sign[q] != sign[i]).sum()), i) for i in range(400))[:5]
        assert [got[q, r + 1] for r in range(5)] == [(i, d) for d, i in best]
    assert len(got) == 40


def test_topk_of_empty_and_small_tables(spark):
    df = spark.createDataFrame([(1, [1.0, -1.0]), (2, [1.0, float("nan")])], "vec_id long, embedding array<float>")
    assert hamming_topk.search(df.where("false"), df.where("false")).count() == 0
    assert [(r.neighbour_id, r.distance) for r in hamming_topk.search(df, df.where("vec_id = 2")).orderBy("rank").collect()] == [(1, 0), (2, 0)]


# --- 2


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_contamination(docs, items, width=decontaminate.WINDOW):
    out = {}
    for number, (_, text) in enumerate(docs):
        words, hit, found = words_of(text), set(), set()
        for item, own in items:
            test = words_of(own)
            for window in {tuple(test[k : k + width]) for k in range(max(len(test) - width + 1, 1))} if test else ():
                for k in range(len(words) - len(window) + 1):
                    if tuple(words[k : k + len(window)]) == window:
                        hit |= set(range(k, k + len(window)))
                        found.add(str(item))
        out[number] = (len(words), len(hit), sorted(found))
    return out


def sentences(pick, number):
    return " ".join(pick.choice(["Alpha", "beta", "gamma,", "Größe", "x1", "the"]) for _ in range(number))


@pytest.mark.parametrize("parts", [10**6, 30])
def test_contamination_against_brute_force(spark, parts):
    pick = random.Random(5)
    items = [(k, sentences(pick, pick.choice([0, 1, 4, 12, 15]))) for k in range(12)] + [(50, None), (51, "the"), (12, "Alpha beta gamma the x1 beta Größe the the Alpha beta")]
    docs = [(k, sentences(pick, pick.randint(0, 60))) for k in range(40)] + [(100 + k, sentences(pick, 5) + " " + (items[k][1] or "") + " the") for k in range(12)]
    docs += [(200, None), (201, ""), (202, "alpha BETA gamma the x1 beta größe the the alpha beta"), (203, "?!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(decontaminate.build_index(docs_of(spark, docs)), bench, max_test_words=parts)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()}
    want = brute_contamination(docs, items)
    assert got == {docs[n][0]: v for n, v in want.items()}
    marked = {r.doc_id: r.contaminated for r in decontaminate.mark(docs_of(spark, docs), bench, max_test_words=parts).collect()}
    assert marked == {docs[n][0]: v[1] > 0 for n, v in want.items()}


def test_phrases_and_proximity(spark):
    docs = [(1, "a b c d e f"), (2, "c b a x x x a"), (3, "a x x x b x x x c"), (4, "b c")]
    bench = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    index = decontaminate.build_index(docs_of(spark, docs))
    assert [(r.doc_id, r.start) for r in decontaminate.find(index, bench).collect()] == [(1, 0)]
    for span in (3, 5, 9):
        got = {(r.doc_id, r.start) for r in decontaminate.find(index, bench, span=span).collect()}
        want = {(n, s) for n, t in docs for s in range(len(t.split())) if {"a", "b", "c"} <= set(t.split()[s : s + span])}
        assert got == want


def test_contamination_of_edge_rows(spark):
    bench = spark.createDataFrame([(1, "three four")], "item_id long, text string")
    rows = decontaminate.contamination(decontaminate.build_index(docs_of(spark, EDGE)), bench).collect()
    assert len(rows) == len(EDGE) and sum(r.contaminated for r in rows) == 3
    empty = decontaminate.contamination(decontaminate.build_index(docs_of(spark, EDGE)), bench.where("false")).collect()
    assert not any(r.contaminated for r in empty)
    assert decontaminate.contamination(decontaminate.build_index(docs_of(spark, EDGE).where("false")), bench).count() == 0


@pytest.mark.parametrize("parts", [10**6, 2])
def test_items_without_an_id_are_searched_for(spark, parts):
    bench = spark.createDataFrame([(None, "three four"), (None, "nine ten"), (7, "one two three"), (None, None)], "item_id long, text string")
    docs = docs_of(spark, [(1, "one two three four"), (2, "eight nine ten"), (3, "four three"), (4, "three four five nine ten")])
    found = decontaminate.contamination(decontaminate.build_index(docs), bench, max_test_words=parts)
    got = {r.doc_id: (r.n_hit, r["items"], r.contaminated) for r in found.collect()}
    assert got == {1: (4, ["7", None], True), 2: (2, [None], True), 3: (0, [], False), 4: (4, [None], True)}
    assert {r.doc_id for r in decontaminate.mark(docs, bench, max_test_words=parts).collect() if r.contaminated} == {1, 2, 4}
    assert decontaminate.find(decontaminate.build_index(docs), bench, max_test_words=parts).where("item_id IS NULL").count() == 4


def test_op2_equals_its_sql_with_null_item_ids(spark, tmp_path):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bench.withColumn("item_id", F.when(F.col("item_id") % 3 != 0, F.col("item_id"))).write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op2_decontaminate"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.execute(decontaminate.OP2_SQL).df()
    as_rows = lambda df: sorted(map(tuple, df[sorted(want.columns)].astype(str).values))
    assert as_rows(got) == as_rows(want) and want.n_hit.gt(0).sum() > 1


@pytest.mark.parametrize("parts", [10**6, 2])
def test_contamination_of_blocks_from_many_partitions(spark, parts):
    bench = spark.createDataFrame([(1, "three four"), (2, "seven eight nine")], "item_id long, text string")
    index = decontaminate.build_index(docs_of(spark, EDGE))
    read = lambda blocks: sorted(map(str, decontaminate.contamination(blocks, bench, max_test_words=parts).collect()))
    far = index.withColumn("block", F.col("block") + F.lit(200 << 32))
    assert far.where(f"block >= {200 << 32}").count() > 0
    assert read(far) == read(index) and len(read(far)) == len(EDGE)


# --- 3


def test_bpe_equals_tiktoken(spark):
    import tiktoken  # noqa: F401

    rows = [(k, t) for k, t in enumerate([*texts(400), "x" * 3000, "=" * 2000 + " ab" * 10, " " * 500])]
    done = bpe.decode(bpe.encode(docs_of(spark, rows), RANKS), RANKS).collect()
    encoding = tiktoken_encoding()
    for r in done:
        want = encoding.encode_ordinary(r.text)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == r.text.encode()
        size = [len(encoding.decode_single_token_bytes(x)) for x in want]
        assert np.frombuffer(r.offsets, "<u4").tolist() == np.cumsum([0, *size])[:-1].tolist()[: len(want)]


def test_round_trip_is_both_steps_in_one_worker(spark):
    docs = docs_of(spark, [*enumerate([*texts(60), None, "", "y" * 2000]), (None, "a b"), (3, "again")])
    whole, steps = bpe.round_trip(docs, RANKS), bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert whole.schema == steps.schema
    assert sorted(map(str, whole.collect())) == sorted(map(str, steps.collect()))
    # Two in one stage would be two Python workers a core, with a vocabulary and a cache each.
    for done in (whole, bpe.digests(docs, RANKS), corpus_pipeline.tokens(spark, docs, "")):
        assert done._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_bpe_classes_of_all_code_points():
    encoder, encoding = bpe.encoder(bpe.read_ranks(RANKS)), tiktoken_encoding()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    rows = [f"a{c}a 1{c}1 {c}" for c in points]
    ids, before = encoder.encode(*text_bytes(pa.array(rows)))
    assert all(ids[before[k] : before[k + 1]].tolist() == encoding.encode_ordinary(t) for k, t in enumerate(rows))


def test_bpe_of_edge_rows(spark):
    rows = bpe.digests(docs_of(spark, EDGE), RANKS).collect()
    assert len(rows) == len(EDGE) and {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert {r.decoded_sha256 for r in rows if r.doc_id == 2} == {hashlib.sha256(b"").hexdigest()}
    assert bpe.digests(docs_of(spark, EDGE).where("false"), RANKS).count() == 0


# --- 4, 6


def held_out_share(rows, labels, column):
    own = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert own
    return sum(p == y for p, y in own) / len(own)


@pytest.mark.parametrize("name, column, parts, fold, least", [("op4_quality_fm", "quality", 5, 0, 0.9), ("op6_toxicity", "toxic", 3, 1, 0.88)])
def test_classifiers_on_the_held_out_fold(spark, name, column, parts, fold, least):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, sf).collect()
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == fold) and 0 <= r.score <= 1 for r in rows)
    assert held_out_share(rows, labels, column) >= least


def test_machine_sums_all_pairs_in_linear_time():
    random_ = np.random.default_rng(0)
    rows = quality_fm.read_rows(pa.array(["Good words here, and more words.", None, "", "BAD!! BAD!! BAD!!"]))
    size = quality_fm.WORD_BUCKETS + quality_fm.STATISTICS * quality_fm.INTERVALS
    machine = quality_fm.Machine(np.zeros((quality_fm.STATISTICS, quality_fm.INTERVALS - 1)), 0.3, random_.normal(size=size), random_.normal(0, 0.1, (size, quality_fm.FACTORS)))
    row, feature, value = machine.features(rows)
    odds, _ = machine.odds(4, row, feature, value)
    for k in range(4):
        own = np.flatnonzero(row == k)
        pairs = sum(machine.vector[feature[i]] @ machine.vector[feature[j]] * value[i] * value[j] for n, i in enumerate(own) for j in own[:n])
        assert odds[k] == pytest.approx(0.3 + machine.weight[feature[own]] @ value[own] + pairs)


@pytest.mark.parametrize("module", [quality_fm, toxicity])
def test_classifiers_take_edge_rows(spark, module):
    labelled = spark.createDataFrame([("fine text here", 1), (None, 0), ("", 1), ("you idiot", 0)], "text string, label int")
    for some in (labelled, labelled.where("false"), labelled.where("label = 1")):
        rows = module.score(docs_of(spark, EDGE).withColumn("Score", F.lit("x")), module.train(some)).collect()
        assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)


def test_label_model_trusts_voters_that_agree():
    random_ = np.random.default_rng(1)
    truth = random_.random(4000) < 0.2
    ballots = np.column_stack([np.where(truth, random_.random(4000) < 0.7, random_.random(4000) < 0.02) for _ in range(4)]).astype(float)
    ballots = np.column_stack([ballots, ballots[:, 0], random_.random(4000) < 0.3]).astype(float)
    found = toxicity.label_model(ballots) > 0.5
    assert (found == truth).mean() > 0.97


def test_label_model_over_all_documents_equals_the_one_in_memory(spark):
    pick = random.Random(16)
    words = ["idiot", "scum", "trash", "moron", "a", "b", "c", "d"]
    texts_ = [" ".join(pick.choices(words, [8, 8, 8, 8, 1, 1, 1, 1] if k % 9 == 0 else [0.2, 0.1, 0.1, 0.1, 9, 9, 9, 9], k=pick.randint(0, 12))) for k in range(900)] + [None, "", "IDIOT!!!! " * 9]
    lexicon = np.unique(toxicity._whole_words())
    model, many, few = toxicity.fit_label_model(docs_of(spark, [*enumerate(texts_)]).repartition(5), lexicon)
    row, bucket = toxicity.text_features(pa.array(texts_))
    of, voter = toxicity.voted(row, bucket, lexicon)
    votes = toxicity.ballots(np.searchsorted(of, np.arange(len(texts_) + 1)), voter, len(lexicon) + 2)
    assert many == (votes.sum(axis=1) > 0).sum() and many + few == len(texts_)
    assert np.allclose(model.posterior(votes), toxicity.label_model(votes), atol=1e-6)
    # by hand: one round
    start = toxicity.first_posterior(votes)
    one = toxicity.LabelModel.of(len(votes), votes.T @ votes, start.sum(), start @ votes, votes.sum(axis=0))
    mean_t, mean_c = (start @ votes) / start.sum(), ((1 - start) @ votes) / (1 - start).sum()
    within = sum(p * np.outer(v - mean_t, v - mean_t) + (1 - p) * np.outer(v - mean_c, v - mean_c) for p, v in zip(start, votes, strict=True)) / len(votes)
    there = np.flatnonzero(votes.any(axis=0))
    alike = within[np.ix_(there, there)] / np.sqrt(np.outer(np.diag(within)[there], np.diag(within)[there]))
    hit_t, hit_c = (start @ votes + 0.5) / (start.sum() + 1), ((1 - start) @ votes + 0.5) / ((1 - start).sum() + 1)
    evidence = (np.log(hit_t / hit_c) - np.log((1 - hit_t) / (1 - hit_c)))[there] / (alike**2).sum(axis=1)
    assert np.allclose(one.weight[there], evidence)


def test_toxicity_finds_words_that_no_label_shows(spark):
    """A stem that labelled rows show in a few forms is found in others, and unlabelled texts count."""
    rows = queries.QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").select("doc_id", "predicted")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = {(r.toxic, r.predicted): r["count"] for r in rows.join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert found[1, 1] / (found[1, 1] + found[1, 0]) >= 0.85 and found.get((0, 1), 0) <= 3


def test_labelled_rows_are_bounded_whatever_an_id_holds(spark):
    from reelspark.llm import labelled
    docs = docs_of(spark, [(1, f"text {k}") for k in range(3000)] + [(2, "other")] * 5)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    for most in (10, 4000):
        got = labelled.sample(docs, labels, "quality", F.lit(True), most).collect()
        assert len(got) == min(most, 3001) and len(set(got)) == len(got)


# --- 5


def test_lookup_table_shares_and_stability():
    names = sharding.shard_names(50)
    full, less = sharding.fill(names), sharding.fill(names[:-1])
    count = np.bincount(full)
    assert count.max() - count.min() <= 1
    moved = sum(names[a] != names[b] for a, b in zip(full, less, strict=True) if a != 49)
    assert moved / len(full) < 0.1
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 100)


def test_placement_keeps_rows_and_takes_nulls(spark):
    df = docs_of(spark, EDGE).withColumn("Shard", F.lit(1))
    rows = sharding.place(df, ["doc_id"], sharding.shard_names()).collect()
    assert len(rows) == len(EDGE) and all(r.shard.startswith("shard-") for r in rows)
    assert len({r.slot for r in rows if r.doc_id == 6}) == 1
    assert sharding.place(df.where("false"), ["doc_id"], sharding.shard_names()).count() == 0
    plan = sharding.place(df, ["doc_id"], sharding.shard_names())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hashpartitioning" not in plan


# --- 7


@pytest.mark.parametrize("number", [1, 7, 1024, 1025, 40_000])
def test_coder_round_trip(number):
    random_ = np.random.default_rng(number)
    for ids in (random_.integers(0, 50257, number), random_.zipf(1.3, number) % 50257, np.zeros(number, np.int64), np.tile(np.arange(50), number)[:number]):
        words, size = token_store.encode_blocks(ids)
        assert (token_store.decode_blocks(words, size, number) == ids).all()
    assert words.nbytes < number * 2 + 4096


def test_coder_shares_its_models_among_the_lanes():
    random_ = np.random.default_rng(3)
    phrases = random_.integers(256, 50257, (300, 8))
    ids = phrases[random_.integers(0, 300, 8000)].ravel()  # a block holds fewer than half of them
    words, size = token_store.encode_blocks(ids)
    assert len(size) == -(-len(ids) // token_store.BLOCK) and (token_store.decode_blocks(words, size, len(ids)) == ids).all()
    assert words.nbytes < len(ids)


@pytest.mark.parametrize("lanes", [1, 3, 70])
def test_coder_takes_every_id_and_carries(lanes):
    random_ = np.random.default_rng(lanes)
    number = lanes * token_store.BLOCK - 5
    often = np.where(random_.random(number) < 0.97, 50256, random_.integers(0, 1 << 17, number))
    for ids in (random_.integers(0, 1 << 17, number), np.full(number, (1 << 17) - 1), np.arange(number) % (1 << 17), often, np.sort(often)):
        words, size = token_store.encode_blocks(ids)
        assert words.dtype == np.uint16 and size.sum() == len(words)
        assert (token_store.decode_blocks(words, size, number) == ids).all()


def test_pieces_go_to_the_library_in_runs_and_come_back_apart():
    from tokenizers import Tokenizer

    with open(TOKENIZER, encoding="utf-8") as file:
        own = token_store.LibraryEncoder(file.read(), False)
    library = Tokenizer.from_file(TOKENIZER)
    pieces = list(dict.fromkeys([" \u00e9t\u00e9", "\u4e2d\u6587", "\U0001f600\U0001f600", "'s", "   ", "\n\n", "\x00", "12345678901", *(f" w{k:x}" for k in range(3 * token_store.RUN))]))
    runs = []
    own.tokenizer = type("Counted", (), {"encode_batch_fast": lambda _, texts, **how: runs.append(len(texts)) or library.encode_batch_fast(texts, **how)})()
    ids, count = own.merge([p.encode() for p in pieces])
    assert runs == [-(-len(pieces) // token_store.RUN)]
    ends = np.cumsum(count)
    assert [ids[b - n : b].tolist() for b, n in zip(ends.tolist(), count.tolist(), strict=True)] == [library.encode(p).ids for p in pieces]
    own.bytes_of = own.bytes_of + 1  # as if ids did not stand for their own bytes
    again, each = own.merge([p.encode() for p in pieces])
    assert (again == ids).all() and (each == count).all()


def test_full_piece_cache_keeps_what_was_met_again():
    class Cache(bpe.PieceCache):
        room = 50
        asked: list = []

        def merge(self, pieces):
            self.asked += pieces
            return np.array([x for p in pieces for x in p], np.int64), np.array([len(p) for p in pieces])

    own = Cache()
    for k in range(40):
        texts_ = [f"often again x{k}a y{k}b", "", f"often z{k}c", "often" * 3 + f"é{k}"]
        raw = [t.encode() for t in texts_]
        ids, before = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)] == [list(r) for r in raw]
        assert own.held <= 50 + 20
    assert own.asked.count(b"often") == 1 and own.asked.count(b" again") == 1
    own.again[: own.held] = True
    own.room = own.held - 1
    own._forget()
    assert own.held == 0


def test_store_equals_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [(3 * k % 997, t) for k, t in enumerate(texts(300))] + [r for r in EDGE if r[0] is None or r[0] > 0]
    path = str(tmp_path / "store")
    token_store.write(docs_of(spark, rows).repartition(5), TOKENIZER, path)
    got = token_store.read(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    start = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert len(got) == len(ordered)
    for r, (doc_id, text) in zip(got, ordered, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(want))
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        start += len(want)


def test_store_equals_the_untouched_library(spark, tmp_path):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    rows = [(k, t) for k, t in enumerate([f"end {end} next", end, f"{end}{end}", f"  {end}  ", f"a{end}b", "plain text", "<|endof", None, f"{end} x", "", *texts(300, seed=7)])]
    assert sum(end in (t or "") for _, t in rows) > 50 and sum(end not in (t or "") for _, t in rows) > 50
    docs_of(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(TOKENIZER)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op7_token_store"](spark, str(tmp_path)).collect()}
    start = 0
    for doc_id, text in rows:
        want = library.encode(text or "", add_special_tokens=False).ids + [token_store.END_ID]
        assert got[doc_id] == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes())), text
        start += len(want)
    assert library.encode(rows[0][1], add_special_tokens=False).ids == [437, 220, 50256, 1306]


def test_store_notices_damage_and_takes_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "store")
    token_store.write(docs_of(spark, [(1, "hello there")]), TOKENIZER, path)
    broken = spark.read.parquet(path).withColumn("words", F.concat(F.lit(b"\x01\x02"), F.substring("words", 3, 10**6)))
    broken.write.parquet(str(tmp_path / "broken"))
    with pytest.raises(Exception, match="damaged"):
        token_store.read(spark, str(tmp_path / "broken")).collect()
    token_store.write(docs_of(spark, EDGE).where("false"), TOKENIZER, str(tmp_path / "none"))
    assert token_store.read(spark, str(tmp_path / "none")).count() == 0


def test_rows_of_one_id_are_parted_by_text(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(None, f"{k:05d} text of a row without an id") for k in range(4000)] + [(5, f"{k} five") for k in range(50)]
    token_store.write(docs_of(spark, rows).repartition(6), TOKENIZER, path)
    assert len(os.listdir(path)) > 2 and max(r["count"] for r in spark.read.parquet(path).groupBy("file").agg(F.count("*").alias("count")).collect()) >= 1
    got = token_store.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 4000 + [5] * 50
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    for r, (_, text) in zip(got[::97], sorted(rows, key=lambda x: (x[0] is not None, x[1]))[::97], strict=True):
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(text).ids + [0]


# --- 8


def near_corpus():
    pick = random.Random(8)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 6)))
    rows, number = [], 0
    for _ in range(25):
        base = [word() for _ in range(pick.randint(30, 250))]
        for edits in (0, 0, 1, 2, 4, 8, 15, 30):
            own = list(base)
            for _ in range(edits):
                at = pick.randrange(len(own))
                own[at : at + 1] = pick.choice([[], [word()], [word(), own[at]]])
            rows.append((number, " ".join(own) + pick.choice(["", "."])))
            number += 1
        rows.append((number, " ".join(base[len(base) // 2 :] + base[: len(base) // 2])))
        number += 1
    passage = " ".join(word() for _ in range(60))
    for _ in range(30):
        rows.append((number, " ".join(word() for _ in range(pick.randint(20, 120))) + " " + passage))
        number += 1
    return rows


def brute_classes(rows):
    kmers, at = order_minhash.labelled_kmers(pa.array([t for _, t in rows]))
    own = [kmers[at[k] : at[k + 1]] for k in range(len(rows))]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            longest = order_minhash.chain(own[a], own[b])[1]
            if longest and longest >= 0.8 * (len(own[a]) + len(own[b]) - longest) - 1e-9:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {rows[k][0]: rows[find(k)][0] for k in range(len(rows))}


def test_near_classes_against_all_pairs(spark):
    rows = near_corpus()
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs_of(spark, rows)).collect()}
    assert got == brute_classes(rows)
    assert len(set(got.values())) < len(rows)


def test_near_classes_of_ids_that_repeat(spark):
    pick = random.Random(18)
    one, two, three = ([f"w{pick.randint(0, 10**6)}" for _ in range(80)] for _ in range(3))
    near = lambda words: " ".join([*words[:40], "other", *words[41:]])
    rows = [(7, " ".join(one)), (7, " ".join(two)), (3, near(one)), (9, near(two)), (20, " ".join(three)), (20, " ".join(three)), (None, " ".join(one)), (30, "")]
    got = sorted(map(str, order_minhash.classes(docs_of(spark, rows)).collect()))
    assert got == sorted(f"Row(doc_id={a}, class_id={b})" for a, b in [(7, 3), (7, 7), (3, 3), (9, 7), (20, 20), (20, 20), (None, None), (30, 30)])


def test_chain_is_the_longest_common_order_within_the_band():
    random_ = np.random.default_rng(2)
    for _ in range(200):
        a = random_.permutation(40)[:30].astype(np.uint64)
        b = np.delete(a, random_.integers(0, 30, 3))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert order_minhash.chain(a, b) == (len(b), table[-1, -1])
    assert order_minhash.chain(np.arange(10, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)) == (0, 0)


def test_near_classes_of_edge_rows(spark):
    got = order_minhash.classes(docs_of(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    assert {r.class_id for r in got if r.doc_id in (1, 6)} == {1}
    assert {r.class_id for r in got if r.doc_id in (2, 3, 4, 5, 8)} == {2, 3, 4, 5, 8}
    assert [r.class_id for r in got if r.doc_id is None] == [None]
    assert order_minhash.classes(docs_of(spark, EDGE).where("false")).count() == 0


# --- 9


def test_language_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op9_language_id"](spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    own = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in own) / len(own) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_bundles_are_sums_of_bound_letters():
    grams, counts, lettered = language_id.ngram_counts(*text_bytes(pa.array(["Abc ab", "", "12", "é"])))
    vectors = language_id.bundles(counts, grams, 64)
    letters = language_id.rotated_letters(64)
    kind = language_id.letter_classes()[np.array([ord(c) for c in "Abc ab"])]
    want = sum(letters[0][kind[i]] * letters[1][kind[i + 1]] * letters[2][kind[i + 2]] for i in range(4))
    assert np.allclose(vectors[0], want) and lettered.tolist() == [True, False, False, True]


def test_short_texts_of_many_letters_take_little_memory():
    """10,000 short texts in a varied script, in one pass: counts stay sparse."""
    import tracemalloc

    random_ = np.random.default_rng(9)
    rows = pa.array(["".join(map(chr, random_.integers(0x4E00, 0x9FA5, 33))) for _ in range(10_000)])
    raw, at = text_bytes(rows)
    row, code, lettered = language_id.ngrams(raw, at)
    assert lettered.all()
    language_id.letter_classes()
    tracemalloc.start()
    seen = np.zeros(len(rows), int)
    for first, last, grams, counts in language_id.count_slices(row, code, len(rows)):
        assert counts.size <= language_id.CELLS and counts.sum() == 31 * (last - first)
        seen[first:last] += 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (seen == 1).all() and peak < 200e6


def test_language_slices_give_what_one_table_gives():
    rows = pa.array([*texts(60), "", "東京 tokyo", "  "])
    raw, at = text_bytes(rows)
    grams, counts, _ = language_id.ngram_counts(raw, at)
    row, code, _ = language_id.ngrams(raw, at)
    whole = language_id.bundles(counts, grams, 64)
    for first, last, own, part in language_id.count_slices(row, code, len(rows), 5000):
        assert np.allclose(language_id.bundles(part, own, 64), whole[first:last], atol=1e-3)


def test_language_of_edge_rows(spark):
    docs = docs_of(spark, EDGE)
    prototypes = language_id.learn(docs)
    rows = language_id.predict(docs.withColumn("Score", F.lit(1)), prototypes).collect()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 4)} == {1: "en", 2: "und", 3: "und", 4: "und"}
    none = language_id.learn(docs.where("false"))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}


# --- 10

BASE = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = [True, all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else True, 12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15]
            if fits[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_against_the_plain_patterns():
    pick = random.Random(10)
    for k in range(20_000):
        text = "".join(pick.choice("a.b@-+% 0123456789()é\n" if k % 2 else "0159. -+(@a") for _ in range(pick.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_spans_are_added_and_base_spans_stay(spark):
    pick = random.Random(11)

    def card():
        digits = "4" + "".join(pick.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if pii.luhn(digits + c))

    rows = []
    for k in range(600):
        phone = f"+1 ({pick.randint(200, 999)}) 555-{pick.randint(1000, 9999)}"
        rows.append((k, f"Text {'abc ' * pick.randint(0, 5)}é {phone} more{'' if k % 3 else ' ' + card()} and q.{k}@mail{k % 9}.example.com end."))
        rows.append((1000 + k, f'token = "{pick.getrandbits(160):040x}" of'))
    two = f"call +1 (269) 555-3296 {card()} now"
    docs = docs_of(spark, [*rows, (5000, two), (5001, None), (5002, "")])
    model = pii.train(docs)
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    for doc_id, text in rows:
        assert found[doc_id].base_spans == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text))
        assert set(found[doc_id].base_spans.split(",")) <= set(found[doc_id].spans.split(",")) | {""}
    assert "phone:5:22" in found[5000].spans and "[PHONE]" in found[5000].redacted_text
    assert found[5001].spans == "" and found[5001].redacted_text is None and found[5002].redacted_text == ""
    assert sum(bool(found[1000 + k].spans) for k in range(600)) <= 12


def mailing_rows(pick, mails, numbers):
    """Texts with e-mail addresses of the rules, and numbers of 8 to 11 digits that stand for nothing."""
    rows = [f"write to user{k}.{pick.randint(10, 99)}@mail{k % 9}.example.com today" for k in range(mails)]
    return rows + ["row " + " x ".join(str(pick.randint(10**7, 10**11)) for _ in range(10)) + " end" for _ in range(numbers // 10)]


@pytest.mark.parametrize("mails, numbers, most", [(40, 200, 20_000), (300, 20_000, 1000)])
def test_each_kind_is_calibrated_on_small_tables_and_beside_a_hot_source(spark, mails, numbers, most):
    rows = mailing_rows(random.Random(12), mails, numbers)
    hidden = "please contact anna.lind [at] mail3.example.com soon"
    model = pii.train(docs_of(spark, [*enumerate(rows)]), max_rows=most)
    assert np.isfinite(model.threshold).all()
    (found,) = pii.find(docs_of(spark, [(1, hidden)]), model).collect()
    assert found.n_email == 0 and found.spans.startswith("email:") and "[EMAIL]" in found.redacted_text


def test_unmarked_forms_that_the_table_holds_are_found(spark):
    """Forms without the rules' marks, planted among documents, by kind; numbers of other kinds beside them."""
    pick = random.Random(20)

    def card(between):
        digits = "4" + "".join(pick.choice("0123456789") for _ in range(14))
        digits = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
        return between.join(digits[k : k + 4] for k in range(0, 16, 4))

    forms = {
        "email": lambda: f"anna.{pick.randint(10, 99)} [at] mail{pick.randint(1, 9)}.example.com",
        "email ": lambda: f"bo{pick.randint(10, 99)} (at) mail{pick.randint(1, 9)} (dot) example (dot) com",
        "ip": lambda: ":".join(f"{pick.randint(0, 65535):x}" for _ in range(8)),
        "card": lambda: card("."),
        "card ": lambda: card("/"),
        "phone": lambda: f"({pick.randint(200, 999)}) 555-{pick.randint(1000, 9999)}",
        "none": lambda: f"order {pick.randint(10**8, 10**9)}",
        "none ": lambda: f"20{pick.randint(10, 30)}-0{pick.randint(1, 9)}-1{pick.randint(0, 9)} 1{pick.randint(0, 9)}:30",
        "none  ": lambda: f"v{pick.randint(1, 9)}.{pick.randint(300, 999)}.{pick.randint(300, 999)}.{pick.randint(300, 999)}",
    }
    rows, planted = [], {}
    for k, (name, form) in enumerate(forms.items()):
        for j in range(50):
            own, head = form(), "The and of the to " * pick.randint(1, 4) + pick.choice(["", "contact ", "see "])
            rows.append((10**7 + 1000 * k + j, f"{head}{own} and the rest of it."))
            planted[rows[-1][0]] = (name, len(head), len(head) + len(own))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(docs_of(spark, rows).select("doc_id", "text"))
    found = pii.find(docs, pii.train(docs))
    right, wrong = {name: 0 for name in forms}, 0
    for r in found.where("doc_id >= 10000000").collect():
        name, start, end = planted[r.doc_id]
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        right[name] += any(k == name.strip() and a <= start and b >= end for k, a, b in spans)
        wrong += name.startswith("none") and bool(spans)
    assert all(n >= 45 for name, n in right.items() if not name.startswith("none")), right
    assert wrong <= 3 and found.where("doc_id < 10000000 AND spans <> base_spans").count() <= 10


def test_thresholds_follow_the_histogram_of_the_whole_table():
    edge = lambda odds: int((odds + pii.TOP_ODDS) * pii.INTERVALS / (2 * pii.TOP_ODDS))
    right, wrong = np.zeros(pii.INTERVALS), np.zeros(pii.INTERVALS)
    assert pii.threshold_of(right, wrong) == pytest.approx(pii.PRECISION, abs=1e-3)
    right[edge(3)] = 10**6
    assert pii.threshold_of(right, wrong) == pytest.approx(0.5, abs=1e-3)
    wrong[edge(1)] = 10**6
    assert 1 / (1 + np.exp(-1)) < pii.threshold_of(right, wrong) <= 1 / (1 + np.exp(-3))
    assert pii.shares([5, 1000, 0, 100], 300) == [5, 195, 0, 100]


def test_pii_of_edge_rows(spark):
    docs = docs_of(spark, EDGE).withColumn("SPANS", F.lit(1))
    rows = pii.find(docs, pii.train(docs)).collect()
    assert len(rows) == len(EDGE) and all(r.spans == "" for r in rows)
    assert pii.find(docs.where("false"), pii.train(docs.where("false"))).count() == 0


# --- registered queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    as_rows = lambda df: sorted(map(tuple, df[columns].astype(str).values))
    assert as_rows(got) == as_rows(want)
