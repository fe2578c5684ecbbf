"""Operators on small fixtures against brute force: nulls, empty and long texts, ties, repeats, clashing columns."""

import collections
import hashlib
import math
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from turnstone.llm import bpe, chat, decontaminate, html_text, language_model, quality, simhash, toxicity, url_filter, warc
from turnstone.llm.hashing import hash_words
from turnstone.session import run_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return (text or "").encode().translate(LOWER).split()


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(120)]
    out = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(30, 120))) for _ in range(30)]
    out += [None, "", "  \n", "One", "Two words", out[0], out[0].upper(), out[1] + " tail", "é" * 50, "x" * 5000]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, texts[2], None, None, None), (3, texts[3], "en", "s", 0)]
    return spark.createDataFrame(rows, DOCS).withColumns({"fp": F.lit("clash"), "score": F.lit(1), "ids": F.lit(0), "n_words": F.lit("x")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def fingerprint(text):
    w = words(text)
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_word_hashes_follow_words():
    some = [b"a B a", b"", b"\xc3\xa9 x\x0by", b"z" * 70000 + b" a"]
    value, counts = hash_words(some, True)
    assert counts.tolist() == [3, 0, 3, 2]
    assert value[0] == value[2] == value[-1] and len(set(value.tolist())) == 6


def test_simhash_groups_equal_brute_force(docs, texts, empty):
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs).collect()}
    rows = [(i, fingerprint(t)) for i, t in enumerate(texts)] + [(None, fingerprint(texts[2]))]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (rows[a][1] ^ rows[b][1]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    for at, (doc, fp) in enumerate(rows):
        least = min(rows[b][0] for b in range(len(rows)) if group[b] == group[at] and rows[b][0] is not None)
        assert got[doc, np.uint64(fp).astype(np.int64)] == least
    assert simhash.near_duplicates(empty).count() == 0
    kept = [r.doc_id for r in simhash.one_of_each_group(docs).collect()]
    assert len(kept) == len(set(kept)) and 0 in kept and 35 not in kept and 36 not in kept


def test_dealt_shards_keep_all_links(spark):
    draw = np.random.default_rng(5)
    centre = int(draw.integers(1, 1 << 60))
    values = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in draw.integers(0, 62, (150, 2))})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.components(simhash.links(frame, queries=16))
    assert {r.root for r in found.collect()} == {min(values)} and found.count() == len(values) - 1


def test_bk_tree_finds_what_a_scan_finds():
    values = np.random.default_rng(1).integers(0, 1 << 12, 300, dtype=np.uint64)
    got = {(n, int(q)) for n, near in simhash.BKTree(values).within(values, 2) for q in near}
    assert got == {(i, j) for i in range(300) for j in range(300) if (int(values[i]) ^ int(values[j])).bit_count() <= 2}


def test_bpe_equals_the_library(docs, texts, empty):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (60, 20)):
        tokens = bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
        rows = bpe.decode(tokens, ranks).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            text = texts[r.doc_id if r.doc_id is not None else 2] or ""
            assert r.ids == library.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    assert bpe.decode(bpe.encode(empty, ranks, public_tokenizers.PATTERN), ranks).count() == 0


def merged_one_by_one(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        at = min(pairs)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_pieces_merged_side_by_side_equal_one_by_one():
    draw = random.Random(3)
    for some in (b"ab", b"abc", bytes(range(256))):
        for _ in range(20):
            tokens = [bytes([b]) for b in some] + sorted({bytes(draw.choices(b"abc"[: len(some)], k=draw.randint(2, 6))) for _ in range(draw.randint(0, 60))})
            draw.shuffle(tokens)  # a join may rank below its parts
            ranks = {t: 2 * i for i, t in enumerate(tokens)}
            pieces = [bytes(draw.choices(some, k=draw.randint(1, bpe.SCANNED))) for _ in range(60)] + [b"a" * bpe.SCANNED, b"a"]
            got = [np.frombuffer(x, dtype="<i4").tolist() for x in bpe.merge_all(pieces, bpe.Pairs(ranks))]
            assert got == [merged_one_by_one(p, ranks) for p in pieces]
            assert [bpe._merge_heap(p, ranks) for p in pieces] == got
    assert bpe.merge_all([], bpe.Pairs(ranks)) == []
    assert bpe.merge_all([b"abc"], bpe.Pairs({b"ab": 0, b"abc": 1})) == [b"\1\0\0\0"]  # bytes that are no token may still join
    with pytest.raises(KeyError):
        bpe.merge_all([b"ac"], bpe.Pairs({b"a": 0}))


def test_new_pieces_are_not_merged_call_by_call(monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(6, 14))) for _ in range(500)) for _ in range(6)] + ["", "x" * 100 + " é"]
    encoder = bpe.Encoder(ranks, bpe.Pairs(ranks), public_tokenizers.PATTERN)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        first = encoder.texts(texts)
    finally:
        sys.setprofile(None)
    assert len(calls) < 1_000  # 3,000 pieces: two calls each when every piece was merged alone
    expected = [library.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe, "REMEMBERED", 1_000)
    for got in (first, encoder.texts(texts), encoder.texts(texts[::-1])[::-1]):  # remembered, then of the older generation
        assert [np.frombuffer(x, dtype="<i4").tolist() for x in got] == expected
    assert not any(len(p) >= 64 for p in encoder.seen)


def test_quality_counts(docs, texts, empty, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.judge(docs, model).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id if r.doc_id is not None else 2] or ""
        w = text.encode().split()
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)
    assert quality.judge(empty, quality.train(empty, labels)).count() == 0
    assert quality.duplicate_lines(b"a\n\nb\na\n \n ") == 1


def test_toxic_words_are_restored_and_learned(spark, empty):
    draw = random.Random(2)
    calm = ["the", "thing", "stands", "and", "rests", "here", "often", "idle", "diet", "riot"]
    rows = [(i, " ".join(draw.choice(calm) for _ in range(20)) + (" idiot." if i % 4 == 0 else ""), "en", "s", 0) for i in range(80)]
    rows += [(100, "the 1d!ot rests", None, None, None), (101, "an i d i o t here", None, None, None), (102, "the diet rests", None, None, None), (103, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame, toxicity.train(frame, labels)).collect()}
    assert [got[i].predicted for i in (0, 1, 100, 101, 102, 103)] == [1, 0, 1, 1, 0, 0]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0


def test_leaks_are_found_once_each(spark, texts, empty):
    item = " ".join(texts[0].split()[:30])
    benchmark = spark.createDataFrame([(1, item), (2, item + " unlike"), (3, None), (4, ""), (5, "alpha beta")], "item_id long, text string")
    rows = [(1, f"some words {item.upper()}, more words"), (2, "nothing here"), (3, None), (None, item), (4, item + " " + item), (5, " ".join(item.split()[2:]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(frame, benchmark).collect()}
    assert {d for d, _ in got} == {1, None, 4, 5} and {i for _, i in got} == {1, 2}
    assert got[1, 1].similarity == 1 and got[1, 1].start_word == 2 and got[1, 1].window_words == 30
    left = {r.doc_id for r in decontaminate.without_leaks(frame, benchmark).collect()}
    assert left == {2, 3}
    assert decontaminate.leaks(empty, benchmark).count() == 0 and decontaminate.leaks(frame, benchmark.limit(0)).count() == 0


def test_language_model_base_and_normalisation(docs, texts, empty):
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    from turnstone.llm.common import text_crc

    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[2]), (3, texts[3])]
    count = collections.Counter(w for i, t in rows if not held(i) for w in [*words(t), b""])
    total, distinct = sum(count.values()), len(count)
    for head in (language_model.HEAD_WORDS, 10):
        got = language_model.score(docs, text_crc("doc_id", 7) != 2, head).collect()
        assert len(got) == len(rows)
        for r in got:
            own = [*words(texts[r.doc_id if r.doc_id is not None else 2]), b""]
            base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), total)
            assert r.base_score == pytest.approx(base) and r.score < 0
    model = language_model.Model.start(np.ones(language_model.CLASSES))
    every = np.arange(language_model.CLASSES)
    some = np.full(language_model.CLASSES, 3)
    assert (10 ** language_model.Scorer(model).log10(some, some, every)).sum() == pytest.approx(1)
    assert language_model.score(empty, F.lit(True)).count() == 0


def test_archive_round_trip(spark):
    pages = spark.createDataFrame(
        [(1, "http://a", "<p>x"), (2, None, "<p>x"), (3, "http://b\r\nX: y", None), (4, "u", ""), (5, "u", "é"), (None, "u", "é"), (None, "u", "solo")],
        "page_id long, url string, html string")
    folder = run_folder(spark, "archive-test")
    archive = warc.write(pages, folder)
    got = {(r.page_id, r.payload_digest): r for r in warc.read_back(spark, archive).collect()}
    assert len(got) == 7
    import base64

    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert got[1, digest(b"<p>x")].refers_to == 2 and got[2, digest(b"<p>x")].record_type == "response"
    assert got[3, digest(b"")].refers_to == 4 and got[None, digest("é".encode())].refers_to == 5
    assert got[None, digest(b"solo")].record_type == "response"
    assert spark.read.parquet(archive.payloads).count() == 4
    whole = {r.page_id: bytes(r.record) for r in warc.rebuild(spark, archive).collect() if r.page_id}
    assert whole[2].endswith(b"\r\n\r\n<p>x\r\n\r\n") and b"Content-Length: 4\r\n" in whole[2] and b"\r\nX:" not in whole[3]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_url_rules(spark):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow"}
    urls = ["http://Example.com/en/a?b", "https://m.www.example.com/en/", "http://example.com", "ftp://x.com/", "nothing", None, "http://bad.org/x", "http://sub.bad.org#f"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    blocked = spark.createDataFrame([("bad.org",), (None,)], "host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules, blocked).collect()}
    assert got[0] == ("example.com", "/en/a", "example.com/en/", "block") and got[1][2:] == ("www.example.com/en/", "allow")
    assert got[2] == ("example.com", "", None, "allow") and got[3][2] == "com/" and got[4] == got[5] == ("", "", None, "allow")
    assert got[6][3] == got[7][3] == "block"
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_cascade_is_exact_over_its_keys(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("key"))
    listed = keys.where("key % 7 = 0")
    levels = url_filter.build_cascade(listed, keys)
    rows = keys.select("key", F.array("key").alias("keys"))
    got = {r.key for r in url_filter.members(rows, levels).collect() if r["keys"]}
    assert got == {r.key for r in listed.collect()} and len(levels) > 1


def test_main_text_of_varied_pages(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies and more words here</div><article><h1>Head&amp;line</h1><p>First <b>bold</b> words\n here<p>Second &lt;one&gt;"
        "<div class=ad>buy this now</div><p>Third of them</article><div id=comments><p>I disagree with all</div><footer>&copy; site</footer>")
    weights = html_text.learn(spark.createDataFrame([(page,), (None,), ("",)], "html string"))
    assert html_text.extract(page, weights) == "Head&line\nFirst bold words here\nSecond <one>\nThird of them"
    assert html_text.extract(page, html_text.Weights()) == "Head&line\nFirst bold words here\nSecond <one>\nThird of them"
    frame = spark.createDataFrame([(1, "u", None, "clash"), (2, "u", page, "clash")], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.main_text(frame, weights).collect()}
    assert got[1] == "" and got[2].startswith("Head&line")
    assert html_text.best_run([-1, 2, -1, 3, -5, 4]) == (1, 4) and html_text.best_run([-1.0]) == (0, 0)


def test_chat_trees_share_turns_and_read_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo <|end|> \\ </s>"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 1, "assistant", "no"),
            (3, 0, "user", "hi"), (4, 0, "system", None), (None, None, None, "x"), (5, 0, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("leaf", F.lit("clash"))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one range: every shared turn is emitted once
    trees, members = chat.format_conversations(turns)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = {r.conv_id: r for r in members.join(chat.read_back(trees), "leaf").collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    assert chat.parse(got[1].formatted) == [("user", "hi"), ("assistant", "yo <|end|> \\ </s>")] and got[1].loss_chars == len(rows[1][3])
    assert got[3].formatted == got[2].formatted and got[4].turns_sha256 == hashlib.sha256(b"system\n\n").hexdigest()
    total = trees.agg(F.sum(F.length("text"))).first()[0]
    assert total < sum(len(r.formatted) for r in got.values()) - len(got[3].formatted)
    assert all(r.position == sum(a.stop - a.start for a in r.ancestors) for r in trees.collect())
    assert members.sparkSession is spark and chat.read_back(chat.format_conversations(turns.limit(0))[0]).count() == 0


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{folder}/documents.parquet")
    docs = source
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        after.write.parquet(path := run_folder(spark, "stage"))
        after = spark.read.parquet(path)
        assert after.columns == source.columns and 0 < after.count() <= docs.count() and after.join(docs, "doc_id", "left_anti").isEmpty()
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_one_of_each_group_is_determined(spark):
    rows = [(1, "b b b b"), (1, "a a a a"), (2, "b b b b"), (3, None), (4, ""), (None, "a a a a"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tags", F.create_map(F.lit("k"), F.col("text")))
    for parts in (1, 5):
        got = sorted(((r.doc_id, r.text) for r in simhash.one_of_each_group(frame.repartition(parts)).collect()), key=str)
        assert got == sorted([(1, "a a a a"), (3, None), (None, "a a a a"), (None, None)], key=str)
