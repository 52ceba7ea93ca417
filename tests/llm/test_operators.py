"""Each operator against brute force on small tables, and the defined cases: nulls, empty and long
texts, ties, repeated rows, empty tables, and extra columns with clashing names."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from aurum.llm import ann, bpe_replay, kneser_ney, line_quality, minhash, mixing, range_coder, suffix_dedup, token_binary, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, key long, node long, n long"
rng = np.random.default_rng(5)
WORDS = ["".join(rng.choice(list("abcdeéß"), 4)) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    own = np.random.default_rng(seed).choice(WORDS, n).tolist()
    return "".join(w + (".\n" if k % 9 == 8 else " ") for k, w in enumerate(own))


LONG = prose(3000, 99)
PASSAGE = prose(150, 77)
ROWS = [(1, prose(60, 1)), (2, prose(60, 1)), (3, prose(60, 1) + " extra"), (4, None), (5, ""), (6, "  \n "), (7, "one two"), (8, LONG),
        (8, LONG), (9, "x" * 5000), (10, PASSAGE + prose(90, 2)), (11, prose(70, 3) + PASSAGE), (None, prose(40, 4)), (None, None),
        (12, "日本語 " * 300 + "😀"), (13, "you are a stupid idiot " * 3 + prose(30, 6)), (14, "a a a a " * 40), (15, "tab\tbed  two \r\n")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, 1, 2, 3, 4) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i != 14), int(i == 13)) for i in range(1, 16)] + [(1, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity(spark, docs, empty, labels):
    more = spark.createDataFrame([(100 + k, ("such an idiot " if k % 2 else "") + prose(25, 1000 + k)) for k in range(80)], "doc_id long, text string")
    marks = spark.createDataFrame([(100 + k, k % 2) for k in range(80)], "doc_id long, toxic int")
    model = toxicity.fit(more, marks)
    assert "idiot" in model.lexicon
    got = toxicity.score(more, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    scored = toxicity.score(docs, model)
    assert scored.count() == len(ROWS) and scored.where("score between 0 and 1").count() == len(ROWS)
    assert toxicity.reject_toxic(docs, model).columns == docs.columns
    assert {r.doc_id for r in docs.exceptAll(toxicity.reject_toxic(docs, model)).collect()} == {13}
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


def test_labels_of_held_out_rows_are_never_read(spark):
    docs = spark.createDataFrame([(k, "vile " + prose(20, k)) for k in range(60)], "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(zlib.crc32(str(k).encode()) % 4 == 2)) for k in range(60)], "doc_id long, toxic int")
    assert toxicity.fit(docs, marks).lexicon == []


def test_line_quality(spark, docs, empty):
    for r in line_quality.line_quality(docs).where("doc_id is not null").collect():
        words = (dict(ROWS)[r.doc_id] or "").encode().split()
        assert r.n_words == len(words)
        windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(8)}
        assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
    common = "\n".join(f"menu entry {k} of the site of this host" for k in range(5))
    rows = [(k, common + (f"\n{k} only" if k else f"\n{k}"), "h") for k in range(30)] + [(100 + k, prose(40, 500 + k), "h") for k in range(30)]
    got = {r.doc_id: r for r in line_quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[k].kept for k in range(30)) and all(got[100 + k].kept for k in range(30))
    copies = spark.createDataFrame([(k, prose(60, 9), "h") for k in range(30)], "doc_id long, text string, source string")
    assert line_quality.line_quality(copies).where("kept").count() == 30  # copies of one text are one document
    assert line_quality.line_quality(empty).count() == 0


def test_line_quality_counts_hosts_exactly(spark):
    line = "menu of the site of this host"
    for n in range(5000, 5900, 150):  # the limit is 0.02 * n: a line in exactly so many texts stays, in one more it goes
        rows = [(h * n + k, prose(3, k) + f" {k}" + ("\n" + line if k < n // 50 + h else ""), f"h{h}") for h in (0, 1) for k in range(n)]
        got = line_quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string"))
        assert {(r.doc_id // n, r.removed_words) for r in got.where("removed_words > 0").collect()} == {(1, 7)}


def test_line_quality_removes_the_lines(spark):
    """Frequent lines leave the texts of their host, every copy and spelling of them, and no other's."""
    rows = [(k, f"Top  menu\n{prose(30, k)}\n\ntop menu\nTop  menu\n own {k}", "h") for k in range(20)]
    rows += [(100, "Top  menu\nelse", "other"), (101, None, "h"), (102, "top menu", "h")]
    got = {r.doc_id: r for r in line_quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for k in range(20):
        assert (got[k].text, got[k].removed_words) == (f"{prose(30, k)}\n\n own {k}", 2)
    assert [(got[k].text, got[k].removed_words) for k in (100, 101, 102)] == [("Top  menu\nelse", 0), (None, 0), ("", 2)]


def test_bpe(docs, empty):
    import tiktoken

    ranks = bpe_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    by_id = defaultdict(list)
    for i, t in ROWS:
        by_id[i].append(hashlib.sha256(np.array(library.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest())
    got = defaultdict(list)
    for r in bpe_replay.bpe_digests(docs, ranks, public_tokenizers.PATTERN).collect():
        got[r.doc_id].append(r.ids_sha256)
        if r.doc_id is not None:
            assert r.decoded_sha256 == hashlib.sha256((dict(ROWS)[r.doc_id] or "").encode()).hexdigest()
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_id.items()}
    assert bpe_replay.bpe_digests(empty, ranks, public_tokenizers.PATTERN).count() == 0
    encoder = bpe_replay.Encoder(ranks, public_tokenizers.PATTERN)
    odd = ["".join(np.random.default_rng(k).choice(list("ab c\n'st.\t1é ! "), 40)) for k in range(300)] + ["*" * 999, "aaaa" * 77]
    assert encoder.encode(odd) == [np.array(library.encode_ordinary(x), "<u4").tobytes() for x in odd]


def test_bpe_risky_ranks_match_the_plain_algorithm():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 300, b"ab": 301, b"cab": 302, b"aa": 303, b"aaa": 280}
    replay = bpe_replay.Replay(ranks)

    def plain(word):
        parts = [word[k:k + 1] for k in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: (ranks.get(parts[k] + parts[k + 1], 1 << 40), k))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [ranks[p] for p in parts]

    words = [bytes(np.random.default_rng(k).choice(list(b"abc"), 1 + k % 17).tolist()) for k in range(400)]
    for word, ids in zip(words, replay.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ([ranks[word]] if word in ranks else plain(word))


def test_kneser_ney_probabilities_sum_to_one(spark, docs, empty, labels):
    counts = spark.createDataFrame([(int(g), int(n)) for t in [ROWS[0][1]] for g, n in zip(*np.unique(kneser_ney.grams(kneser_ney.symbols(t)).view(np.int64), return_counts=True), strict=True)], "gram long, n long")
    model = kneser_ney.Model(counts)
    seen = [r.gram for r in model.tables[1].collect()]
    context = counts.first().gram >> 16
    wanted = spark.createDataFrame([(int(context << 16 | s),) for s in [*seen, 0xFFFE]], "gram long")
    total = model.probabilities(wanted).agg(F.sum("p")).first()[0]
    assert total == pytest.approx(1.0, abs=1e-9)
    got = kneser_ney.quality(docs, labels, min_trusted=1)
    assert got.count() == len(ROWS)
    assert {r.doc_id for r in got.where("perplexity is null").collect()} == {4, 5, 6, None}
    assert kneser_ney.quality(empty, labels).count() == 0
    assert kneser_ney.quality(docs, labels.where("false")).where("kept").count() == 0


def test_kneser_ney_moves_no_texts(spark, docs, labels):
    trained, scores = kneser_ney.Blocks(docs), []
    model = kneser_ney.train(trained, labels)
    for size in (2000, kneser_ney.BLOCK_BYTES):  # many blocks, or one for each task
        blocks = kneser_ney.Blocks(docs, size)
        own = {r.block: (r.doc_ids, r.grams) for r in blocks.rows.collect()}
        assert blocks.rows.count() == len(own) and (len(own) > 6 if size == 2000 else len(own) <= 3)
        for block, (ids, grams) in own.items():
            table = kneser_ney._texts_of(blocks.path, block, ["doc_id", "text"])
            assert table["doc_id"].to_pylist() == ids
            wanted = set().union(*(kneser_ney.grams(kneser_ney.symbols(x or "")).view(np.int64).tolist() for x in table["text"].to_pylist()))
            assert len(grams) == len(wanted) and set(grams) == wanted  # once each, however many slices the block had
        assert sorted((i is None, i or 0) for ids, _ in own.values() for i in ids) == sorted((i is None, i or 0) for i, _ in ROWS)
        scored = kneser_ney.perplexities(blocks, model)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and not re.search(r"\b(text|packed)#", plan)
        scores.append(sorted(((r.doc_id is None, r.doc_id or 0, r.perplexity or 0) for r in scored.collect())))
    assert scores[0] == scores[1] and len(scores[0]) == len(ROWS)


def test_mixing_meets_the_targets(spark, docs, empty):
    rows = [(k, "w " * (1 + k % 7), ("en", "de")[k % 3 == 0], ("a", "b")[k % 4 == 0]) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.4, "de": 0.6}, "topic": {}}
    out = mixing.mixed(df, targets).toPandas()
    weight = out.tokens * out.factor
    assert (weight.groupby(out.source).sum() / weight.sum()).round(6).to_dict() == {"a": 0.5, "b": 0.5}
    assert (weight.groupby(out.lang).sum() / weight.sum()).round(6).to_dict() == {"de": 0.6, "en": 0.4}
    # brute force: the same rounds by hand
    cells = out.groupby(["source", "lang"]).tokens.sum().astype(float)
    w = cells / cells.sum()
    for _ in range(30):
        for d, want in (("source", {"a": 0.5, "b": 0.5}), ("lang", {"en": 0.4, "de": 0.6})):
            w = w * w.index.get_level_values(d).map(want) / w.groupby(level=d).transform("sum")
    factor = (w * cells.sum() / cells).to_dict()
    assert all(abs(f - factor[s, g]) < 1e-9 for f, s, g in zip(out.factor, out.source, out.lang, strict=True))
    assert out.probability.max() == 1 and out.sampled[out.probability == 1].all()
    assert mixing.sample(docs).columns == docs.columns and mixing.mixed(docs).count() == len(ROWS)
    assert mixing.mixed(empty).count() == 0


def test_mixing_rate_is_not_set_by_a_tiny_source(spark):
    rows = [(k, "w " * 2000, "en", "abc"[k % 3]) for k in range(300)] + [(1000, "w", "en", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = lambda out: (out.tokens * out.probability).sum() / out.tokens.sum()
    out = mixing.mixed(df).toPandas()
    assert kept(out) == pytest.approx(mixing.LEAST_RATE) and out.probability[out.source == "tiny"].eq(1).all()
    for rate in (0.1, 0.6, 1.0):
        assert kept(mixing.mixed(df, rate=rate).toPandas()) == pytest.approx(rate)
    even = mixing.mixed(df.where("source <> 'tiny'")).toPandas()
    assert even.probability.eq(1).all()  # nothing saturates: all that the targets leave


def test_mixing_topics(spark):
    import re

    signs = {"legal": r"(?i)\blicen[sc]ed?\b|all rights reserved|copyright", "contact": r"\w@\w|\d[ .-]\d\d\d[ .-]\d\d", "table": r" \| .* \| ",
             "code": r"[{};]\n|\ndef |</\w", "numeric": r"\d\s+\d+\s+\d+\s+\d"}
    texts = ["", "a licensed b", "silicense", "LiCenCe x", "ALL rights Reserved", "CopyRight", "a@b", "a @ b", "call 5 123 45", "5.123-45", "x | y | z",
             "x | y", "x | y\n | z", "a {\n", "};", "();", "</p>", "</ p", "x\ndef f", "def f", "1 22\t3 4", "1 2 3", "plain words", "a | b @ c | 1 2 3 4"]
    got = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "n int, text string").select("n", mixing.topic(F.col("text"))).collect()
    want = {n: next((k for k, sign in signs.items() if re.search(sign, x, re.A)), "prose") for n, x in enumerate(texts)} | {99: "prose"}
    assert dict(got) == want and set(want.values()) == set(signs) | {"prose"}


def test_mixing_rakes_all_sources(spark):
    rows = [(k, "w " * (40 if k < 500 else 1 + k % 3), ("en", "de")[k % 3 == 0], f"s{k if k >= 500 else k % 5}") for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mixed(df).toPandas()
    weight = (out.tokens * out.factor).groupby(out.source).sum() / out.tokens.sum()
    roots = out.groupby("source").tokens.sum() ** 0.5
    assert len(weight) == 1005 and abs(weight * roots.sum() / roots - 1).max() < 1e-3
    # targets that leave sources out: these keep the part of the tokens that they have
    targets = {"source": {"s0": 1.0, "s1": 3.0, "none": 5.0}, "lang": {"en": 1.0, "de": 1.0}, "topic": {}}
    out = mixing.mixed(df, targets).toPandas()
    weight = (out.tokens * out.factor).groupby(out.source).sum() / out.tokens.sum()
    rest = out.tokens[out.source == "other"].sum() / out.tokens.sum()
    assert weight.to_dict() == pytest.approx({"other": rest, "s0": (1 - rest) / 4, "s1": 3 * (1 - rest) / 4})
    weight = (out.tokens * out.factor).groupby(out.lang).sum() / out.tokens.sum()
    assert weight.to_dict() == pytest.approx({"en": 0.5, "de": 0.5})


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc(spark, compression):
    schema = "page_id long, url string, html string, payload string, sha1 string"
    pages = [(3, "u", "same"), (1, None, "same"), (2, "a\r\nb", "é" * 90000), (4, "u", None), (5, "u", ""), (6, "u", "x\r\n\r\ny"), (None, None, "same")]
    df = spark.createDataFrame([(*p, "", "") for p in pages], schema)
    got = {r.page_id: r for r in warc.roundtrip(df, compression=compression).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1), 2: ("response", None), 4: ("response", None), 5: ("revisit", 4), 6: ("response", None)}
    for i, _, html in pages:
        assert (got[i].payload_bytes, got[i].payload_digest) == (len((html or "").encode()), warc.digest_of((html or "").encode()))
    assert warc.roundtrip(df.where("false")).count() == 0


def test_warc_filters_are_taken_over(spark, tmp_path):
    warc.register(spark)
    records = [warc.record("response", f"urn:page:{k}", None, None, warc.digest_of(b"p%d" % k), b"p%d" % k) for k in range(50)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    df = spark.read.format("warc").load(str(tmp_path)).where("record_type = 'response' and record_id in ('urn:page:7', 'urn:page:9')")
    assert sorted(bytes(r.payload) for r in df.collect()) == [b"p7", b"p9"]
    reader = warc.WarcReader({"path": str(tmp_path)}, df.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 1)]))
    assert len(left) == 1 and list(reader.read(reader.partitions()[0])) == []
    (tmp_path / "b.warc").write_bytes(records[0][:-9])
    with pytest.raises(Exception, match="truncated"):
        spark.read.format("warc").load(str(tmp_path)).count()


@pytest.mark.parametrize("n", [0, 1, 7, 2047, 2048, 2049, 9000])
def test_range_coder_round_trip(n):
    for ids in (np.random.default_rng(n).integers(0, 1 << 16, n), np.minimum(np.random.default_rng(n).zipf(1.4, n), 49407), np.full(n, 5)):
        blocks = range_coder.encode(ids)
        assert len(blocks) == -(-n // range_coder.BLOCK)
        assert np.array_equal(range_coder.decode(blocks, n), ids)


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, text = Tokenizer.from_file(path), open(path, encoding="utf-8").read()
    got = token_binary.roundtrip(docs, text).collect()
    got.sort(key=lambda r: r.start)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, (i, t) in zip(got, want, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_binary.roundtrip(empty, text).count() == 0


def test_nearest_neighbours(spark):
    x = np.random.default_rng(3).standard_normal((3000, 16)).astype("float32")
    x[:40] = x[0]  # ties
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [1.0, None] * 8), (9080, [1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.nearest(df, part_rows=300, fit_rows=2000).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    y, found, total = x.astype(float), 0, 0
    assert sorted(got) == list(range(0, 3000, 20))
    for q, near in got.items():
        scores = np.zeros(len(y))
        for j in range(16):
            scores += y[q, j] * y[:, j]
        order = [k for k in np.lexsort((np.arange(len(y)), -scores)) if k != q][:20]
        assert near == sorted(near, key=lambda p: (-p[1], p[0])) and all(s == scores[v] for v, s in near)
        found, total = found + len(set(order) & {v for v, _ in near}), total + 20
    assert found / total >= 0.9
    assert [v for v, _ in got[0]] == list(range(1, 21))
    few = ann.nearest(df.where("vec_id < 5")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, k) for k in range(1, 5)]
    assert ann.nearest(df.where("false")).count() == 0


def test_run_length_index():
    for seed in range(60):
        g = np.random.default_rng(seed)
        strings = [g.integers(0, 2, g.integers(1, 30)).astype(np.uint8) for _ in range(g.integers(1, 5))]
        index = suffix_dedup.RunLengthIndex(strings)
        got = index.matching_statistics()
        places = [(k, p) for k, s in enumerate(strings) for p in range(len(s))]
        for k, p in places:
            def match(m, q):
                n = 0
                while p + n < len(strings[k]) and q + n < len(strings[m]) and strings[k][p + n] == strings[m][q + n]:
                    n += 1
                return n
            assert got[index.starts[k] + p] == max((match(m, q) for m, q in places if (m, q) != (k, p)), default=0)


def test_long_matches_are_measured_by_levels_of_the_sort():
    g = np.random.default_rng(3)
    for n in (1, 2, 40, 700):
        text = np.append(np.repeat(g.integers(1, 4, -(-n // 5)), 5)[:n], 0)  # its end is a character of its own
        levels = []
        order = suffix_dedup.suffix_array(text, levels)
        assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())
        for step, rank in levels:
            heads = [text[k:k + step].tolist() for k in range(len(text))]
            assert rank.tolist() == [sum(x < y for x in heads) for y in heads]
    long = g.integers(0, 256, 300_000).astype(np.uint8)
    start = time.process_time()
    index = suffix_dedup.RunLengthIndex([long, long])
    assert time.process_time() - start < 3  # byte by byte, 300,000 passes
    assert index.matching_statistics()[:len(long)].tolist() == list(range(len(long), 0, -1))


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                gone[k:k + length] = True
        out.append(gone)
    return data, out


def test_suffix_dedup(docs, empty):
    data, gone = brute_removed([t for _, t in ROWS], 400)
    want = Counter((i, len(d), int(g.sum()), int(np.count_nonzero(np.diff(np.append(False, g).astype(int)) == 1)),
                    hashlib.sha256(np.frombuffer(d, np.uint8)[~g].tobytes()).hexdigest()) for (i, _), d, g in zip(ROWS, data, gone, strict=True))
    assert Counter(tuple(r)[:5] for r in suffix_dedup.removed_digests(docs).collect()) == want
    kept = suffix_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert all(r.text is None or len(r.text) == r.n_chars for r in kept.collect())
    assert suffix_dedup.removed_digests(empty).count() == 0


def test_suffix_dedup_splits_crowded_anchors(spark):
    """Passages below, at and above the length, each in many documents with different surroundings."""
    rows, passages = [], [prose(400, 900 + n)[:n] for n in (80, 399, 400, 401, 430, 900)]
    for k in range(72):
        passage = passages[k % 6]
        cut = k % 5 * 9 if k % 6 == 5 else 0
        rows.append((k, prose(20 + 3 * k, 2 * k) + passage[cut:] + prose(300 - 4 * k, 2 * k + 1)))
    rows += [(72, passages[5] * 2), (73, "ab" * 700), (74, "x" * 1000), (None, passages[4]), (75, passages[4]), (75, passages[4]), (76, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter()
    for (doc_id, _), gone in zip(rows, brute_removed([text for _, text in rows], 400)[1], strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).tolist()
        want[doc_id, tuple(zip(edges[::2], edges[1::2], strict=True))] += 1
    assert sum(n for (_, spans), n in want.items() if spans) > 40
    for key_contexts in (2, 5, suffix_dedup.KEY_CONTEXTS):
        spans = suffix_dedup.repeated_spans(docs, key_contexts=key_contexts).collect()
        marks = {(r.doc_id, r.text_hash): r for r in spans}
        hashed = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()
        got = Counter()
        for r in hashed:
            own = marks.get((r.doc_id, r.h))
            got[r.doc_id, tuple(suffix_dedup._spans(own.whole, own.parts, r.n, 400)) if own else ()] += 1
        assert got == want


def test_near_duplicates(spark, docs, empty):
    base = prose(120, 42).split()
    edited = []
    for k in range(25):
        own = list(base)
        own[(k * 4) % 120] = f"edit{k}"
        edited.append((200 + k, " ".join(own)))
    df = docs.select("doc_id", "text").union(spark.createDataFrame(edited, "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    known: dict = {}
    sets = [minhash.shingles(t or "", known) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a][0]) and minhash.similarity(sets[a], sets[b]) >= 0.8:
                parent[root(a)] = root(b)
    classes = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        classes[root(k)].append(i)
    want = Counter((i, min((x for x in own if x is not None), default=None)) for own in classes.values() for i in own)
    assert Counter((r.doc_id, r.class_id) for r in minhash.near_duplicates(df).collect()) == want
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and {1, 4, 5, 6, 8} <= set(ids) and 2 not in ids
    assert minhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_class_with_shared_ids(spark):
    rows = [(0, prose(60, 50))] + [x for k in range(1, 7) for x in ((k, prose(60, 50) + f" extra{k}"), (k, prose(60, 60 + k)))] + [
        (9, prose(60, 80)), (9, prose(60, 81)), (9, prose(60, 81))]
    kept = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted([rows[0]] + [(k, prose(60, 60 + k)) for k in range(1, 7)] + rows[-3:-1])


def test_probability_jaccard():
    for seed in range(40):
        g = np.random.default_rng(seed)
        a, b = ({int(k): int(n) for k, n in zip(g.choice(12, 8, replace=False), g.integers(1, 4, 8), strict=True)} for _ in range(2))
        pack = lambda d: (np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)]))
        want = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())
        assert minhash.similarity(pack(a), pack(b)) == pytest.approx(want)
    signed = minhash.signatures([pack(a), pack(b)], 20000)
    assert (signed[0] == signed[1]).mean() == pytest.approx(want, abs=0.02)


def test_pipeline_stages(spark, docs, tmp_path, labels):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() < len(ROWS)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "mixing", "bpe"]
