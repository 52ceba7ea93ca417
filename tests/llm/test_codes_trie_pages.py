"""Dual-tree codes, the turn trie and main-text extraction against brute force, and their defined cases."""

import gzip
import hashlib
import html
import io
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aurum.llm import dual_tree, main_text, turn_trie, warc

rng = np.random.default_rng(11)


# ---- dual-tree Lloyd -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n,k,w,span", [(1, 1, 4, 9), (5, 3, 2, 2), (3000, 256, 16, 128), (900, 200, 3, 4), (100, 100, 1, 3), (2000, 256, 8, 1)])
def test_two_trees_find_the_nearest_entries(n, k, w, span):
    points, entries = rng.integers(-span, span + 1, (n, w)), rng.integers(-span, span + 1, (k, w))
    tree = dual_tree.Tree(points, dual_tree.levels_for(n, dual_tree.LEAF))
    labels, sums, counts = dual_tree.assigned(tree, dual_tree.entry_tree(entries))
    want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)  # the first of equal ones
    got = np.empty(n, np.int64)
    got[tree.order] = labels
    assert (got == want).all() and (counts == np.bincount(want, minlength=k)).all()
    total = np.zeros((k, w), np.int64)
    np.add.at(total, want, points)
    assert (sums == total).all()


def test_far_nodes_are_assigned_whole(monkeypatch):
    points = np.concatenate([rng.integers(0, 9, (500, 4)), rng.integers(10_000, 10_009, (500, 4))])
    entries = np.array([[0] * 4, [10_000] * 4, [50_000] * 4, [50_001] * 4])
    tree, books = dual_tree.Tree(points, dual_tree.levels_for(1000, 32)), dual_tree.entry_tree(entries)
    books.original = None  # leaves would need it
    labels, _, counts = dual_tree.assigned(tree, books)
    assert counts.tolist() == [500, 500, 0, 0]


def brute_codes(rows, entries, rounds):
    kept = [(i, lab, np.floor(np.array(v, float) * 1024).astype(np.int64)) for i, v, lab in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    x = np.stack([v for _, _, v in kept]).reshape(len(kept), 4, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        return np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(2).argmin(1) for p in range(4)], 1)
    for _ in range(rounds):
        code = nearest()
        for p in range(4):
            for e in np.unique(code[:, p]):
                mine = x[code[:, p] == e, p]
                books[p, e] = mine.sum(0) // len(mine)
    code = nearest()
    error = sum(((x[:, p] - books[p][code[:, p]]) ** 2).sum(1) for p in range(4))
    by_label = defaultdict(int)
    for (_, lab, _), e in zip(kept, error):
        by_label[lab] += int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted((repr(i), bytes(c.astype(np.uint8)).hex(), int(e), by_label[lab], sha) for (i, lab, _), c, e in zip(kept, code, error))


@pytest.mark.parametrize("block", [1 << 19, 512])
def test_codes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(dual_tree, "BLOCK_NUMBERS", block)
    v = rng.normal(0, 0.3, (700, 8)).round(2).tolist()
    rows = [(k, v[k], None if k % 7 == 0 else k % 3) for k in range(650)]
    rows += [(3, v[650], 1), (3, v[650], 1), (None, v[651], 2), (None, v[652], None), (700, None, 1), (701, [], 1), (702, [0.1] * 7 + [None], 0),
             (703, [0.1] * 7 + [float("nan")], 0), (704, [float("inf")] * 8, 0), (705, [0.0] * 8, 0), (-1, [-0.0005] * 8, 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, cell int, code string").repartition(5)
    got = sorted((repr(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in dual_tree.code_digests(df).collect())
    assert got == brute_codes(rows, 256, 4)


def test_codes_defined_cases(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert dual_tree.code_digests(spark.createDataFrame([], schema)).collect() == []
    assert dual_tree.code_digests(spark.createDataFrame([(1, None, 1)], schema)).collect() == []
    few = dual_tree.code_digests(spark.createDataFrame([(2, [1.0] * 4, 1), (1, [0.5] * 4, 1)], schema)).orderBy("vec_id").collect()
    assert [(r.code, r.error) for r in few] == [("00000000", 0), ("01010101", 0)]
    with pytest.raises(ValueError):
        dual_tree.code_digests(spark.createDataFrame([(1, [1.0] * 6, 1)], schema))
    with pytest.raises(Exception, match="one width"):
        dual_tree.code_digests(spark.createDataFrame([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], schema)).collect()


# ---- turn trie -------------------------------------------------------------------------------------------------------

def brute_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            tie = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()[:32]
            own[c].append((t is not None, t or 0, r, tie, x))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        start = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(start, [])[:h] + own[c][h:])
    members, children, leaves, saved = defaultdict(list), defaultdict(int), {}, {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    below = defaultdict(list)
    for s in members:
        if s:
            below[s[:-1]].append(s)
            children[s[:-1]] += 1
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in below[s]) or 1
        saved[s] = sum(saved[k] for k in below[s]) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
    return sorted((min(m), len(s), min(members[s[:-1]]) if s else -10**9, len(m), children[s], leaves[s], saved[s],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(s)))).encode()).hexdigest())
                  for s, m in members.items())


def trie_rows(df):
    return sorted((r.conv_id, r.depth, -10**9 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


CONVERSATION = "conv_id long, turn long, role string, text string, head string, key int, depth int"


@pytest.fixture(scope="module")
def talks():
    rows = []
    for c in range(0, 700):
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {rng.integers(0, 3)} é😀" * int(rng.integers(1, 3))))
    rows += [(800 + k, t, "user", f"copy {t}") for k in range(90) for t in range(4)]          # copies of one conversation
    rows += [(1205, 0, "user", "own start only"), (1207, 1, None, None), (1207, None, "user", ""), (1207, None, "user", None)]
    rows += [(-5, 0, "user", "minus"), (-205, 0, "user", "minus"), (-200, 0, "user", "base"), (None, 0, "user", "x"), (None, None, None, None)]
    rows += [(1300, 3, "a", "tie"), (1300, 3, "a", "tied"), (1300, 3, "b", "tie"), (1300, 3, "a", "tie"), (1301, 3, "a", "x" * 30_000)]
    rows += [(1400, t, "user", f"long {t}") for t in range(3000)] + [(1499, t, "user", f"long {t}") for t in range(2990)]
    return rows


@pytest.mark.parametrize("capacity", [512, 40, 3])
def test_trie_equals_brute_force(spark, talks, monkeypatch, capacity):
    monkeypatch.setattr(turn_trie, "PIECE", 7)  # many pieces of each list of ids
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in talks], CONVERSATION).repartition(6)
    got = trie_rows(turn_trie.trie(df, capacity))
    assert got == brute_trie(talks)


def test_trie_defined_cases(spark):
    assert turn_trie.trie(spark.createDataFrame([], CONVERSATION)).collect() == []
    assert turn_trie.trie(spark.createDataFrame([(None, 1, "a", "b", "", 1, 1)], CONVERSATION)).collect() == []
    gone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)
    only = turn_trie.trie(spark.createDataFrame([(gone, 1, "a", "b", "", 1, 1)], CONVERSATION)).collect()  # its start is absent: no turns
    assert [tuple(r) for r in only] == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]


# ---- long WARC payloads ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("compressed", [False, True])
def test_long_payloads_are_read_in_linear_time(compressed):
    payloads = [b"", b"a\r\n\r\nb", b"x" * (96 << 20), b"y" * 300_000, b"z"]
    records = [warc.record("response", f"r{k}", f"http://h/{k}", None, warc.digest_of(p), p) for k, p in enumerate(payloads)]
    data = b"".join(gzip.compress(r, 1) if compressed else r for r in records)
    start = time.time()
    for whole in (True, False):
        got = list(warc.records(io.BytesIO(data), 0, len(data), gzip=compressed, wanted={}, payloads=whole, verify=True))
        assert [r[-2] for r in got] == [len(p) for p in payloads] and (not whole or [r[-1] for r in got] == payloads)
    assert time.time() - start < 20
    for bad in (records[3].replace(b"Content-Length", b"X-Length", 1), records[3][:40], records[3][:-9]):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad), 0, len(bad), gzip=False, wanted={}, payloads=True, verify=True))


# ---- main text -------------------------------------------------------------------------------------------------------

def page(k: int, article: str, wrap: str = '<div class="post-{k} entry">{a}</div>') -> str:
    return (f'<!DOCTYPE html><html><head><title>t {k}</title><style>p{{}}</style><script>var x="<p>no</p>";</script></head><body class="has-sidebar">'
            f'<header><a href="/">Site</a> slogan of the site</header><nav><ul><li><a href="/a">a</a><li><a href="/b">b</a></ul></nav>'
            f'<div class="cookie-notice">We use cookies on this long and winding site.</div>' + wrap.format(k=k, a=article) +
            '<aside><p>Some other story, quite long as well, to tempt the reader.</p></aside><div id="comments"><article class="comment"><p>'
            + "Reader words go on and on. " * 40 + '</p></article></div><form><label>Mail</label><input></form><footer>&copy; 2024</footer></body></html>')


def test_main_text_without_furniture():
    body = ('<h2>Head &amp;   line</h2><p>First <b>bold</b> and <a href="/x">linked</a>\n text.<p>Second &#233;&nbsp;&lt;b&gt; <!-- no --> text<br>after'
            '<ul><li>one<li>two</ul><div class="ad">Buy</div><div class="share-buttons">Share</div><table><tr><td>c1<td>c2</table><script>x</script>')
    want = "Head & line\nFirst bold and linked text.\nSecond é <b> text after\none\ntwo\nc1\nc2"
    assert main_text.main_text(page(7, body), []) == want
    assert main_text.main_text(page(7, body, "<main><article>{a}</article></main>"), []) == want
    cut = page(7, body)
    assert main_text.main_text(cut[:cut.index("Share") + 3], []) == "\n".join(want.split("\n")[:5])


def test_hosts_outvote_an_odd_page(spark):
    """On one page, an unmarked teaser is longer than the article; the host's other pages say where the article is."""
    story = "<p>" + "This is what the page is about. " * 6 + "</p>"
    teaser = "<div class='teaser'><p>" + "Quite another thing altogether. " * 60 + "</p></div>"
    pages = [(k, f"https://Site.example.com:8080/{k}?q", page(k, story + f"<p>number {k}</p>", '<div class="x-{k} text">{a}</div>' + (teaser if k == 5 else "")))
             for k in range(30)]
    pages += [(100, "https://other.example.com/", page(1, story)), (101, None, page(2, story)), (102, "no host", "plain  &amp; text"),
              (103, "https://site.example.com/e", None), (104, "https://site.example.com/f", ""), (104, "https://site.example.com/f", ""),
              (None, "https://site.example.com/g", "<nav>menu</nav>"), (105, "https://site.example.com/h", "<p>no such <i>path</i></p>")]
    df = spark.createDataFrame([(*p, "x", ["y"], 1) for p in pages], "page_id long, url string, html string, text string, winners array<string>, n int")
    got = {(r.page_id, r.text, r.n_chars) for r in main_text.extracted(df).collect()}
    about = " ".join(["This is what the page is about."] * 6)
    want = {(k, f"{about}\nnumber {k}") for k in range(30)} | {(100, about), (101, about), (102, "plain & text"), (103, ""), (104, ""), (None, ""),
                                                               (105, "no such path")}
    assert got == {(i, t, len(t)) for i, t in want}
    assert main_text.extracted(df).count() == len(pages)
    assert "teaser" in main_text.best(main_text.containers(main_text.parsed(pages[5][2])))  # by itself it would be wrong
    assert main_text.extracted(df.limit(0)).collect() == []


def test_given_pages_give_their_articles(spark):
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r.page_id: r.text for r in main_text.extracted(pages).collect()}
    assert len(texts) == pages.count()
    for r in pages.collect():
        inner = re.sub(r"</?(p|h1)>", "\0", r.html.split("<article>")[1].split("</article>")[0])
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " " if "br" in b else "", b)).split()) for b in inner.split("\0"))
        assert texts[r.page_id].split() == " ".join(b for b in blocks if b).split()


def test_reader_is_linear_on_malformed_pages():
    start = time.time()
    for bad in ["<" * 200_000, "<div>" * 50_000 + "x", '<a b="' * 100_000, "<!--" * 100_000, "<script>" * 50_000, "<a <a <a " * 50_000 + 'b=">"',
                "</x>" * 100_000, "<td>" * 30_000, "<p>" * 50_000 + "<b>" * 30_000, "&" * 200_000, "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000]:
        main_text.main_text(bad, [])
    assert time.time() - start < 20
    assert main_text.main_text("<div>" * 5_000 + "deep" + "</div>" * 5_000 + "<p>flat", ["html>body"]) == "deep\nflat"


# ---- nearest neighbours: repeated ids, several parts ---------------------------------------------------------------------

def test_rows_that_repeat_an_id_are_queries_and_candidates_each(spark):
    from aurum.llm import ann

    x = rng.normal(size=(600, 8))
    rows = [(k, x[k].tolist()) for k in range(500)] + [(20, x[500].tolist()), (0, x[501].tolist()), (7, x[502].tolist()), (7, x[7].tolist())]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), target=1.0, part_rows=64).collect()
    v, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    scores = ann.products(v, v)
    want, have = [], sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    for q in np.flatnonzero(ids % 20 == 0):
        others = np.array([k for k in np.lexsort((ids, -scores[q])) if k != q][:20])
        want += [(int(ids[q]), rank + 1, int(ids[k]), float(scores[q, k])) for rank, k in enumerate(others)]
    assert len(have) == len(want)
    assert len(set(have) & set(want)) >= 0.97 * len(set(want))  # several parts, all probes that the sample needs
    one = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), part_rows=10_000).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in one) == sorted(want)  # one part: exact


# ---- very long pre-tokens ------------------------------------------------------------------------------------------------

def test_long_pre_tokens_are_merged_as_the_library_does():
    import public_tokenizers
    import tiktoken

    from aurum.llm import bpe_replay

    ranks = bpe_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("x", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    letters = list("abcdefg éß日😀'.,")
    words = ["ab" * 3000, "a" * 5001, "".join(rng.choice(letters, 20_000)), "aab" * 1500, " " * 4000, "the " * 900]
    replay = bpe_replay.Replay(ranks)
    for word, got in zip(words, replay.encode([w.encode() for w in words])):
        assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(word), word[:20]
    start = time.time()
    got = replay.encode([b"ab" * 500_000])[0]
    assert b"".join(library.decode_single_token_bytes(i) for i in np.frombuffer(got, "<u4").tolist()) == b"ab" * 500_000
    assert time.time() - start < 30


# ---- context mixing ------------------------------------------------------------------------------------------------------

def test_mixed_orders_beat_a_dictionary_coder_per_block(spark):
    import public_tokenizers
    import zlib as z
    from tokenizers import Tokenizer

    from aurum.llm import range_coder

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    ids = np.concatenate([np.array(e.ids + [2], np.int32) for e in tokenizer.encode_batch(rows, add_special_tokens=False)])
    blocks = range_coder.encode(ids)
    assert (range_coder.decode(blocks, len(ids)) == ids).all()
    plain = sum(len(z.compress(ids[k:k + range_coder.BLOCK].astype("<u2").tobytes(), 9)) for k in range(0, len(ids), range_coder.BLOCK))
    assert sum(map(len, blocks)) < 0.88 * plain


@pytest.mark.parametrize("ids", [[], [5], [0] * 5000, [65535, 0] * 2100, list(range(4200)), [7] * 2048 + [9]])
def test_coder_round_trips(ids):
    from aurum.llm import range_coder

    x = np.array(ids, np.int32)
    assert (range_coder.decode(range_coder.encode(x), len(x)) == x).all()


def test_coder_sees_many_blocks_in_one_step(monkeypatch):
    from aurum.llm import range_coder

    made = []

    class Counted(range_coder.Lanes):
        def __init__(self, n):
            made.append(n)
            super().__init__(n)

    monkeypatch.setattr(range_coder, "Lanes", Counted)
    monkeypatch.setattr(range_coder, "BLOCK", 8)
    ids = np.random.default_rng(5).integers(0, 40, 2900 * 8).astype(np.int32)
    assert (range_coder.decode(range_coder.encode(ids), len(ids)) == ids).all()
    assert made == [2900, 2900]


def test_coded_bytes_stay_as_they_were():
    import zlib as z

    from aurum.llm import range_coder

    rng = np.random.default_rng(7)
    for ids, crc in ((np.minimum(rng.zipf(1.4, 9000), 49407), 1831240131), (np.repeat(rng.integers(0, 50, 3000), rng.integers(1, 9, 3000)), 3687963117)):
        assert z.crc32(b"".join(range_coder.encode(ids.astype(np.int32)))) == crc


def test_pieces_of_chunks_are_the_librarys():
    import json
    import random

    import public_tokenizers

    from aurum.llm.token_binary import Chunks

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        text = f.read()
    chunks = Chunks(text)
    letters = list("aAbzZ'stremvldSTREMVLD09.,$#_-<|>éÉßÿÞÀ×÷ªµº²½ΣςİıÅé́İ中я\x00\x1c\x1f\x7f\x85\xa0 \t\n\x0b")
    letters += ["<|startoftext|>", "<|endoftext|>", "'LL", "ﬁ"]
    rng = random.Random(3)
    rows = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(5000)]
    rows += [f"x{chr(k)}Y" for k in range(0x600)]
    want = [np.array(e.ids, "<u4").tobytes() for e in chunks.tokenizer.encode_batch(rows, add_special_tokens=False)]
    assert chunks.encode(rows) == want
    # a word is one piece, however it is written and whatever stands beside it
    chunks = Chunks(text)
    chunks.encode(["Straße straße, STRAßE. (straße)"])
    assert sorted(chunks.pieces) == ["(", ")", ",", ".", "straße"]
    # another splitter: nothing is split here
    other = json.loads(text)
    other["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[^\\s]+"
    chunks = Chunks(json.dumps(other))
    assert not chunks.by_piece
    assert chunks.encode(rows[:500]) == [np.array(e.ids, "<u4").tobytes() for e in chunks.tokenizer.encode_batch(rows[:500], add_special_tokens=False)]


def test_numbers_follow_first_occurrence():
    from aurum.llm import range_coder

    assert range_coder.numbered(np.array([[5, 5, 2, 9, 2, 5], [1, 2, 3, 3, 2, 1]])).tolist() == [[0, 0, 1, 2, 1, 0], [0, 1, 2, 2, 1, 0]]


# ---- the pipeline's defined cases ------------------------------------------------------------------------------------------

def test_pipeline_on_odd_and_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    words = [f"w{k}" for k in range(300)]

    def prose(n, seed):
        return " ".join(np.random.default_rng(seed).choice(words, n))

    passage = prose(55, 99)  # over 50 words, under 300 bytes
    assert 250 < len(passage) < 300
    rows = [(k, prose(80, k), "en", f"s{k % 2}", 1) for k in range(40)]
    rows += [(40, rows[3][1], "en", "s1", 1), (3, rows[3][1], "en", "s1", 1), (41, prose(40, 500) + " " + passage, None, None, None),
             (42, passage + " " + prose(40, 501), "en", "s0", 1), (43, None, None, None, None), (44, "", "en", "s0", 0), (None, prose(30, 502), "en", "s0", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", rows), ("empty", [])):
        base = str(tmp_path / name)
        df = spark.createDataFrame(docs, schema)
        for extra in ("row", "key", "node", "probability", "component", "__id"):
            df = df.withColumn(extra, F.lit(7))
        df.write.parquet(f"{base}/documents.parquet")
        labels.write.parquet(f"{base}/labels.parquet")
        kept = spark.read.parquet(f"{base}/documents.parquet")
        for stage, run in corpus_pipeline.STAGES[:3]:
            kept = run(spark, kept, base)
            assert kept.columns == list(corpus_pipeline.COLUMNS)
        got = kept.collect()
        if name == "empty":
            assert got == [] and corpus_pipeline.run(spark, base).collect() == []
            continue
        texts = {r.doc_id: r.text for r in got}
        assert len([r for r in got if r.text == rows[3][1]]) == 1              # one of the copies
        assert passage not in texts[41] and passage not in texts[42]           # a short passage that two documents share
        assert texts[0] == rows[0][1] and None in texts and 43 in texts and 44 in texts
        assert corpus_pipeline.run(spark, base).columns[0] == "doc_id"
