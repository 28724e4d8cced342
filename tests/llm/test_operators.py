"""Corpus operators against brute force, libraries and planted cases, and on the awkward inputs that each must survive."""

import base64
import hashlib
import io
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import html, importance, packing, pieces, queries, repetition, shingles, simhash, suffix, topk, toxicity, warc
from millrace.llm.common import stored

RNG = random.Random(7)
WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))


PASSAGE = prose(30)
LONG = prose(20_000)
AWKWARD = [None, "", " \n\t", "x", "a" * 400, "a" * 400, "日本語のテキスト" * 30, PASSAGE, f"{PASSAGE} {prose(40)}", f"{prose(40)} {PASSAGE}", LONG, "line one here\n" * 30, "\x00\x01", "the " * 100]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(AWKWARD)] + [(3, "x", None, None, None, "y"), (None, PASSAGE, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, fp string, score int, unit string")


def pdf(df):
    return df.toPandas().sort_values(df.columns, kind="stable").reset_index(drop=True)


# ---------------------------------------------------------------- 1


def cut_by_hand(rows):
    first = {}
    for d, t in sorted(((d, (t or "").encode()) for d, t in rows), key=lambda r: r[0]):
        for i in range(len(t) - 49):
            first.setdefault(t[i : i + 50], d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_suffix_dedup_equals_brute_force(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] is not None]
    base = [prose(60) for _ in range(30)]
    rows += [(100 + i, t) for i, t in enumerate(base)] + [(200 + i, t[RNG.randrange(50) :] + prose(5)) for i, t in enumerate(base)] + [(300 + i, base[3]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in suffix.cut_spans(df, unit_bytes=20_000).collect())
    assert got == cut_by_hand(rows)
    assert got == sorted(tuple(r) for r in suffix.cut_spans(df, unit_bytes=1 << 30).collect())


def test_suffix_dedup_on_tables(spark, data, awkward):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, data, "documents").collect()]
    assert sorted(tuple(r) for r in queries.op1_suffix(spark, data).collect()) == cut_by_hand(rows)
    assert suffix.cut_spans(awkward.limit(0)).count() == 0
    carried = suffix.cut_spans(awkward, keep_text=True, carry=("score", "unit"))
    assert carried.count() == len(AWKWARD) + 2 and dict(carried.dtypes)["carry0"] == "int"


def keys_of(strings):
    sizes = np.array([len(x) for x in strings], np.int64)
    return suffix.keys_of(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes)


def test_families_of_levels():
    """Every match, within a batch and across levels, comes from suffix arrays and equals brute force."""
    rng = random.Random(1)
    family, seen, lengths = suffix.Family(), {}, []
    for d in range(60):
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(50, 77))) if i % 3 else b"q" * rng.randrange(45, 70) + bytes([97 + i % 5]) * 6 for i in range(40)]
        strings += [s[rng.randrange(3) :] for s in strings[:5] if len(s) > 53]
        docs = np.array([2 * d + (i > 20) for i in range(len(strings))])
        masks = family.take(keys_of(strings), docs)
        for s, doc in zip(strings, docs, strict=True):
            for i in range(len(s) - 49):
                seen[s[i : i + 50]] = min(seen.get(s[i : i + 50], doc), doc)
        for s, doc, mask in zip(strings, docs, masks, strict=True):
            assert int(mask) == sum(1 << i for i in range(len(s) - 49) if seen[s[i : i + 50]] < doc)
        lengths.append(family.scan(suffix.distinct(keys_of(strings), docs)[0])[0].max())
    sizes = [len(x[0]) for x in family.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and max(lengths) > 60  # longer than LENGTH
    for ranked, _ in family.levels:
        assert [bytes(x) for x in suffix.bytes_of(ranked)] == sorted(bytes(x) for x in suffix.bytes_of(ranked))


def test_long_texts_are_cut_in_overlapping_pieces(monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 300)
    text = prose(400).encode()
    parts = list(suffix.pieces_of([b"", text, b"x" * 10]))
    assert sum(len(n) - 1 for _, n, _ in parts) > 5
    frame = pd.DataFrame({"doc_id": [1, 2], "text": [text.decode(), text.decode()]})
    anchors, many = suffix.Unit(frame).anchors()
    assert many.all() and len(anchors)


# ---------------------------------------------------------------- 2


def test_buckets_never_cross_texts():
    blobs = [b"", b"ab", b"abc", b"abcdef", b"", b"zzz"]
    whole = [np.split(f, np.cumsum(c)[:-1]) for f, c in importance.buckets(blobs)]
    for i, b in enumerate(blobs):
        for (f, _), parts in zip(importance.buckets([b]), whole, strict=True):
            assert f.tolist() == parts[i].tolist()


@pytest.mark.parametrize("k", [1, 2, 5, 17, 40])
def test_threshold_of_the_kth_key(spark, k):
    rows = [(i, float(i % 7)) for i in range(40)]
    key, last = importance.top_k_threshold(spark.createDataFrame(rows, "doc_id long, key double"), k, bins=4)
    assert (key, last) == [(v, i) for v, i in sorted(((v, i) for i, v in rows), key=lambda r: (-r[0], r[1]))][k - 1]


def test_importance_keeps_clean_texts(spark, data, awkward):
    docs, labels = queries.table(spark, data, "documents"), queries.table(spark, data, "labels")
    r = queries.op2_importance(spark, data).toPandas().merge(labels.toPandas(), on="doc_id")
    assert r[r.quality == 1].kept.mean() > 0.95 and r[r.quality == 0].kept.mean() < 0.5
    assert {x["doc_id"] for x in importance.accepted(docs, labels).collect()} == {x["doc_id"] for x in importance.resample(docs, labels).where("kept").collect()}
    assert importance.resample(awkward, labels.limit(0)).where("not kept").count() == 0
    assert importance.resample(awkward.limit(0), labels).count() == 0
    assert importance.accepted(awkward, labels.selectExpr("doc_id % 5 AS doc_id", "quality", "toxic")).columns == awkward.columns


def grams_by_hand(text):
    mask, out = (1 << 64) - 1, Counter()
    data = (text or "").encode()
    for n in (3, 4, 5):
        for i in range(len(data) - n + 1):
            x = (int.from_bytes(data[i : i + n], "big") * 8 + n) & mask
            x ^= x >> 31
            x = x * 0x9E3779B97F4A7C15 & mask
            x ^= x >> 29
            x = x * 0xD6E8FEB86659FD93 & mask
            out[(x ^ x >> 32) >> 48] += 1
    return out


def test_resampling_equals_brute_force(spark):
    rng = random.Random(11)
    good = [prose(rng.randrange(20, 60), rng) for _ in range(60)]
    odd = ["".join(rng.choice("#$%&zq 0") for _ in range(rng.randrange(0, 300))) for _ in range(40)]
    mixed = [f"{g[:200]} {o[: 4 * i]}" for i, (g, o) in enumerate(zip(good[:40], odd, strict=True))]  # from good to odd by steps
    texts = [*good, *odd, *mixed, None, "", good[0], "日本語" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    aimed = {i for i in range(0, 140, 2) if i < 60 or 100 <= i < 112}
    labels = spark.createDataFrame([(i, int(i in aimed)) for i in range(0, 140, 2)], "doc_id long, quality int")
    grams = [grams_by_hand(t) for t in texts]
    raw, target = sum(grams, Counter()), sum((g for i, g in enumerate(grams) if i in aimed), Counter())
    p, q = sum(target.values()) + importance.BUCKETS, sum(raw.values()) + importance.BUCKETS
    ratio = {b: np.log((target[b] + 1) / p / ((raw[b] + 1) / q)) for b in raw}
    weight = [round(sum(ratio[b] * n for b, n in g.items()), 6) for g in grams]
    value = [w * min(1, 256 / max(1, sum(g.values()))) for w, g in zip(weight, grams, strict=True)]
    aims = sorted(v for i, v in enumerate(value) if i in aimed)
    cut = aims[int(0.005 * (len(aims) - 1))]
    k = sum(v >= cut for v in value)
    plain = set(sorted(range(len(texts)), key=lambda i: (-value[i], i))[:k])
    noise = lambda i, seed: -np.log(-np.log(((np.uint64(hashes[seed][i]) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53))
    hashes = {seed: {r[0]: r[1] & (1 << 64) - 1 for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(seed))).collect()} for seed in range(12)}
    kept_of = []
    for seed in range(12):
        key = [v / importance.TEMPERATURE + noise(i, seed) for i, v in enumerate(value)]
        want = set(sorted(range(len(texts)), key=lambda i: (-key[i], i))[:k])
        if seed < 3:
            rows = importance.resample(docs, labels, seed=seed).collect()
            assert all(abs(r["log_weight"] - weight[r["doc_id"]]) < 1e-4 and abs(r["key"] - key[r["doc_id"]]) < 1e-4 and r["n_grams"] == sum(grams[r["doc_id"]].values()) for r in rows)
            assert {r["doc_id"] for r in rows if r["kept"]} == want
        kept_of.append(want)
    assert any(w != plain for w in kept_of)  # the draw decides, not the weights alone
    often = np.array([sum(i in w for w in kept_of) for i in range(len(texts))])
    order = np.argsort(value)
    border = order[len(order) - k - 6 : len(order) - k + 6]
    assert often[order[-50:]].mean() > often[border].mean() > often[order[:20]].mean()


def test_the_draw_decides_on_the_table(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    kept = []
    for seed in (1, 2):
        r = importance.resample(docs, labels, seed=seed).toPandas().sort_values("doc_id")
        value = r.log_weight * np.minimum(1, 256 / np.maximum(1, r.n_grams))
        plain = set(r.doc_id.to_numpy()[np.lexsort((r.doc_id, -value))[: r.kept.sum()]])
        kept.append(set(r.doc_id[r.kept]))
        assert 0.002 * len(r) <= len(plain ^ kept[-1]) <= 0.1 * len(r)
    assert kept[0] != kept[1]


# ---------------------------------------------------------------- 3


def test_archives(spark, data):
    rows = [(1, "http://a/ b", "same"), (5, "http://b", "same"), (3, None, "same"), (4, "u", None), (2, "u", ""), (9, "u", "é" * 5000), (None, "u", "same"), (7, "u", "own"), (7, "u", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.warc_round_trip(pages).collect()), key=repr)
    assert got == sorted([(1, "revisit", 5, 4), (5, "response", None, 4), (3, "revisit", 5, 4), (4, "response", None, 0), (2, "revisit", 4, 0), (9, "response", None, 10000), (None, "response", None, 4), (7, "response", None, 3), (7, "response", None, 3)], key=repr)
    assert warc.warc_round_trip(pages, min_bytes=4).where("payload_bytes = 0 and record_type = 'revisit'").count() == 0
    assert warc.warc_round_trip(pages.limit(0)).count() == 0
    table = {r["page_id"]: r["html"].encode() for r in queries.table(spark, data, "pages").collect()}
    for r in queries.op3_warc(spark, data).collect():
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(table[r["page_id"]]).digest()).decode() and r["payload_bytes"] == len(table[r["page_id"]])


def test_records_are_single_frames_after_a_dictionary():
    records = [warc.build_record(i, f"http://x/{i}", prose(50).encode(), None) for i in range(40)]
    data = warc.build_archive(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and [b for _, b in warc.read_records(io.BytesIO(data))] == [r.split(b"\r\n\r\n", 1)[1][:-4] for r in records]
    words = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    rest, frames = data[8 + size :], 0
    while rest:
        d = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        assert d.decompress(rest) == records[frames]
        rest, frames = d.unused_data, frames + 1
    assert frames == 40
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"\0" * 16)))


# ---------------------------------------------------------------- 4


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(400)] + [(400 + i, [0.5] * 16) for i in range(50)]
    rows += [(500, None), (501, [1.0, None]), (550, [float("nan")] * 16), (600, [float("inf")] + [0.0] * 15), (650, [1.0]), (651, [2.0]), (None, [1.0]), (700, [])]
    got = sorted(tuple(r) for r in topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), chunk=4, block=16).collect())
    good = {i: np.floor(np.array(v, np.float32).astype(float) * 256).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in good:
        if q % 50 == 0:
            scored = sorted(((int(-(good[q] @ v)), i) for i, v in good.items() if i != q and len(v) == len(good[q])))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pruning_skips_blocks():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 1000
    x = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 16)) * 10)
    index = topk.Blocks(np.arange(4000), x)
    q = x[:1]
    bounds = (np.maximum(q, 0) @ index.high.T + np.minimum(q, 0) @ index.low.T)[0]
    ids, scores = index.search(0, q[0], bounds, np.empty(0, np.int64), np.empty(0), 5)
    order = sorted((-(x[i] @ q[0]), i) for i in range(1, 4000))[:5]
    assert ids.tolist() == [i for _, i in order] and index.scored < 1000


# ---------------------------------------------------------------- 5


def test_packing(spark, data, awkward):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    for df in (queries.table(spark, data, "documents"), awkward):
        texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
        want = Counter()
        for d, x in texts:
            want[d, tuple([*t.encode(x, add_special_tokens=False).ids, 1])] += 1
        got = packing.pack(df, queries.tokenizer("word_bpe_49k.json")).toPandas()
        sizes = got.groupby("sequence_id").length.sum()
        assert sizes.max() <= 2048 and got.length.sum() == sum(len(ids) * n for (_, ids), n in want.items())
        ordered = got.sort_values(["sequence_id", "offset"])
        assert (ordered.offset == ordered.groupby("sequence_id").length.cumsum() - ordered.length).all()
        by_doc = {d: ids for (d, ids), n in want.items() if n == 1 and sum(k[0] == d for k in want) == 1}
        for d, part in got[got.doc_id.notna()].groupby("doc_id"):
            if d in by_doc:
                ids = np.array(by_doc[d], "<u4")
                at = 0
                for r in part.sort_values("start").itertuples():
                    assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(ids[at : at + r.length].tobytes()), len(ids))
                    at += r.length
                assert at == len(ids)
    assert packing.pack(awkward.limit(0), queries.tokenizer("word_bpe_49k.json")).count() == 0


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        pos = np.array(sorted({0, *(rng.randrange(1, 200) for _ in range(14))}))
        pos = np.unique(np.concatenate((pos, np.arange(0, pos[-1], 16))))
        cost = np.array([0, *(rng.choice([0, 2, 24]) for _ in pos[1:])])
        size = 32
        best = [0] + [10**9] * (len(pos) - 1)
        for j in range(1, len(pos)):
            for i in range(j):
                n = int(pos[j] - pos[i])
                if n <= size:
                    best[j] = min(best[j], best[i] + int(cost[j]) + size - n)
        cuts = [0, *packing.best_cuts(pos, cost, size)]
        assert sum(int(cost[b]) + size - int(pos[b] - pos[a]) for a, b in zip(cuts, cuts[1:], strict=False)) == best[-1]


def test_words_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    t, w = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json")), packing.WordTokenizer(queries.tokenizer("word_bpe_49k.json"))
    alphabet = "ab cdEéßΣσǺ \t\n\x1c\x85\xa0.!?'<|>0123日本𠀀▁  thes'll<|endoftext|>̈"
    texts = ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 60))) for _ in range(500)] + ["<|ENDOFTEXT|> <|endoftext|>x", "don't WE'LL it's '' ''s"]
    assert [x.tolist() for x in w.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_that_the_tokenizer_forgets_come_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "PIECE", 400)
    monkeypatch.setattr(packing, "CACHE", 30)
    monkeypatch.setattr(packing, "PART", 7)
    rng = random.Random(9)
    t, w = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json")), packing.WordTokenizer(queries.tokenizer("word_bpe_49k.json"))
    words = ["".join(rng.choice("abcDEé.,'1Σ日") for _ in range(rng.randint(1, 9))) for _ in range(200)] + ["<|endoftext|>", "x<|y", "plain", "Plain", "\x01"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    assert [x.tolist() for x in w.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(w.runs) < 200 and len(w.words) < 300


def test_known_words_take_few_bytes():
    import tracemalloc

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(8)) + rng.choice(["", ",", "."]) for _ in range(60_000)]
    w = packing.WordTokenizer(queries.tokenizer("word_bpe_49k.json"))
    texts = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for _ in w.encode(texts):
            pass
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert held < 150 * len(set(words))  # runs and words: 96, and 274 as dictionaries of Python objects


# ---------------------------------------------------------------- 6

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><header><h2>Site</h2></header>
<div class="cookie-notice"><p>We use cookies and say so at some length here.</p></div><div class="layout"><div class="post post-12"><h1>Title &amp; more</h1><p>First   <b>bold</b>&nbsp;text of the page, long enough.<p>Second&lt;p&gt; paragraph<br>here
is long too.</p><form><p>Search</p></form><div class="comments"><p>A reader comment that is rather long, longer than the article itself is, in fact, by some way.</p></div></div><aside><p>Other things</p></aside></div><footer><p>Foot</p></footer></body></html>"""
TEXT = "Title & more\n\nFirst bold text of the page, long enough.\n\nSecond<p> paragraph here is long too."


def test_main_text():
    assert html.extract(PAGE, []) == TEXT
    assert html.vote(PAGE).endswith("div.post.post-#")
    for broken in ("", "<", "<p", "</p></div>", "<!--", "<script>x", "<p>a<table><tr><td>b", "a < b & c", "<div hidden>x</div>", "<p a='>'>t</p>", "<![CDATA[x"):
        assert isinstance(html.extract(broken, []), str)
    assert html.extract("a < b &amp; c", []) == "a < b & c"
    for odd, text in (("a <中文> b", "a <中文> b"), ("a <été> b", "a <été> b"), ("a </3 x> b", "a b"), ("a </ p> b", "a b"), ("a </> b", "a b"), ("a </3 b", "a </3 b"), ("a <b c=\"x'> b", "a b"), ("a <", "a <"), ("a b<p", "a b")):
        assert html.extract(f"<div>{odd}</div>" if odd.endswith(" b") and "3 b" not in odd else odd, []) == text
        if odd.endswith("> b"):
            assert html.extract(f"<div><p>{odd}</p><p>The text after it.</p></div>", []) == f"{text}\n\nThe text after it."
    assert html.extract("<div>" * 3000 + "deep" + "</div>" * 3000, []) == "deep"


def test_article_of_nested_divs_is_whole():
    site = '<html><body><div class="top"><a href="/">Home of the site</a></div>{}<div class="bottom">Some site text</div></body></html>'
    long, lead = "body text " * 30, "lead text " * 10
    titled = site.format(f'<div class="post"><h1>The title</h1><div class="wrap"><div class="entry"><p>{long}</p></div></div></div>')
    split = site.format(f'<div class="layout"><div class="content"><div class="lead">{lead}</div><div class="body">{long}</div></div><div class="more"><a href="/a">Another article</a> <a href="/b">And one more</a></div></div>')
    for page, want, path in ((titled, f"The title\n\n{long.strip()}", "div.post"), (split, f"{lead.strip()}\n\n{long.strip()}", "div.content")):
        assert html.vote(page).endswith(f">{path}")
        assert html.extract(page, []) == html.extract(page, [html.vote(page)]) == want


LINES = "body text of the post, which goes on for a while. " * 6
READERS = "<div class='comments'><p>" + "A reader comment, longer than the article. " * 20 + "</p></div>"
WHOLE = [
    f'<div class="layout has-sidebar"><div class="post"><h1>T</h1><p>{LINES}</p></div></div>', f'<div id="content-with-comments"><article><h1>T</h1><p>{LINES}</p></article>{READERS}</div>',
    f'<div id="content-with-comments"><div class="post"><h1>T</h1><p>{LINES}</p></div>{READERS}</div>', f'<div class="page no-ads"><main><h1>T</h1><p>{LINES}</p></main></div>',
    f'<div class="page no-ads"><h1>T</h1><p>{LINES}</p></div>', f'<form action="x"><div class="c"><h1>T</h1><p>{LINES}</p></div><input><button>Go</button></form>', f'<nav>menu</nav><form><article><h1>T</h1><p>{LINES}</p></article></form>',
    f'<article><div class="entry-header"><h1>T</h1></div><p>{LINES}</p></article>', f'<div class="post"><div class="entry-header"><h1>T</h1></div><div class="entry"><p>{LINES}</p></div></div>', f'<article><header><h1>T</h1></header><p>{LINES}</p></article>',
    f'<header><h1>Site</h1><nav>x</nav></header><div class="post"><header><h1>T</h1></header><p>{LINES}</p></div>', f'<div class="post comments-open"><h1>T</h1><p>{LINES}</p></div>{READERS}',
    f'<div class="post"><h1>T</h1><p title="the hidden valley">{LINES}</p><p hidden>no</p><p style="display: none">no</p><p aria-hidden="true">no</p></div>',
    f'<div class="post"><h1>T</h1><p>body <span hidden>no<b>no</b></span>{LINES[5:]}</p></div>', f'<div class="post"><h1>T</h1><p>{LINES.strip()[:-1]}<label>.</label></p><object>no</object><svg><text>no</text></svg><dialog>no</dialog></div>',
    f'<div class="post"><h1>T</h1><p>{LINES.strip()[:-1]}<math><mo>.</mo></math></p></div><div class="sidebar"><article class="teaser">{"tease " * 300}</article></div>',
    f'<div class="wrap"><div class="post"><h1>T</h1><p>{LINES}</p></div><div class="related-posts"><h2>Rel</h2><p>{"tease " * 300}</p></div></div>',
    f'<main><article class="post hentry"><header class="entry-header"><h1 class="header">T</h1></header><p>{LINES}</p><div class="share-buttons">Share</div><footer>me</footer></article><ol class="comment-list"><li><article class="comment-body">{"Nice. " * 400}</article></li></ol></main><aside>side</aside>',
]


@pytest.mark.parametrize("body", WHOLE)
def test_articles_are_whole(body):
    page = f"<html><body>{body}</body></html>"
    assert html.extract(page, []) == html.extract(page, [html.vote(page)]) == "T\n\n" + LINES.strip()


def test_pages_without_an_article_are_empty():
    for body in ("<nav>Menu</nav>", READERS, "<div class='ad'>Buy this</div>", "<footer>Foot</footer>", "<p hidden>x</p>", "<script>x</script>"):
        assert html.extract(f"<body>{body}</body>", []) == ""


def test_hostile_pages_take_time_in_proportion():
    import time

    for part in ("<b>x", "<i><div>", "<p><b>x", "<form>x", "<article>", "<div class=ad>x", "<li><span>", "<table><tr><td>"):
        began = time.process_time()
        html.extract(part * 8000, [])
        assert time.process_time() - began < 5, part
    began = time.process_time()
    assert len(html.extract("<article><h1>T</h1>" + f"<p>{prose(40)}</p>" * 4000 + "</article>", [])) > 500_000
    assert time.process_time() - began < 10


def test_consensus_helps_a_page_that_votes_otherwise(spark, data):
    other = "<html><body><div class='x'><p>" + "teaser text " * 40 + "</p></div><div class='post'><p>Short.</p></div></body></html>"
    usual = "<html><body><div class='x'><p>t</p></div><div class='post'><p>" + "main text " * 40 + "</p></div></body></html>"
    rows = [(i, "https://h.example/1", usual) for i in range(9)] + [(9, "https://h.example/2", other), (10, None, None), (11, "https://k.example", ""), (None, "x", "<p>loose</p>")]
    got = {r["page_id"]: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9]["text"] == "Short." and got[9]["n_chars"] == 6 and got[10]["text"] == "" and got[11]["text"] == "" and got[None]["text"] == "loose"
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    pages = {r["page_id"]: r["html"] for r in queries.table(spark, data, "pages").collect()}
    for r in queries.op6_html(spark, data).collect():
        inner = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["text"].replace("\n\n", " ").split() == __import__("html").unescape(__import__("re").sub("<[^>]*>", " ", inner)).split()


def test_salted_join_gives_the_same(spark, data, monkeypatch):
    want = pdf(queries.op6_html(spark, data))
    monkeypatch.setattr(html, "MAX_BROADCAST", -1)
    assert pdf(queries.op6_html(spark, data)).equals(want)


# ---------------------------------------------------------------- 7


def fingerprint_by_hand(text):
    import xxhash

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, data, awkward):
    for df, block in ((queries.table(spark, data, "documents").select("doc_id", "text"), 8192), (queries.table(spark, data, "documents").select("doc_id", "text"), 8), (awkward, 8192)):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect() if r["doc_id"] is not None]
        fps = [fingerprint_by_hand(t) for _, t in rows]
        comps = linked(fps, [i for i, _ in rows])
        want = sorted((i, f"{f:016x}", comps[i]) for (i, _), f in zip(rows, fps, strict=True))
        assert sorted(tuple(r) for r in simhash.simhash_components(df, block=block).collect()) == want
    assert simhash.simhash_components(awkward.limit(0)).count() == 0
    assert simhash.representatives(awkward).columns == awkward.columns


def test_tries():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64) * np.uint64(2)
    x = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) for _ in range(6)]))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    want = simhash.components(len(x), *np.nonzero(near))
    for leaf, batch in ((1, 64), (16, 1 << 21)):
        assert (simhash.trie_links(x, None, 3, leaf, batch) == want).all()
        both = np.concatenate((x[::2], x[1::2]))
        n = len(x[::2])
        u, v = np.nonzero(near[::2, 1::2])
        assert (simhash.trie_links(both[:n].copy(), both[n:].copy(), 3, leaf, batch) == simhash.components(len(x), u, v + n)).all()


def test_long_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 100)], "a long, b long")
    assert {tuple(r) for r in simhash.star_components(edges).collect()} == {*((i, 0) for i in range(1, 61)), (200, 100)}
    assert simhash.star_components(edges.limit(0)).count() == 0


def near_by_hand(rows):
    """The least id of each row's component of five-word shingles at a Jaccard similarity of at least 0.8."""
    sets = {}
    for d, t in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.setdefault(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset(), []).append(d)
    keys = list(sets)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            if 10 * len(keys[a] & keys[b]) >= 8 * len(keys[a] | keys[b]):
                root[find(a)] = find(b)
    least = {}
    for i, k in enumerate(keys):
        least[find(i)] = min([least.get(find(i), 1 << 62), *sets[k]])
    return sorted((d, least[find(i)]) for i, k in enumerate(keys) for d in sets[k])


def test_stage_of_near_duplicates_equals_brute_force(spark, data, awkward):
    import corpus_pipeline as C

    rng = random.Random(3)
    rows = []
    for _ in range(40):  # chains of copies with ever more edits, on both sides of the threshold
        words = prose(rng.randrange(6, 160), rng).split()
        for _ in range(6):
            rows.append((len(rows), " ".join(words)))
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
    base = prose(120, rng).split()
    for k in range(60):  # one large group, whose last members are like some others only
        words = base.copy()
        for _ in range(1 + k // 20):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), rows[0][1].upper()), (3, "another text of a known id")]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (planted, queries.table(spark, data, "documents").select("doc_id", "text"), awkward.select("doc_id", "text")):
        rows = [tuple(r) for r in df.collect()]
        want = near_by_hand([r for r in rows if r[0] is not None])
        assert sorted(tuple(r) for r in shingles.jaccard_components(df, block=8).collect()) == want
        chosen = {c for _, c in want}
        assert Counter(map(tuple, C.near_duplicates(spark, df, data).collect())) == Counter(r for r in rows if r[0] is None or r[0] in chosen)
    assert len({c for _, c in near_by_hand([tuple(r) for r in planted.collect()])}) < planted.count() / 2


def test_stage_of_near_duplicates_joins_tries(spark):
    """Fingerprints within the radius make candidates, whatever the buckets; a class without shingles has none."""
    rows = [(5, 0b0111, [51]), (9, 0, [91]), (7, 0, [71]), (20, -1, [21]), (30, 0b1111 << 40, [31]), (40, 1, [])]
    found = shingles.candidates(spark.createDataFrame(rows, "key long, fp long, bands array<long>"))
    assert sorted(tuple(r) for r in found.collect()) == [(5, 5), (7, 5), (9, 5)]
    found = shingles.shingles(prose(90, random.Random(4)))
    assert shingles.fingerprint(found) & (1 << 64) - 1 == sum(1 << k for k in range(64) if 2 * sum(int(h) >> k & 1 for h in found) > len(found))
    assert shingles.fingerprint(found[:0]) == 0


def test_parts_of_a_bucket_keep_every_match(spark, data):
    """Buckets of several sizes, each indexed in parts, cut alike."""
    docs = queries.table(spark, data, "documents")
    several = sorted(map(tuple, suffix.cut_spans(docs, unit_bytes=1 << 16).collect()))
    assert sum(r[2] for r in several) and suffix.SUBS > 1
    anchors = np.arange(1 << 12, dtype=np.uint64) << np.uint64(16)
    assert set(suffix.sub_of(anchors).tolist()) == set(range(suffix.SUBS))
    assert several == sorted(map(tuple, suffix.cut_spans(docs).collect()))


# ---------------------------------------------------------------- 8


def rules_by_hand(text):
    text = text or ""
    words = repetition.WORD.findall(text)
    grams = defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    again = {k for at in grams.values() if len(at) > 1 for i in at for k in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if repetition.WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again), failed


def test_repetition_rules(spark, data, awkward):
    for df in (queries.table(spark, data, "documents"), awkward):
        want = sorted(((r["doc_id"], *rules_by_hand(r["text"])) for r in df.select("doc_id", "text").collect()), key=repr)
        rows = repetition.repetition_rules(df).collect()
        assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in rows), key=repr) == want
        assert not any(r["kept"] and r["base_failed"] for r in rows)
    phrase = "one two three four five six seven eight nine ten eleven twelve"
    clean, looped = prose(200), prose(60) + (" " + phrase) * 4
    assert repetition.measure(clean)[-1] and not repetition.measure(looped)[-1]
    assert repetition.repetition_rules(awkward.limit(0)).count() == 0


# ---------------------------------------------------------------- 9


def test_toxicity(spark, data, awkward):
    labels = queries.table(spark, "/root/testdata/sf0.01", "labels")
    r = queries.op9_toxicity(spark, "/root/testdata/sf0.01").toPandas().merge(labels.toPandas(), on="doc_id")
    held = r[r.held_out]
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == h for d, h in zip(r.doc_id, r.held_out, strict=True))
    assert (held.predicted == held.toxic).mean() > 0.95 and held[held.toxic == 0].predicted.sum() == 0 and r.score.between(0, 1).all()
    empty = toxicity.toxicity(awkward, labels.limit(0)).collect()
    assert len(empty) == len(AWKWARD) + 2 and {x["score"] for x in empty} == {0.5}
    assert toxicity.toxicity(awkward.limit(0), labels).count() == 0


def test_counterfactual_sentences():
    pairs = list(toxicity.counterfactuals("A muslim neighbour came. Nothing here.\nThe Woman and the man spoke!", 5))
    assert pairs == [({"a", "muslim", "neighbour", "came"}, {"a", "christian", "neighbour", "came"}), ({"the", "woman", "and", "man", "spoke"}, {"the", "man", "and", "spoke"})]
    mentioned = list(toxicity.counterfactuals("No group. At all.", 8))
    assert len(mentioned) == 2 and mentioned[0][0] - mentioned[0][1] == {toxicity.TERMS[1]} and mentioned[1][1] - mentioned[1][0] == {toxicity.SWAP[toxicity.TERMS[1]]}
    assert [list(toxicity.counterfactuals(t, 1)) for t in (None, "", " .\n")] == [[], [], []]


def test_the_penalty_is_minimised(spark):
    """The fit against a plain descent on the same sum."""
    rng = np.random.default_rng(2)
    x, y = np.hstack([rng.integers(0, 2, (60, 4)), np.ones((60, 1))]).astype(float), rng.integers(0, 2, 60).astype(float)
    left, right = x[:20].copy(), x[:20].copy()
    right[:, 0], right[:, 1] = left[:, 1], left[:, 0]
    w = toxicity.newton(x, y, np.ones(60), (left, right), np.zeros(5), 0.3, 10.0, 60)
    sig = lambda z: 1 / (1 + np.exp(-z))

    def value(v):
        return (np.logaddexp(0, x @ v) - y * (x @ v)).sum() + (0.3 * v[:-1] ** 2).sum() / 2 + 1e-6 * v[-1] ** 2 / 2 + 5 * ((sig(left @ v) - sig(right @ v)) ** 2).sum()

    v, step = np.zeros(5), 0.5
    while step > 1e-7:
        better = [v + d for d in step * np.vstack([np.eye(5), -np.eye(5)]) if value(v + d) < value(v)]
        v, step = (min(better, key=value), step) if better else (v, step / 2)
    assert value(w) <= value(v) + 1e-6


def test_counterfactuals_lower_false_positives_on_mentions(spark):
    """Texts of the table, in which toxic ones mention a group far more often than clean ones do."""
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(100))
    biased = docs.join(labels, "doc_id", "left").withColumn("text", F.when(((F.col("toxic") == 1) & (share < 90)) | ((F.col("toxic") == 0) & (share < 2)), F.concat("text", F.lit(" muslim."))).otherwise(F.col("text"))).select("doc_id", "text")
    clean = [r["text"] or "" for r in docs.join(labels, "doc_id").where("toxic = 0").select("text").collect()]
    insulting = [r["text"] for r in docs.join(labels, "doc_id").where("toxic = 1").select("text").collect()]
    scores = {}
    for fairness in (0.0, toxicity.FAIRNESS):
        model = toxicity.train(biased, labels, fairness=fairness)
        scores[fairness] = np.array([model.score(f"{t} muslim") for t in clean]), np.array([model.score(t) for t in insulting])
    unfair, fair = scores[0.0], scores[toxicity.FAIRNESS]
    assert (fair[0] >= 0.5).mean() < 0.5 * (unfair[0] >= 0.5).mean() and fair[0].mean() < unfair[0].mean()
    assert (fair[1] >= 0.5).mean() > 0.5


# ---------------------------------------------------------------- 10


def test_pieces_equal_the_library(spark, data, awkward):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    model = pieces.PieceModel(queries.tokenizer("piece_bpe_32k.model"))
    alphabet = "ab cdeéßΣ \t\n.!?'<|>0123日本𠀀▁▁  the<s>"
    texts = ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 60))) for _ in range(500)] + ["a" * 20_000, "  " * 7000, " " * 501 + "the" + " " * 99, "ab" * 9000, "�\x00", LONG, "日本語のテキストはスペースなし" * 1500, "".join(RNG.choice(["the", "community", "understand", "ing"]) for _ in range(3000))]
    for x, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == sp.encode(x, add_bos=True, add_eos=True)
        assert model.decode(ids) == sp.decode(ids.tolist())
    next(model.encode(["".join(RNG.choice(["nation", "fox", "working"]) for _ in range(3000))]))
    assert 0 < model.rounds < 1000  # of many thousand merges
    for _ in range(200):
        ids = np.array([RNG.choice([RNG.randrange(3, 259), RNG.randrange(259, 32000)]) for _ in range(12)])
        assert model.decode(ids) == sp.decode(ids.tolist())
    for df in (queries.table(spark, data, "documents"), awkward):
        want = []
        for r in df.select("doc_id", "text").collect():
            ids = sp.encode(r["text"] or "", add_bos=True, add_eos=True)
            want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
        got = pieces.encode_texts(df, queries.tokenizer("piece_bpe_32k.model"), with_ids=False)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert pieces.encode_texts(awkward.limit(0), queries.tokenizer("piece_bpe_32k.model")).count() == 0


# ---------------------------------------------------------------- ids


BIG = 2**53


def test_ids_of_any_size_survive_beside_a_null(spark, data):
    """Each operator over one batch that holds a null id, ids that no double can hold, and clashing column names."""
    import corpus_pipeline as C

    ids = [BIG + 1, BIG + 3, None, -BIG - 1, 2**63 - 1]
    texts = [prose(70), prose(70), prose(70), PASSAGE, f"{PASSAGE} {prose(60)}"]
    clash = "a AS doc_id2, 'x' AS digest, 1L AS refers_to, 'h' AS host, 'f' AS fp, 1 AS rep, true AS kept, 'k' AS __gone, 1L AS code"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, lang string, source string, n_chars long, a int").coalesce(1).selectExpr("doc_id", "text", "lang", "source", "n_chars", *clash.split(", "))
    labels = spark.createDataFrame([(BIG + 1, 1, 0), (BIG + 3, 1, 1), (2**63 - 1, 0, 1)], "doc_id long, quality int, toxic int")
    pages = docs.selectExpr("doc_id AS page_id", "'http://h/' AS url", "concat('<article><p>', text, '</p></article>') AS html", "digest", "refers_to", "host")
    name = queries.tokenizer
    some, every = Counter(i for i in ids if i is not None), Counter(ids)
    found = {
        "op1": suffix.cut_spans(docs), "op3": warc.warc_round_trip(pages), "op5": packing.pack(docs, name("word_bpe_49k.json")), "op6": html.main_text(pages), "op8": repetition.repetition_rules(docs),
        "op9": toxicity.toxicity(docs, labels), "op10": pieces.encode_texts(docs, name("piece_bpe_32k.model")),
    }
    for op, df in found.items():
        column = "page_id" if op in ("op3", "op6") else "doc_id"
        seen = [r[0] for r in df.select(column).collect()]
        assert Counter(set(seen) if op == "op5" else seen) == every, op
    assert Counter(r["doc_id"] for r in importance.resample(docs, labels).collect()) == some
    assert Counter(r["doc_id"] for r in simhash.simhash_components(docs).collect()) == some
    same = pages.withColumn("html", F.lit("one payload"))
    assert {(r["page_id"], r["refers_to"]) for r in warc.warc_round_trip(same).collect()} == {(i, 2**63 - 1 if i is not None and i != 2**63 - 1 else None) for i in ids}
    vectors = spark.createDataFrame([(i, [1.0, 2.0]) for i in [*ids, 50 * (BIG // 50 + 1)]], "vec_id long, embedding array<float>")
    assert {r["vec_id"] for r in topk.exact_top_k(vectors).collect()} == set(some)
    for label, stage in C.STAGES:
        assert {r["doc_id"] for r in stage(spark, docs, data).select("doc_id").collect()} <= set(ids), label


def test_archives_by_digest_and_salt(spark, data, monkeypatch):
    want = pdf(queries.op3_warc(spark, data))
    monkeypatch.setattr(warc, "MAX_HELD", -1)
    monkeypatch.setattr(warc, "TASK_BYTES", 1 << 16)
    assert pdf(queries.op3_warc(spark, data)).equals(want)


def test_deals_meet_every_pair_and_copies_stay_linear(spark):
    assert [len(simhash.deals(n, 3, 8192)[0]) for n in (10, 10**6, 10**8, 10**11)] == [4, 4, 4, 10]
    rng = np.random.default_rng(3)
    fps = rng.permutation(np.unique(rng.integers(-(2**63), 2**63 - 1, 4000, dtype=np.int64)))
    classes = spark.createDataFrame(pd.DataFrame({"fp": fps, "rep": np.arange(len(fps))}))
    copies = [simhash.dealt(classes.limit(n), 3, 64).count() / n for n in (500, 3900)]
    assert max(copies) <= 4 * 2  # a class in each deal, and in a few chunks


def test_session_settings_stay(spark, data):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    queries.op8_repetition(spark, data).count()
    assert spark.conf.get(key) == before


def test_no_folder_of_its_own_on_a_cluster():
    from types import SimpleNamespace

    from millrace.llm.common import shared_dir

    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077")))


# ---------------------------------------------------------------- pipeline


def test_stage_of_substring_dedup_equals_brute_force(spark):
    import corpus_pipeline as C

    texts = [PASSAGE, f"{PASSAGE} {prose(20)}", f"{prose(20)} {PASSAGE} {prose(20)}", prose(40), "日本語のテキスト" * 20, f"x {'日本語のテキスト' * 10}", None, ""]
    docs = spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_chars long")
    got = C.substring_dedup(spark, docs, "").collect()
    kept = {d: digest for d, _, _, _, digest in cut_by_hand(list(enumerate(texts)))}
    assert {r["doc_id"] for r in got} == set(kept) and len(got) == len(texts)
    for r in got:
        assert hashlib.sha256((r["text"] or "").encode()).hexdigest() == kept[r["doc_id"]] and r["n_chars"] in (None, len(r["text"] or "")) and r["lang"] == "en"
    assert sum(len(r["text"] or "") for r in got) < sum(len(t or "") for t in texts)


def test_pipeline(spark, data):
    import corpus_pipeline as C

    docs = queries.table(spark, data, "documents")
    names = docs.columns
    before = docs
    for name, stage in C.STAGES[:-1]:
        after = stored(stage(spark, before, data), "test")
        assert after.columns == names and after.dtypes == docs.dtypes, name
        assert 0 < after.count() <= before.count()
        before = after
    texts = [(r["doc_id"], r["text"]) for r in before.collect()]
    packed = C.run(spark, data)
    assert packed.agg(F.sum("length")).first()[0] == packed.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {d for d, _ in texts}
    odd = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, odd, data).count() == 0
    nulls = docs.limit(3).select(F.col("doc_id"), *(F.lit(None).cast(t).alias(c) for c, t in docs.dtypes[1:]), F.lit(1).alias("kept"))
    for _, stage in C.STAGES:
        stage(spark, nulls, data).collect()


def test_queries_are_registered_and_match_sql(spark, data):
    import duckdb

    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op")} and "pipeline" in entry.queries()
    c = duckdb.connect()
    for name in ("embeddings", "documents"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        found = entry.queries()[name](spark, data)
        columns = sorted(found.columns)
        cursor = c.execute(sql)
        at = [[d[0] for d in cursor.description].index(n) for n in columns]
        assert sorted((tuple(r[n] for n in columns) for r in found.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=repr), name
