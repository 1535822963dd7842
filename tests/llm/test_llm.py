"""The training-data operators against the libraries they follow, brute force and hand-made cases."""

import hashlib
import re
import random
import time

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from quillset.llm import ann, bpe, dedup, htmltext, jaccard, langid, licenses, mixing, tokencount, warc
from quillset.llm.queries import PIECE_BPE, WORD_BPE

LONG = "long " * 30_000 + "x" * 5_000
TEXTS = [
    None, "", " \n\t", "a", "Hello  World, it's 42 o'clock", "Σίσυφος ΟΔΟΣ", "x<|startoftext|>y<|endoftext|>", "<|", "½²a1b22", "日本語テスト",
    "<s> </s> <unk> <0x41>", "▁▁ ▁a", "tab\tnl\n\nx", "😀 ok", "a b　c", "don’t… “quote”", "foo_bar__baz", LONG, "a" * 500, "a", "a\r\n b", "a b",
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts with repeated rows, a null key's text and columns whose names an operator might want."""
    rows = [(i, t, "en" if i % 2 else None, "s", 1.0) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_bpe_agrees_with_the_library(docs, empty):
    library = tokenizers.Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    coded = {r.doc_id: r for r in bpe.encode_decode(docs, WORD_BPE).collect()}
    digests = {r.doc_id: r for r in bpe.round_trip_digests(docs, WORD_BPE).collect()}
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (coded[i].token_ids, coded[i].decoded) == (ids, decoded)
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    again = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE)
    assert {r.doc_id: r.decoded for r in again.collect()} == {i: r.decoded for i, r in coded.items()}
    assert bpe.round_trip_digests(empty, WORD_BPE).count() == 0


def test_token_counts_agree_with_the_library(docs, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    found = {r.doc_id: r for r in tokencount.sized(docs, PIECE_BPE, limit=100).collect()}
    for i, text in enumerate(TEXTS):
        n = len(library.encode(text or ""))
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len((text or "").encode()), n, n > 100)
    assert tokencount.sized(empty, PIECE_BPE).count() == 0


def test_token_counts_of_pieces_side_by_side():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    tables = tokencount.Pieces(PIECE_BPE)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(library.get_piece_size())]
    mixed = [p for p in pieces if not p.strip().isalpha()]
    signs = [*" .,;:!?²³½¼Ⅷ①m-_/()'\"\n\t01aé日"]
    draw = random.Random(2)
    assert tables.count("an area of 10 m².") == len(library.encode("an area of 10 m².")) == 8
    for _ in range(20_000):
        text = "".join(draw.choice([draw.choice(pieces), draw.choice(mixed), draw.choice(signs), draw.choice(signs)]) for _ in range(draw.randrange(1, 12)))
        assert tables.count(text) == len(library.encode(text)), text


def components(texts):
    """doc -> (size of its set, smallest doc reachable), by brute force."""
    sets, parent = {}, {i: i for i in texts}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_components(spark, docs, empty):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()} == components(dict(enumerate(TEXTS)))
    assert jaccard.jaccard_components(empty).count() == 0
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    shared = " ".join(draw.choices(words, k=60))
    texts = {}
    for group in range(12):  # chains of near copies, some with a shared passage
        base = draw.choices(words, k=draw.choice([6, 40, 120]))
        for _ in range(12):
            base = base[:]
            for _ in range(draw.choice([0, 1, 1, 2])):
                base[draw.randrange(len(base))] = draw.choice(words)
            texts[len(texts)] = " ".join(base) + (" " + shared if group % 3 == 0 else "")
    rows = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(rows).collect()} == components(texts)


def test_trees_leave_no_link_out():
    draw = np.random.default_rng(3)
    base = [draw.integers(0, 2**63, size=n).astype(np.uint64) for n in (3, 60, 300, 1500, 1100)]
    sets = []
    for rows in base:
        for _ in range(9):
            cut = rows.copy()
            at = draw.integers(0, len(rows), size=len(rows) // 12)
            cut[at] = draw.integers(0, 2**63, size=len(at)).astype(np.uint64)
            sets.append(np.unique(cut[: len(rows) - draw.integers(0, 1 + len(rows) // 10)]))
    leaves = [jaccard.Leaf(i, len(s), i, jaccard.bitmap(s)) for i, s in enumerate(sets)]
    found = set(jaccard.tree_pairs(leaves))
    halves = set(jaccard.tree_pairs(leaves[::2], leaves[1::2]))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 180 * common >= 80 * (len(sets[a]) + len(sets[b])):
                assert (a, b) in found
                assert a % 2 == b % 2 or (a, b) in halves
    assert len(found) < 700  # of 990


def test_exact_dedup_and_a_second_batch(spark, docs, empty, tmp_path):
    index = dedup.DigestIndex.open(spark, str(tmp_path / "index"), 4)
    found = {r.doc_id: r for r in dedup.exact_dedup(docs, index).collect()}
    texts = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in enumerate(TEXTS)}
    for i, text in texts.items():
        same = [j for j, other in texts.items() if other == text]
        assert (found[i].keep_id, found[i].group_size, found[i].kept) == (min(same), len(same), i == min(same))
        assert found[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    index.close()
    later = dedup.DigestIndex.open(spark, str(tmp_path / "index"), 8)  # taken up again, with its own number of buckets
    assert later.buckets == 4
    assert later.table().count() == len(set(texts.values()))
    batch = spark.createDataFrame([(100, "a  b"), (101, "new"), (102, "new")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in dedup.exact_dedup(batch, later).collect()} == {(100, 20, False), (101, 101, True), (102, 101, False)}
    assert dedup.exact_dedup(empty, later).count() == 0
    later.close()


def test_mixing_meets_its_targets(spark, empty):
    draw = random.Random(1)
    kinds = {"good": "sun tree river", "poor": "lorem ipsum dolor", "toxic": "hate scorn spite"}
    rows = [(i, " ".join(draw.choices(kinds[k].split() + ["the", "of"], k=40)), k) for i, k in enumerate(draw.choices([*kinds], [6, 3, 1], k=400))]
    docs = spark.createDataFrame([*((i, t) for i, t, _ in rows), (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k if i % 3 else None) for i, _, k in rows], "doc_id long, domain string")
    target = {"good": 0.5, "poor": 0.48, "toxic": 0.02}
    found = mixing.mixed(docs, labels, target)
    assert found.count() == 402 and found.filter("rate < 0 OR rate IS NULL").count() == 0
    known, domains = mixing.posteriors(docs, labels, "doc_id", "text")
    rates = mixing.fitted_rates(known, domains, target)
    sums = [r for r in rates.agg(*[F.sum(F.expr(f"n_tokens * p[{k}] * rate")) for k in range(3)]).first()]
    assert np.allclose(np.array(sums) / sum(sums), [target[d] for d in domains], atol=0.02)
    truth = {i: k for i, _, k in rows}
    assert sum(r.domain == truth.get(r.doc_id, r.domain) for r in found.collect()) > 390
    # against a dense solve of the same least squares by many steps of the same projection
    table = known.collect()
    n, p = np.array([r.n_tokens for r in table], dtype=float), np.array([r.p for r in table])
    have = (n[:, None] * p).sum(axis=0)
    want = np.array([target[d] for d in domains]) * have.sum()
    r = np.ones(len(n))
    for _ in range(3000):
        got = (n[:, None] * p * r[:, None]).sum(axis=0)
        r = np.maximum(0, r - (p @ ((got - want) / have) + mixing.RIDGE * (r - 1)) / (1 + mixing.RIDGE))
    exact = (n[:, None] * p * r[:, None]).sum(axis=0)
    assert np.allclose(exact / exact.sum(), np.array(sums) / sum(sums), atol=2 * mixing.TOLERANCE)
    once = mixing.fitted_rates(known, domains, {"good": 0.7, "poor": 0.2, "toxic": 0.1}, once=True)
    sums = [r for r in once.agg(*[F.sum(F.expr(f"n_tokens * p[{k}] * rate")) for k in range(3)]).first()]
    assert np.allclose(np.array(sums) / sum(sums), [0.7, 0.2, 0.1], atol=0.01) and once.filter("rate > 1").count() == 0
    kept = mixing.keep_mixed(docs.withColumn("rate", F.lit("mine")).withColumn("kept_0", F.lit(1)), labels, target)
    assert kept.columns == ["doc_id", "text", "rate", "kept_0"] and 0 < kept.count() < 402
    again = docs.union(docs.filter("doc_id < 5"))
    assert mixing.mixed(again, labels, target).count() == 407
    assert mixing.mixed(empty, labels).count() == 0
    assert {r.rate for r in mixing.mixed(docs, labels.limit(0)).collect()} == {1.0}


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>menu</a></nav><div class='cookie-notice'>ok?</div>"
        "<article><h1>Head &amp; line</h1><p>One <b>two<br>three</p><p>Four &lt;five&gt;<ul><li>six<li>seven</ul><div class=\"ad\">buy</div>"
        "<form><input value=a>send</form><script>var t='</p>'</script></article><aside>side</aside><section id=comments><p>me too</p></section><footer>f</footer></body></html>"
    )
    assert htmltext.main_text(page) == "Head & line\n\nOne two three\n\nFour <five>\n\nsix\n\nseven"
    assert htmltext.main_text("") == htmltext.main_text("<p></p>") == ""
    assert htmltext.main_text("plain  text") == "plain text"
    assert htmltext.main_text("<div><p>cut of<p>f at <b") == "cut of\n\nf at"


def test_hosts_agree_on_a_path(spark):
    usual = "<body><div class='box'><a>m m m m</a></div><div class='story 12'><p>{}</p></div><div class='more'><p>{}</p></div></body>"
    rows = [(i, "http://h.example/1", usual.format("text " * 60, "x")) for i in range(9)] + [(9, "http://h.example/2", usual.format("short", "other " * 90))]
    rows += [(10, None, None), (11, "http://h.example/3", "")]
    found = {r.page_id: r for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[9].text == "short" and found[0].n_chars == len(found[0].text) == 299
    assert (found[10].text, found[11].text, len(found)) == ("", "", 12)


def test_search_finds_the_nearest(spark):
    draw = np.random.default_rng(0)
    vectors = draw.standard_normal((3000, 16)).astype(np.float32)
    vectors[100:400] = vectors[100]  # copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] * 16), (5080, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.search(df, F.col("vec_id") % 20 == 0, k=20)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    data, hits = vectors.astype(np.float64), 0
    assert sorted(got) == [*range(0, 3000, 20)]
    for q, ranks in got.items():
        scores = data @ data[q]
        scores[q] = -np.inf
        order = np.lexsort((np.arange(3000), -np.round(scores, 9)))[:20]
        hits += len({i for i, _ in ranks.values()} & set(order.tolist()))
        assert sorted(ranks) == [*range(1, 21)]
        assert all(abs(s - scores[i]) < 1e-9 for i, s in ranks.values())
    assert hits / (20 * len(got)) >= 0.95
    few = ann.search(df.filter("vec_id < 4"), F.lit(True), k=20)
    assert few.count() == 12 and ann.search(df.limit(0), F.lit(True)).count() == 0


def test_license_report(docs, spark):
    odd = ["MIT License mit license, MIT\tLICENSE! x", "SPDX-License-Identifier: GPL-2.0-or-later", "é mit licenseé", "mit license\u0001 apache license"]
    breaks = ["GNU General\nPublic License", "GENERAL  PUBLIC  LICENSE", "general-public-license", "see mit_license for details", "Apache\r\n\tLicense", "x_apache_license_", "mit  -  license"]
    known = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the Software)",
        "bsd": "Redistribution and use in source and binary forms, with or without\n modification, are permitted provided that",
        "apache-2.0": "you may not use this file except in compliance with the License.",
        "gpl-3.0": "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007",
        "lgpl-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "bsd-2-clause": "the FreeBSD license",
    }
    odd = [*odd, *breaks, *known.values()]
    texts = {**dict(enumerate(TEXTS)), **{100 + i: t for i, t in enumerate([*odd, "Released under the Apache License, Version 2.0. " * 40])}}
    rows = licenses.license_report(spark.createDataFrame([*texts.items()], "doc_id long, text string")).collect()
    for r in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places})) and 0 <= r.score <= 1
    found = {r.doc_id: r.labels for r in rows}
    assert (found[101], found[100 + len(odd)], found[0]) == ("gpl-2.0", "apache,apache-2.0", "")
    assert all(r.n_base == 1 for r in rows if 104 <= r.doc_id < 104 + len(breaks))
    for i, label in enumerate(known, 104 + len(breaks)):
        assert label in found[i].split(",")
    table = spark.createDataFrame([(1, "mit license", "x"), (1, "mit license", "x")], "doc_id long, text string, labels string")
    assert [r.labels for r in licenses.license_report(table).collect()] == ["mit", "mit"] and licenses.license_report(table.limit(0)).count() == 0
    # every keyword's words stand in the rule's own pattern, so the search for keywords loses nothing
    for rule in licenses.rules():
        assert re.search(rf"(?<![a-z0-9]){rule.keyword}(?![a-z0-9])", rule.pattern.replace("\\S", ""))
    assert len(licenses.rules()) > 200


def test_warc_round_trip(spark):
    same, big = "é" * 600, "y" * 300_000
    rows = [(1, "http://a/", same), (7, None, same), (3, "http://b/\r\nX: y", "small"), (4, "", "small"), (5, "u", None), (6, "u", ""), (9, "v", big), (8, "v", big + "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in warc.round_trip(pages).collect()}
    for key, _, html in rows:
        data = (html or "").encode()
        assert (found[key].payload_bytes, found[key].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert {k: (r.record_type, r.refers_to) for k, r in found.items() if r.refers_to} == {1: ("revisit", 7)}
    path = warc.scratch_path(spark, "warc-test")
    manifest = warc.write(pages, path)
    parts = warc.read_chunks(manifest, path).filter("record = 9").orderBy("chunk").collect()
    assert b"".join(bytes(p.data) for p in parts).decode() == big and len(parts) == 5
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_language_id(spark, docs, empty):
    draw = random.Random(4)
    kinds = {"en": "the of and with", "de": "der und mit nicht", "fr": "le et avec pas", "es": "el y con no"}
    rows = [(i, " ".join(draw.choices(kinds[k].split(), k=12)), k if i % 5 else None) for i, k in enumerate(draw.choices([*kinds], k=300))]
    truth = {i: k for i, k in zip(range(300), [None] * 300)}
    table = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 ?!", "de")], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.identified(table).collect()}
    right = [found[i].lang_pred == lang for i, _, lang in rows if lang and found[i].held_out]
    assert sum(right) / len(right) > 0.95 and len(found) == len(truth) + 2
    assert found[900].lang_pred == found[901].lang_pred == "und" and all(0 <= r.score <= 1 for r in found.values())
    assert {r.lang_pred for r in langid.identified(docs).collect()} == {"en", "und"}
    assert langid.identified(empty).count() == 0
    clash = table.withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit("own"))
    kept = langid.keep_identified(clash)
    assert kept.columns == clash.columns and {(r.score, r.lang_pred) for r in kept.collect()} == {("mine", "own")}
    assert kept.filter("lang IS NULL").count() == 0 and kept.count() == 300  # an unknown language becomes the predicted one


def test_pipeline_stage_by_stage(spark, sf_dir):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES][1:3] == ["exact dedup", "n-gram Jaccard join"] and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.identify(spark, docs, sf_dir)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    first = {}
    for i in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i] or ""), i)
    kept = corpus_pipeline.drop_copies(spark, docs, sf_dir)
    assert {r.doc_id for r in kept.collect()} == set(first.values()) and kept.columns == columns
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in components(texts).items() if i == c} and kept.columns == columns
    kept = corpus_pipeline.mix(spark, docs, sf_dir)
    assert kept.columns == columns and 0 < kept.count() <= docs.count()


def test_main_text_of_odd_markup():
    cases = {
        "<p title=it's>one</p><p>two</p><p>it's three</p>": "one\n\ntwo\n\nit's three",
        '<p class="x>hello': "hello",
        '<p class="x>hello</p><p>more</p>': "hello\n\nmore",
        '<p title="a>b">c': "c",
        '<p>a <span class="advert">AD</span>b <ins class="adsbygoogle">X<b>y</b></ins>c': "a b c",
        '<p><span hidden>h<span>i</span></span>d <span style="display: none">n</span>e</p><p>f</p>': "d e\n\nf",
        "<p><span hidden>never closed</p><p>yes</p>": "yes",
        '<p>x <code class="comment">kept</code></p>': "x kept",
        "<div><svg/><p>t</p><svg><text>no</text></svg>x<select><p>y</div>": "t\n\nx\n\ny",
        "a < b and <3 x": "a < b and <3 x",
        "<SCRIPT>no</script >yes": "yes",
        '<article><div class="discussion"><p>d</p></div><div class="legal-analysis"><p>l</p></div><section class="related-work"><p>r</p></section>'
        '<div class="related-posts">no</div><div class="legal-notice">no</div><div class="share">no</div></article>': "d\n\nl\n\nr",
    }
    assert {html: htmltext.main_text(html) for html in cases} == cases


def test_main_text_is_linear_in_depth_and_length():
    def seconds(html: str) -> float:
        start = time.perf_counter()
        htmltext.main_text(html, "div>div")
        return time.perf_counter() - start

    for part in ("<div>", "<div class=a><p>x<li>", "<select><p 'a=\"b", "<svg><i>"):
        assert seconds(part * 80_000) < 16 * seconds(part * 10_000) + 1
    assert htmltext.main_text("<div>" * 50_000 + "deep" + "</div>" * 50_000 + "x" * 100) == "deep\n\n" + "x" * 100


def test_extract_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, host string, path string")
    found = htmltext.extract(none)
    assert found.count() == 0 and found.columns == ["page_id", "url", "text", "n_chars"]
