"""Token counts, secret scan, licence scan, decontamination, HTML extraction, packing."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lexiflow.llm import (decontaminate, html_extract, license_scan, packing, secret_scan,
                          token_counts)
from lexiflow.session import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, id string, _id string, blob string, matches string"


def docs(spark, rows):
    """A documents table with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "x", None, "b", "m") for i, t in rows], SCHEMA)


# ---- token counts

@pytest.mark.parametrize("chunk,overlap", [(40, 8), (64, 16), (33, 32)])
def test_resync_equals_whole_encoding(chunk, overlap):
    rng = random.Random(chunk)
    units = [" ", "a", "the", "  ", "\n", "é", "你好", " tion", "ing", "🙂", "▁", "aaaa", "    ", "xyz", "12"]
    texts = ["".join(rng.choices(rng.sample(units, rng.randint(1, 6)), k=rng.randint(1, 250)))
             for _ in range(400)]
    texts += ["".join(rng.choices("abcdefghij", k=600)) for _ in range(50)]
    counter = token_counts.ResyncCounter(MODEL, chunk, overlap)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert counter.counts(texts) == [len(x) for x in sp.encode(texts)]
    assert counter.widened > 0


def test_token_counts_edge_rows(spark):
    long = "word " * 30_000
    got = token_counts.token_counts(docs(spark, [(1, None), (2, ""), (None, "né"), (3, long), (3, long)]), MODEL)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    n = len(sp.encode(long))
    assert rows == sorted([(1, 0, 0, False), (2, 0, 0, False), (None, 3, len(sp.encode("né")), False),
                           (3, 150_000, n, True), (3, 150_000, n, True)], key=repr)
    assert token_counts.token_counts(docs(spark, []), MODEL).count() == 0


# ---- secret scan

def test_findings_by_rule():
    text = "é token: 'abcd1234' TOKEN=short api-key=abcdefgh apikey=abcdefgh AKIAABCDEFGHIJKL " + "0a" * 16
    found = [(text[a:b], secret_scan.KINDS[k]) for a, k, b in secret_scan.find_secrets(text)]
    assert found == [("token: 'abcd1234", "assign"), ("apikey=abcdefgh", "assign"),
                     ("AKIAABCDEFGHIJKL", "access"), ("0a" * 16, "hex")]
    assert secret_scan.find_secrets("ſecret=abcdefgh toKen=abcdefgh") == []


def test_ledger_scans_only_unseen_blobs(spark, monkeypatch):
    ledger = scratch_path(spark, "test-ledger")
    a, b = "password=abcdefgh1", "nothing here"
    first = secret_scan.finding_digest(secret_scan.scan(docs(spark, [(1, a), (2, a), (3, b), (4, None)]), ledger))
    rows = {r.doc_id: r for r in first.collect()}
    assert [rows[i].n_assign for i in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert rows[1].spans == "assign:0:18" and rows[3].spans == ""
    assert secret_scan.read_ledger(spark, ledger).count() == 3
    # an old blob under a new path and one new blob: one new ledger row
    secret_scan.scan(docs(spark, [(9, a), (10, "token=zzzzzzzz")]), ledger).collect()
    assert spark.read.parquet(ledger).count() == 4
    # a new rule version scans its blobs again
    secret_scan.scan(docs(spark, [(9, a)]), ledger, rule_version="next").collect()
    assert spark.read.parquet(ledger).count() == 5
    assert secret_scan.scan(docs(spark, []), ledger).count() == 0


@pytest.mark.parametrize("bits", [None, 32768])
def test_ledger_holds_each_unseen_blob_once(spark, monkeypatch, bits):
    if bits:
        # so small a bitmap leaves contents in doubt
        monkeypatch.setattr(secret_scan, "bitmap_bits", lambda n: bits)
    ledger = scratch_path(spark, "test-ledger")
    texts = [f"row {i} token=abcd{i:08d}" for i in range(9_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000 + i, texts[i % 50]) for i in range(3_000)]
    rows += [(None, texts[0]), (20_000, None), (20_001, "")]
    # nine thousand unseen blobs, 50 of them with many copies, over several partitions
    got = secret_scan.scan(docs(spark, rows[:6_000] + rows[9_000:]).repartition(5), ledger)
    assert got.count() == len(rows) - 3_000
    filed = spark.read.parquet(ledger)
    assert filed.count() == filed.select("blob").distinct().count() == 6_001
    # the second scan takes the 3,000 blobs that the first has not met, and returns all findings
    got = secret_scan.finding_digest(secret_scan.scan(docs(spark, rows).repartition(5), ledger)).collect()
    assert spark.read.parquet(ledger).count() == 9_001
    want = sorted(((d, len(secret_scan.find_secrets(t or ""))) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_assign) for r in got), key=repr) == want


def test_bitmaps_of_addresses_are_bounded():
    assert secret_scan.bitmap_bits(0) == secret_scan.LEAST_BITS
    assert secret_scan.bitmap_bits(10**6) >= 16 * 10**6
    assert secret_scan.bitmap_bits(10**12) == secret_scan.MOST_BITS


# ---- licence scan

def test_licences_match_brute_force(spark):
    mit = license_scan.TEMPLATES["MIT"][2]
    half = mit.replace(", free", ",\nfree")
    rows = [(1, "Code of another kind.\nReleased under the MIT License\nmore of it"), (2, None), (3, ""), (4, "...\n!!!"),
            (5, half), (5, half), (None, "LICENSED under CC BY-NC 4.0"), (6, "word " * 5000)]
    got = sorted((tuple(r) for r in license_scan.scan(docs(spark, rows)).collect()), key=repr)
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [
        (1, "line", 1, "MIT"), (5, "line", 1, "MIT"), (5, "line", 1, "MIT"),
        (5, "paragraph", 0, "MIT"), (5, "paragraph", 0, "MIT"),
        (None, "line", 0, "CC-BY-NC-4.0")]
    assert license_scan.scan(docs(spark, [])).count() == 0


def test_size_filing_loses_no_match():
    rng = random.Random(2)
    vocabulary = [bytes([c]) for c in b"abcdefgh"]
    templates = {str(i): [" ".join(x.decode() for x in rng.choices(vocabulary, k=rng.randint(1, 8)))]
                 for i in range(12)}
    filed = license_scan.TemplateFile(templates, 0.8)
    for _ in range(2000):
        w = rng.choices(vocabulary, k=rng.randint(1, 9))
        want = {}
        for name, (text,) in templates.items():
            a, b = license_scan.bigrams(w), license_scan.bigrams(license_scan.words(text.encode()))
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= 0.8:
                want[name] = dice
        assert filed.match(w) == want


def test_notices_inside_lines_and_comment_blocks_are_found(spark):
    mit, gpl = license_scan.NOTICES["MIT"][1], license_scan.NOTICES["GPL-2.0"][1]

    def comment(text, mark):
        w = text.split()
        return "\n".join([mark, *(f"{mark} {' '.join(w[i:i + 9])}" for i in range(0, len(w), 9)), mark])

    rows = [(7, "This work is licensed under the GNU General Public License, version 3."),
            (1, "Copyright 2019 Foo. Released under the MIT License. All rights reserved."),
            (2, "#!/bin/sh\n" + comment("Copyright (c) 2020 A. B.\n" + mit, "#") + "\nimport os\nrun()"),
            (3, "/*\n" + comment(gpl, " *") + "\n */\nint main() {}"),
            (4, comment(license_scan.NOTICES["ISC"][0], "//") + "\ncode"),
            (5, "the free software of the license and the work under the terms of the day " * 50),
            (6, "Copyright X\n\n" + license_scan.NOTICES["BSD"][1].replace(" 2. ", "\n\n2. ") + "\nmore")]
    got = {}
    for r in license_scan.scan(docs(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.licence] = max(r.dice, got.get(r.doc_id, {}).get(r.licence, 0))
    assert {i: max(g, key=g.get) for i, g in got.items()} == {1: "MIT", 2: "MIT", 3: "GPL-2.0", 4: "ISC", 6: "BSD", 7: "GPL-3.0"}
    assert list(got[7]) == ["GPL-3.0"]
    assert all(max(g.values()) > 0.9 for g in got.values())


def test_windows_equal_brute_force():
    rng = random.Random(9)
    vocabulary = [bytes([c]) for c in b"abcdefg"]
    for _ in range(300):
        t = " ".join(x.decode() for x in rng.choices(vocabulary, k=rng.randint(3, 8)))
        filed = license_scan.TemplateFile({"x": [t]}, 0.8)
        _, grams, _, most = filed.windowed[0]
        w = rng.choices(vocabulary, k=rng.randint(2, 30))
        best = max((2 * len(a & grams) / (len(a) + len(grams)) for i in range(len(w) - 1)
                    for a in (license_scan.bigrams(w[i:j + 1]) for j in range(i + 1, min(len(w), i + most + 1)))))
        assert max((d for _, _, d in filed.windows(w, [])), default=0) == (best if best >= 0.8 else 0)


# ---- decontamination

def edit_distance_anywhere(text, item):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def mutate(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[i] = rng.choice("abcdefg")
        elif kind < 0.7:
            del chars[i]
        else:
            chars.insert(i, rng.choice("abcdefg"))
    return "".join(chars)


def test_regions_equal_brute_force():
    rng = random.Random(5)
    words = ["alpha", "beta", "gam", "de", "epsilon", "zet", "eta", "thet", "iot", "kap"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, prose(rng.randint(8, 30))) for i in range(12)]
    segs = [(i, s) for i, t in items for s in decontaminate.segments(t, 10, 512)]
    index = decontaminate.GramIndex(segs, 10, 0.06)
    texts = []
    for _ in range(60):
        item = rng.choice(items)[1]
        texts.append(prose(rng.randint(0, 20)) + " " + mutate(rng, item, rng.randint(0, 14)) + " "
                     + prose(rng.randint(0, 20)))
    got = [{m["item_id"]: m["edits"] for m in found}
           for found in decontaminate.find_matches(texts, index)]
    for text, found in zip(texts, got, strict=True):
        folded = decontaminate.fold(text)
        want = {}
        for i, s in segs:
            d = edit_distance_anywhere(folded, s)
            if d <= decontaminate.edit_budget(len(s), 0.06):
                want[i] = d
        assert found == want


def test_contamination_edge_rows(spark):
    item = "The quick brown fox jumps over the lazy dog near the river bank today"
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "short"), (None, item)],
                                  "item_id long, text string")
    rows = [(1, f"Intro. {item.upper()}! End."), (2, None), (3, ""), (None, item), (4, "clean text " * 50),
            (5, item), (5, item)]
    got = decontaminate.contaminated(docs(spark, rows), bench, text_col="text")
    assert sorted(((r.doc_id, r.item_id, r.edits) for r in got.collect()), key=repr) == sorted(
        [(1, 7, 0), (None, 7, 0), (5, 7, 0), (5, 7, 0)], key=repr)
    kept = decontaminate.remove_contaminated(docs(spark, rows).drop("matches"), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs(spark, rows), bench.limit(0)).count() == 0
    # several passes over a larger benchmark give the same
    many = decontaminate.contaminated(docs(spark, rows), bench, index_grams=10)
    assert sorted(r.item_id for r in many.collect()) == [7, 7, 7, 7]


def test_part_quotes_of_short_and_long_items_are_found(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    short, long = prose(80)[:250].strip(), prose(400)
    shortest = decontaminate.PASSAGE + decontaminate.STRIDE + 1
    quotes = [short[:-16], short[16:], short[80:80 + shortest], long[700:1100], long[333:333 + shortest],
              mutate(rng, long[500:600], 2), long]
    rows = [(i, f"{prose(30)} {q} {prose(30)}") for i, q in enumerate(quotes)] + [(90, prose(300))]
    bench = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    for grams in (decontaminate.INDEX_GRAMS, 1000):
        got = decontaminate.contaminated(docs(spark, rows).drop("matches"), bench, index_grams=grams)
        assert got.columns == ["doc_id", "item_id", "edits", "start", "end"]
        assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [
            (0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 2)]


STEM = "which of the following statements is true about "


def stem_items(rng, n):
    return [(i, STEM + " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))
                                for _ in range(14))) for i in range(n)]


def indexes_of(items, rate=0.06, **options):
    o = {"q": 10, "segment": 512, "passage": 50, "stride": 10, **options}
    texts = [decontaminate.fold(t) for _, t in items]
    common = {n: decontaminate.common_grams(texts, n)
              for n in {decontaminate.gram_size(len(t), o["q"], rate) for t in texts} if n}
    parts = decontaminate.benchmark_parts(items, o["q"], o["segment"], o["passage"], o["stride"])
    return decontaminate.build_indexes(parts, o["q"], rate, common)


@pytest.mark.parametrize("n", [30, 800])
def test_a_phrase_that_items_share_is_no_evidence(n):
    import time
    rng = random.Random(n)
    items = stem_items(rng, n)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(500)]
    clean = " ".join(" ".join(rng.choices(words, k=9)) + " " + STEM for _ in range(14))
    indexes = indexes_of(items)
    decontaminate.find_matches(["warm"], indexes)
    began = time.perf_counter()
    assert decontaminate.find_matches([clean], indexes) == [[]]
    assert time.perf_counter() - began < 0.5
    # the item itself, its rest, and an opening that goes on far enough are evidence
    for quote in (items[7][1], items[7][1][len(STEM):], items[7][1][:len(STEM) + 24], mutate(rng, items[7][1], 2)):
        assert [m["item_id"] for m in decontaminate.find_matches([f"{clean} {quote} {clean}"], indexes)[0]] == [7]


def test_equal_items_and_short_items_that_share_grams():
    twins = [(i, "the same question about the colour of the sky in spring") for i in range(9)]
    short = [(100 + i, f"define the word {w}") for i, w in enumerate(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"])]
    indexes = indexes_of(twins + short)
    text = f"intro {twins[0][1]} then define the word gamma and so on"
    assert sorted(m["item_id"] for m in decontaminate.find_matches([text], indexes)[0]) == [*range(9), 102]


@pytest.mark.parametrize("length", [10, 16, 17, 18, 19, 20, 33, 34])
def test_short_items_keep_their_edit_budget(length):
    rng = random.Random(length)
    budget = decontaminate.edit_budget(length, 0.06)
    for _ in range(40):
        item = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=length))
        at = length // 2
        quote = item if not budget else item[:at] + "0" + item[at + 1:]
        got = decontaminate.find_matches([f"one two {quote} three"], indexes_of([(5, item)]))[0]
        assert [(m["item_id"], m["edits"], m["start"], m["end"]) for m in got] == [
            (5, min(budget, 1), 8, 8 + length)]


def test_passages_equal_brute_force():
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, prose(rng.randint(12, 45))) for i in range(10)]
    indexes = indexes_of(items)
    parts = decontaminate.benchmark_parts(items, 10, 512, 50, 10)
    texts = []
    for _ in range(50):
        item = decontaminate.fold(rng.choice(items)[1])
        a = rng.randrange(max(1, len(item) - 40))
        texts.append(f"{prose(rng.randint(0, 9))} {mutate(rng, item[a:a + rng.randint(30, 110)], rng.randint(0, 5))} {prose(4)}")
    for text, found in zip(texts, decontaminate.find_matches(texts, indexes), strict=True):
        folded = decontaminate.fold(text)
        want = {}
        for ids, part, _ in parts:
            d = edit_distance_anywhere(folded, part)
            if d <= decontaminate.edit_budget(len(part), 0.06):
                for i in ids:
                    want[i] = min(want.get(i, (0, 0)), (-len(part), d))
        assert {m["item_id"]: (-m["size"], m["edits"]) for m in found} == want
        for m in found:  # what stands there is within the edits of a part of that length
            there = folded[m["start"]:m["end"]]
            assert m["edits"] in {edit_distance_anywhere(there, p) for ids, p, _ in parts if len(p) == m["size"]}


def test_a_long_text_of_quotes_takes_no_time():
    import time
    rng = random.Random(3)
    item = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(30))
    text = " ".join([item] * 480)  # 100,000 characters
    indexes = indexes_of([(1, item)])
    began = time.perf_counter()
    got = decontaminate.find_matches([text, "x" * 2_000_000], indexes)
    assert time.perf_counter() - began < 4 and [m["item_id"] for m in got[0]] == [1] and got[1] == []
    assert (got[0][0]["edits"], got[0][0]["start"], got[0][0]["end"]) == (0, 0, len(item))


# ---- HTML extraction

def page(body):
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


@pytest.mark.parametrize("body,want", [
    ("<nav><a>Home</a></nav><article><h1>A &amp; B</h1><p>x<br>y&nbsp;z <b>bold</b></p></article><footer>f</footer>",
     [("main", "A & B"), ("main", "x y z bold")]),
    ("<main><div class='ad banner'>buy</div><p>1 &lt; 2</p><section id=comments><p>lol</p></section></main>",
     [("main", "1 < 2")]),
    ("<article><header><h1>T</h1></header><p>a<p>b<script>x('</p>')</script><form>f</form></article>",
     [("main", "T"), ("main", "a"), ("main", "b")]),
    ("<article><p>cut off", [("main", "cut off")]),
    ("<div class='page-content'><p>Body.</p><p class='share-links'>Tweet</p><p>More.</p></div><div>x</div>",
     [("main", "Body."), ("main", "More.")]),
    ("<div class=content>out<article><div class='post-header'>Title</div><p hidden>h</p><p>In.</p></article></div>",
     [("main", "Title"), ("main", "In.")]),
    ("<article><p>a</p><div style='display: none'>b</div><aside>c</aside><ul><li>d</li><li class=ad>e</li></ul>"
     "</article>", [("main", "a"), ("main", "d")]),
    ("<article><p>5 < 6 and a<b", [("main", "5 < 6 and a")]),
])
def test_blocks(body, want):
    got = html_extract.page_blocks(page(body) if "cut off" not in body and "a<b" not in body else body)
    assert [b for b in got if b[0] == "main"] == want


@pytest.mark.parametrize("body,want", [
    ("<article><script>for(i=0;i<n;i++){f(i)}</script><p>a</p></article>", ["a"]),
    ("<script>if (i<n && s=='it\\'s') x=\"</p>\"</script><article><p>a</p><script>var t = \"don't\"</script><p>b</p>"
     "</article>", ["a", "b"]),
    ("<article><p>if i<n it's so</p><p>don't <b>x</b></p></article>", ["if i<n it's so", "don't x"]),
    ("<article><p title=it's>one</p><p>isn't two</p></article>", ["one", "isn't two"]),
    ("<article><a title='a>b' href=\"c<d\">e</a><svg><style>a<b{}</style><text>no</text></svg><p>f</p></article>",
     ["e", "f"]),
    ("<article><p>a</p><STYLE>p<q</STYLE ><p>b</p><textarea>x<y</textarea>c</article>", ["a", "b", "c"]),
])
def test_raw_text_and_odd_quotes_swallow_nothing(body, want):
    assert [t for z, t in html_extract.page_blocks(page(body)) if z == "main"] == want
    in_head = f"<html><head><script>a<b; d='<body>'</script></head><body>{body}</body></html>"
    assert [t for z, t in html_extract.page_blocks(in_head) if z == "main"] == want
    # a tag that never ends takes one pass
    assert html_extract.page_blocks("<p " + "a=\"b\" " * 20000) == []


@pytest.mark.parametrize("body,want", [
    ("<div class='content-sidebar-wrap'><main><p>a</p></main><div class='sidebar'>s</div></div>", ["a"]),
    ("<div class='sidebar-container'><main><p>a</p></main></div>", ["a"]),
    ("<div class='site-header-wrapper banner'><article><p>a</p></article></div><div class=footer>f</div>", ["a"]),
    ("<article><div class='elementor-widget elementor-widget-text'><p>a</p></div><div class=ad>x</div></article>", ["a"]),
    ("<article><div class='widget'><p>a</p></div></article><div>f</div>", ["a"]),
    ("<div class='no-sidebar has-banner'><article><p>a</p></article></div>", ["a"]),
    ("<div id=page class='has-banner'><div class='entry-content no-sidebar'><p>a</p></div></div>", ["a"]),
    ("<article><p>a</p></article><div class='comments-area'><article class='comment'><p>c</p></article></div>", ["a"]),
    ("<article><p>a</p></article><div class='sidebar widget-area'><article>teaser</article></div>", ["a"]),
    ("<div class='related-posts'><article>r</article></div><main><p>a</p></main><div class='cookie-notice'>c</div>", ["a"]),
    ("<article><p>a</p><div class='share-links'>s</div><div class='newsletter-form'>n</div></article>", ["a"]),
    ("<nav><article>n</article></nav><article><p>a</p></article>", ["a"]),
])
def test_class_names_never_cost_the_article(body, want):
    assert [t for z, t in html_extract.page_blocks(page(body)) if z == "main"] == want
    plain = page("<p>Story.</p><div class='comments'><article>lol</article><div class=content>x</div></div>")
    assert [t for z, t in html_extract.page_blocks(plain) if z == "plain"] == ["Story."]


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(200):
        t = np.array([rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(1, 40))])
        order = html_extract.suffix_array(t)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        lcp = html_extract.common_prefixes(t, order, 5)
        for i in range(1, len(t)):
            a, b = t[order[i - 1]:].tolist(), t[order[i]:].tolist()
            k = next((k for k in range(5) if k >= len(a) or k >= len(b) or a[k] != b[k]), 5)
            assert lcp[i] == k


@pytest.mark.parametrize("shard_tokens", [1_000_000, 40])
def test_unmarked_boilerplate_goes_unique_runs_stay(spark, shard_tokens):
    notice = "Subscribe to our weekly newsletter today and get all of the news first thing in morning"
    rows = [(i, f"http://h.x/{i}", page(f"<div>{notice}</div><div>Story {i} begins {i * 7} here.</div><p>Share</p>"))
            for i in range(5)]
    rows += [(5, "http://other.x/", page(f"<div>{notice}</div>")), (6, None, None), (None, "x", ""),
             (7, "http://h.x/7", page("<article><p>Main.</p></article><div>aside text</div>"))]
    src = spark.createDataFrame([(*r, "c", 1) for r in rows],
                                "page_id long, url string, html string, row string, host int")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(src, shard_tokens=shard_tokens).collect()}
    for i in range(5):
        assert got[i][0] == f"Story {i} begins {i * 7} here."
    assert got[5] == (notice, len(notice))
    assert got[6] == ("", 0) and got[None] == ("", 0)
    assert got[7] == ("Main.", 5)
    assert html_extract.extract(src.limit(0)).count() == 0


@pytest.mark.parametrize("shard_tokens", [1_000_000, 60])
def test_repeated_text_that_is_no_boilerplate_stays(spark, shard_tokens):
    phrase = "as the minister said in a long interview on Monday evening"
    copy = "<h1>Introduction</h1><p>" + " ".join(f"word{i}" for i in range(40)) + "</p>"
    long = " ".join(f"long{i}" for i in range(60))
    rows = [(0, "http://a.x/0", page(copy)), (1, "http://a.x/1", page(copy + "<p>other end</p>")),
            (2, "http://a.x/2", page(f"<p>One story, {phrase}, and more.</p>")),
            (3, "http://a.x/3", page(f"<p>Two stories, {phrase}, or less.</p>")),
            (4, "http://b.x/", page(copy)), (5, "http://b.x/", page(copy)), (6, "http://b.x/", page(copy)),
            *[(10 + i, f"http://c.x/{i}", page(f"<p>Menu of c</p><p>{long}</p><p>Text {i}</p>")) for i in range(4)]]
    src = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(src, shard_tokens=shard_tokens).collect()}
    whole = {r[0]: "\n\n".join(t for _, t in html_extract.page_blocks(r[2])) for r in rows}
    for i in range(7):
        assert got[i] == whole[i] != ""
    for i in range(4):
        assert got[10 + i] == f"{long}\n\nText {i}"


@pytest.mark.parametrize("body,want", [
    ("<form id='aspnetForm'><article><p>a</p><form>login</form></article><input></form>", ["a"]),
    ("<form><div class='header'>h</div><div class='content'><p>a</p></div></form>", ["a"]),
    ("<div>Site</div><nav><ul><li>home</ul><article><p>a</p></article><div>f</div>", ["a"]),
    ("<div id=p><div>Site</div><aside><p>x</p><article><p>a</p></article></div><div>f</div>", ["a"]),
    ("<article><p>a</p><video><p>b</p></article>", ["a", "b"]),
    ("<article><p>a</p><video>no</video><p>b</p><svg><p>c</p></article>", ["a", "b", "c"]),
    ("<article><p>a</p><section id='consent'><p>b</p></section><div class='subscription'>c</div><div class='notice'>d</div>"
     "<p class='story-promo-text'>e</p><div class='cookie-banner'>x</div><div class='ad'>y</div></article>",
     ["a", "b", "c", "d", "e"]),
    ("<div class='content'><p>A long story of many words.</p></div><article>teaser</article>", ["A long story of many words."]),
    ("<h1>The title</h1><article><p>a</p></article>", ["The title", "a"]),
    ("<h1>Some site</h1><article><p>a</p></article>", ["a"]),
    ("<h1>The title</h1><article><h1>Own</h1><p>a</p></article>", ["Own", "a"]),
    ("<article hidden><p>a</p></article><div style='display:none'><article>x</article></div><p>b</p>", ["a"]),
])
def test_wrapped_unclosed_and_named_sections_keep_their_text(body, want):
    whole = f"<html><head><title>The title - Site</title></head><body>{body}</body></html>"
    assert [t for z, t in html_extract.page_blocks(whole) if z == "main"] == want


def test_a_form_around_unmarked_text_and_stray_tags():
    whole = page("<form><p>Story one.</p><p>Story two.</p></form>")
    assert html_extract.page_blocks(whole) == [("plain", "Story one."), ("plain", "Story two.")]
    import time
    began = time.perf_counter()
    html_extract.page_blocks("<div>" * 20_000 + "</span>" * 20_000 + "<video>" * 20_000 + "end")
    assert time.perf_counter() - began < 2


@pytest.mark.parametrize("shard_tokens", [1_000_000, 400])
def test_unmarked_notices_inside_articles_go_by_the_suffix_array(spark, shard_tokens):
    """Every page has an article: the host's repeated notice inside it goes, copies of an article and headings stay."""
    notice = "You are reading the free edition of this paper, sign in to read all of it"
    refrain = "as the minister said in a long interview on Monday evening"
    story = [f"Story {i} was told on day {i * 7} by {i * 11} people of the town, {refrain}, in {i * 13} words." for i in range(9)]
    rows = [(i, f"http://n.x/{i}", page(f"<nav>Menu</nav><article><h2>Summary</h2><p>{t}</p><p>{notice}</p></article>"))
            for i, t in enumerate(story)]
    whole = "<article><p>" + "</p><p>".join(" ".join(f"p{k}w{j}" for j in range(20)) for k in range(4)) + "</p>{}</article>"
    rows += [(20 + i, f"http://c.x/{i}", page(f"<div>Ad {i}</div>" + whole.format(""))) for i in range(8)]
    rows += [(40 + i, f"http://d.x/{i}", page(whole.format(f"<p>Ending {i}</p>"))) for i in range(8)]
    rows += [(60 + i, f"http://f.x/{i}", page(f"<article><p>{story[i]}</p><p>{notice}</p></article>")) for i in range(3)]
    src = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(src, shard_tokens=shard_tokens).collect()}
    for i, t in enumerate(story):
        assert got[i] == f"Summary\n\n{t}"
    for i, _, html in rows[len(story):]:
        assert got[i] == "\n\n".join(t for z, t in html_extract.page_blocks(html) if z == "main") != ""


def test_repeated_substrings_equal_brute_force():
    rng = random.Random(17)
    for _ in range(40):
        pages = []
        common = [f"c{i}" for i in range(30)]
        for i in range(rng.randint(1, 7)):
            blocks = []
            for _ in range(rng.randint(0, 6)):
                a = rng.randrange(20)
                words = rng.choices("abc", k=rng.randint(1, 6)) + rng.choice([[], common[a:a + rng.randint(1, 14)]])
                blocks.append(("plain", " ".join(words)))
            pages.append((f"page{i}", blocks))
        shard = html_extract.Shard([p for p, _ in pages], [b for _, b in pages])
        runs, whole = html_extract.repeated_substrings(shard)
        where, equal = {}, {}
        for p, blocks in pages:
            for _, text in blocks:
                w = text.split(" ")
                equal.setdefault(text, set()).add(p)
                for i in range(len(w) - html_extract.RUN + 1):
                    where.setdefault(tuple(w[i:i + html_extract.RUN]), set()).add(p)
        hashes = html_extract._run_hashes(shard)
        at = {}
        for n, (p, i, a, b) in enumerate(shard.spans):
            text = dict(pages)[p][i][1]
            w = text.split(" ")
            assert whole[n] == (len(equal[text]) if len(w) < html_extract.RUN else 0)
            for j in range(a, b + 1):
                gram = tuple(w[j - a:j - a + html_extract.RUN])
                full = len(gram) == html_extract.RUN
                assert runs[j] == (len(where[gram]) if full else 0) and (hashes[j] != 0) == full
                if full:
                    at.setdefault(gram, set()).add(int(hashes[j]))
        assert all(len(h) == 1 for h in at.values()) and len({min(h) for h in at.values()}) == len(at)


def test_unique_runs_by_brute_force():
    rng = random.Random(18)
    for _ in range(300):
        words = [str(i) for i in range(rng.randint(8, 130))]
        starts = np.array(sorted(rng.sample(range(len(words) - 7), rng.randint(0, min(9, len(words) - 7)))), int)
        covered = {i for s in starts for i in range(s, s + html_extract.RUN)}
        want, i = [], 0
        while i < len(words):
            j = i
            while j < len(words) and (j in covered) == (i in covered):
                j += 1
            if i not in covered or j - i >= html_extract.LONG_BLOCK:
                want += words[i:j]
            i = j
        assert html_extract.unique_runs(words, starts) == want


@pytest.mark.parametrize("shard_tokens", [1_000_000, 3000])
def test_pages_without_article_tags(spark, sf_small, tmp_path, monkeypatch, shard_tokens):
    """The test pages with their articles unmarked among furniture of the host, through the registered query."""
    import re

    import __spark_entry__ as entry
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()]
    rows, want, hosts = [], {}, {}
    for i, _, text in pages:
        article = re.search(r"<article>(.*)</article>", text or "", re.DOTALL)
        host = f"h{i % 5}.example"
        hosts.setdefault(host, []).append(i)
        before = f"<div>{host} news from all over the region since nineteen hundred and nine</div><div>Menu</div>"
        after = (f"<p>Posted on day {i} by the desk of {host} and may not be copied without written leave of ours, number {i}</p>"
                 f"<div>Imprint</div>")
        rows.append((i, f"https://{host}/{i}", f"<html><body>{before}<div>{article[1]}</div>{after}</body></html>"))
        body = "\n\n".join(t for _, t in html_extract.page_blocks(f"<html><body>{article[1]}</body></html>"))
        want[i] = f"{body}\n\nPosted on day {i} {i}".strip()
    assert min(map(len, hosts.values())) >= 3
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    whole = html_extract.extract
    monkeypatch.setattr(html_extract, "extract", lambda p: whole(p, shard_tokens=shard_tokens))
    got = {r.page_id: r.text for r in entry.queries()["op9_html_extract"](spark, str(tmp_path)).collect()}
    assert got == want


# ---- packing

def test_best_fit_decreasing_equals_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        cap = rng.randint(1, 40)
        n = np.array([rng.randint(1, cap) for _ in range(rng.randint(1, 60))])
        got, free = packing.best_fit_decreasing(n, cap), []
        for i in np.argsort(-n, kind="stable"):
            fits = [f for f in free if f >= n[i]]
            if fits:
                assert free[got[i]] == min(fits)
            else:
                assert got[i] == len(free)
                free.append(cap)
            free[got[i]] -= n[i]


def test_packed_rows_give_the_documents_back(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["lorem", "ipsum", "é", "🙂", "\n"], k=rng.randint(0, 300))))
            for i in range(60)]
    rows += [(100, None), (None, "null id"), (0, rows[0][1])]
    got = packing.pack(docs(spark, rows), RANKS, public_tokenizers.PATTERN, seq_len=64, run_tokens=2000).collect()
    encode = packing.rank_encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    parts = {}
    for r in got:
        assert len(r.input_ids) == len(r.position_ids) == 64
        assert len(r.cu_seqlens) == r.n_segments + 1 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.segment_starts == r.cu_seqlens[:-1]
        for j, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False)):
            assert r.position_ids[a:b] == list(range(b - a))
            parts.setdefault((r.doc_ids[j], r.doc_offsets[j]), []).append(r.input_ids[a:b])
        assert set(r.input_ids[r.n_tokens:]) <= {packing.PAD_ID}
    assert len({r.pack_id for r in got}) == len(got)
    for i, text in rows:
        whole, copies = encode(text or ""), sum(x == (i, text) for x in rows)
        for o in range(0, len(whole), 64):
            assert parts[(i, o)] == [whole[o:o + 64]] * copies
    assert sum(map(len, parts.values())) == sum(-(-len(encode(t or "")) // 64) for _, t in rows)
    assert packing.pack(docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_cut_and_uncut_encodings_are_equal():
    rng = random.Random(12)
    encoding = packing.rank_encoding(RANKS, public_tokenizers.PATTERN)
    spaces = [" ", "\n", "\t", " \n", "\r\n", "\u3000", "\x85", "\u2028", "\x1c", "\x0b\x0c"]
    words = ["a", "it's", "12", "é", "...", "word", "\x1c", "\u200b", "'", "你好"]
    for n in (999, 1000, 1001, 5000):
        for _ in range(30):
            text = "".join(rng.choice(["", rng.choice(words)]) + rng.choice(spaces) * rng.choice([1, 3, n])
                           + rng.choice(["", rng.choice(words)]) for _ in range(5))
            assert packing.encode_text(encoding, public_tokenizers.PATTERN, text) == encoding.encode_ordinary(text)
    # another pattern is left alone
    other = packing.tiktoken.Encoding("other", pat_str=r"\w+|\s", mergeable_ranks=encoding._mergeable_ranks, special_tokens={})
    assert packing.encode_text(other, r"\w+|\s", "a" + " " * 2000) == other.encode_ordinary("a" + " " * 2000)


def test_texts_of_megabytes_are_packed_whole(spark):
    encoding = packing.rank_encoding(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(4)
    prose = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(3000))
    texts = {1: " " * 2_000_000, 2: "a" + " \n" * 1_000_000 + "b", 3: prose * 480, 4: "x" + "\n" * 600_000 + " y z"}
    got = packing.pack(docs(spark, list(texts.items())), RANKS, public_tokenizers.PATTERN).collect()
    pieces = {}
    for r in got:
        ends = r.cu_seqlens
        for i, d in enumerate(r.doc_ids):
            pieces.setdefault(d, []).append((r.doc_offsets[i], r.input_ids[ends[i]:ends[i + 1]]))
    for d, text in texts.items():
        ids = [t for _, part in sorted(pieces[d]) for t in part]
        assert encoding.decode(ids) == text
        assert [o for o, _ in sorted(pieces[d])] == list(range(0, len(ids), 2048))
