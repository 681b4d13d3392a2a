"""Near copies, personal data, fingerprints, scores, quality and pages against plain versions."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import fingerprints, html_text, lm_scores, near_dups, pii, quality
from tidegauge.llm.components import components

ODD = [(3, "a b c d e f"), (1, None), (2, ""), (4, " \n\t"), (8, "a b c d e f"), (8, "a b c d e f"), (6, "a"), (None, "q r s"), (9, "z " * 60_000)]


def families(seed=5):
    """Documents that share a passage, edits of one text in every strength, copies, and short ones."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage, base = (draw.choices(words, k=k) for k in (90, 150))
    docs = [passage + draw.choices(words, k=draw.randint(5, 120)) for _ in range(60)]
    for _ in range(90):
        edit = list(base)
        for _ in range(draw.randint(0, 14)):
            edit[draw.randrange(len(edit))] = draw.choice(words)
        docs.append(edit)
    docs += [docs[draw.randrange(150)] for _ in range(30)] + [[], ["a"], ["a"], ["A", "b", "c"], ["a", "b", "C"]]
    draw.shuffle(docs)
    return [(3 * i, (" " if i % 2 else "\n").join(d)) for i, d in enumerate(docs)]


def test_near_duplicates(documents):
    rows = families()
    want = brute.near_duplicates(rows, 4)
    got = near_dups.near_duplicates(documents(rows), shingle=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(documents):
    got = sorted((tuple(r) for r in near_dups.near_duplicates(documents(ODD)).collect()), key=str)
    want = [(3, 2, 3, True), (1, 0, 1, True), (2, 0, 2, True), (4, 0, 4, True), (8, 2, 3, False), (8, 2, 3, False), (6, 1, 6, True), (None, 1, None, True), (9, 1, 9, True)]
    assert got == sorted(want, key=str)
    left = near_dups.one_of_each(documents([*ODD, (6, "a")]))
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 6, 9] and left.columns == documents([]).columns
    assert near_dups.near_duplicates(documents([])).count() == 0


def test_components(spark):
    draw, plain = random.Random(2), brute.Union()
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(600, 900)] + [(5, 5)]
    for a, b in edges:
        if a != b:
            plain.link(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: plain.root(x) for x in plain.up}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_personal_data(documents):
    draw = random.Random(3)
    letters = list("0123456789012345.-+@a%é🎉 ()") + ["4111111111111111", "4111 1111 1111 1111", "a@b.co", "255.1.2.3", "+1 (555) 123-4567", "256.", "00000000001."]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "1 " * 3000 + "x", "a@b.c" * 2000, "9" * 50_000, "a" * 100_000 + "@b.c", "1." * 20_000, "+1" + " " * 50_000]
    got = {r["doc_id"]: r for r in pii.span_report(pii.find_spans(documents(list(enumerate(texts))))).collect()}
    for i, text in enumerate(texts):
        base = brute.personal_data(text)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in brute.PATTERNS] == [sum(s[3] == k for s in base) for k in brute.PATTERNS]
    assert pii.span_report(pii.find_spans(documents([]))).count() == 0


def test_added_kinds_context_and_masks(documents):
    rows = [(1, "my IBAN is GB82 WEST 1234 5698 7654 32 ok"), (2, "ssn: 123-45-6789, mail a@b.co é +1 555 123 4567"), (3, "123-45-6789"), (4, "IBAN GB82 WEST 1234 5698 7654 33"), (5, None)]
    found = pii.find_spans(documents(rows))
    got = {r["doc_id"]: r for r in found.select("doc_id", "pii_spans", pii.masked(F.col("text"), F.col("pii_spans")).alias("m")).collect()}
    assert {i: r["m"] for i, r in got.items()} == {1: "my IBAN is [IBAN] ok", 2: "ssn: [SSN], mail [EMAIL] é [PHONE]", 3: "123-45-6789", 4: rows[3][1], 5: None}
    assert got[1]["pii_spans"][0]["score"] > next(k.score for k in pii.KINDS if k.name == "iban")
    overlap = documents([(1, "+4111111111111111 x")])
    assert pii.find_spans(overlap).select(pii.masked(F.col("text"), F.col("pii_spans"))).first()[0] == "+[CARD] x"


def test_columns_named_like_the_operator_s_own_stay(spark):
    rows = [(1, "mail a@b.co", "m", 5, [1], "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _match_email string, _BETWEEN_ip int, _start_card array<int>, pii_spans string")
    found = pii.find_spans(df)
    assert found.columns == ["doc_id", "text", "_match_email", "_BETWEEN_ip", "_start_card", "pii_spans"]
    (row,) = found.collect()
    assert tuple(row[:5]) == rows[0][:5] and [s["kind"] for s in row["pii_spans"]] == ["email"]


def test_ibans_before_capitals_digits_and_each_other(documents):
    gb, de, no, mt = "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00", "NO9386011117947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"
    after = ["Please pay", "BIC COBADEFFXXX", "2024", "A", "OK, B", "é", "x", "\n7", "", "GB82 WEST", "FR12 " * 9]
    texts = {f"IBAN {x} {a}": f"IBAN [IBAN] {a}" for x in (gb, de, no, mt, gb.replace(" ", "")) for a in after}
    texts |= {f"{gb} {de} {no} {mt} {gb}": " ".join(["[IBAN]"] * 5), f"RE20 2024 0815 {de} X": "RE20 2024 0815 [IBAN] X", f"FR76 {gb} 12345 ABC": "FR76 [IBAN] 12345 ABC"}
    # A country that is not registered; too long for its country; a wrong digit; a group that goes on.
    texts |= {"ZZ33 1234 5678 9012 345 NEXT 1": "[IBAN] NEXT 1"}
    texts |= {x: x for x in (f"{gb}2 A", gb[:-1] + "3 A", f"{gb}a", f"{gb} A"[1:])}
    found = pii.find_spans(documents(list(enumerate(texts)))).select("text", "pii_spans", pii.masked(F.col("text"), F.col("pii_spans")).alias("m"))
    for r in found.collect():
        assert r["m"] == texts[r["text"]]
        assert all(s["kind"] == "iban" and r["text"][s["start"] : s["stop"]].replace(" ", "").isalnum() for s in r["pii_spans"])


@pytest.mark.parametrize("rows", [[(i, f"doc {i} é🎉 " + "ab" * i) for i in range(40)] + [(90, None), (91, ""), (None, "z" * 99)], [(5, "alone")], []])
def test_fingerprints(documents, rows):
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(documents(rows), cells=7).collect()}
    ordered = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -1))
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(ordered):
        text, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        own, new, other = map(fingerprints.fingerprint, (text, changed, following))
        want = (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, new, fingerprints.likeness(own, new), fingerprints.likeness(own, other))
        assert tuple(got[i]) == want


@pytest.mark.parametrize("cells", [1, 7])
def test_fingerprints_follow_ids_beyond_doubles(documents, cells):
    ids = [2**53 + i for i in range(40)] + [2**62 + i for i in range(40)] + [2**63 - 1 - i for i in range(9)] + [-(2**63) + i for i in range(9)]
    rows = [(i, f"{random.Random(i).random()} text") for i in ids] + [(None, "no id")]
    random.Random(1).shuffle(rows)
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.fingerprints(documents(rows), cells=cells).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    following = [*ordered[1:], ordered[0]]
    assert got == {i: hashlib.sha256(fingerprints.edited(t, f).encode()).hexdigest() for (i, t), (_, f) in zip(ordered, following, strict=True)}


def test_spans_extensions_and_likeness():
    a, b = fingerprints.PrefixHashes("abracadabra🎉abra"), fingerprints.PrefixHashes("cadabra🎉abrX")
    assert fingerprints.common_extension(a, 4, b, 0) == 11 and fingerprints.common_extension(a, 0, b, 3) == 4
    assert fingerprints.equal_spans(a, 0, a, 12, 4) and not fingerprints.equal_spans(a, 0, a, 1, 2)
    fp, text = fingerprints.fingerprint, "".join(random.Random(1).choices("abcdefgh ", k=5000))
    assert fingerprints.likeness(fp(text), fp(text)) == 1 and fingerprints.likeness(fp(""), fp("a")) == 0
    assert 0.9 < fingerprints.likeness(fp(text), fp(text[:2000] + "#" + text[2001:])) < 1
    assert fingerprints.likeness(fp(text), fp(text[::-1])) < 0.01


def test_copies_with_several_edits_stay_alike():
    draw = random.Random(4)
    text, other = ("".join(draw.choices("abcdefgh ", k=5000)) for _ in range(2))
    like = lambda a, b: fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
    assert like(text, "#" + text[1:-1] + "#") > 0.95  # near both ends
    assert like(text, text[:500] + "##" + text[500:4500] + "é🎉" + text[4500:]) > 0.9  # insertions at 10 % and 90 %
    edits = list(text)
    for place in range(100, 5000, 500):
        edits[place] = "#"
    assert 0.6 < like(text, "".join(edits)) < 1
    assert like(text, text[2500:] + text[:2500]) > 0.9 and like(text, other) < 0.02
    assert 0.45 < like(text, "#" + text[1000:3500] + other[:2500]) < 0.5  # half is shared, and counts once
    assert like("#" + text + text + "#", "~" + text + "~") < 0.51
    for odd in ("z " * 60_000, "a", "ab" * 4, "é" * 255, "é" * 256, "x" * 511):
        spans = fingerprints.PrefixHashes(odd).borders()
        assert spans[0] == 0 and spans[-1] == len(odd) and 0 < np.diff(spans).min() <= np.diff(spans).max() <= fingerprints.SPAN_MOST
        assert like(odd, odd) == 1 and 0 <= like(odd, odd + "!") < 1


def test_scores_back_off(documents):
    rows = [(1, "the cat sat"), (2, "The cat ran"), (3, "a cat sat"), (4, None), (5, " "), (None, "zebra")]
    got = {r["doc_id"]: r for r in lm_scores.stupid_backoff(documents(rows), order=3, chunk_rows=2).collect()}
    docs = [brute.words(t) for _, t in rows]

    def score(k):
        others = [d for i, d in enumerate(docs) if i != k]
        count = lambda g: sum(tuple(d[i : i + len(g)]) == tuple(g) for d in others for i in range(len(d) - len(g) + 1))
        total, out = sum(map(len, others)), 0.0
        for i, w in enumerate(docs[k]):
            for back, n in enumerate(range(min(2, i), -1, -1)):
                context = docs[k][i - n : i]
                if n == 0:
                    out += np.log(0.4) * back + np.log((count([w]) + 1) / (total + 1))
                elif count([*context, w]):
                    out += np.log(0.4) * back + np.log(count([*context, w]) / count(context))
                    break
        return out

    for k, (i, _) in enumerate(rows):
        assert got[i]["n_tokens"] == len(docs[k]) and abs(got[i]["log_score"] - score(k)) < 1e-9
        assert (got[i]["mean_log_score"] is None) == (not docs[k])
    assert lm_scores.stupid_backoff(documents([])).count() == 0


def test_quality_field_learns_lines(spark, documents):
    draw = random.Random(1)
    good = lambda: "\n".join(" ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(12)) + "." for _ in range(draw.randint(1, 6)))
    bad = lambda: "\n".join(" ".join("".join(draw.choices("ABC$$!!", k=5)) for _ in range(12)) for _ in range(draw.randint(1, 6)))
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(400)] + [(1000, None), (1001, ""), (None, good()), (1002, good() + "x" * 300_000)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)] + [(5, None), (None, 1)], "doc_id long, quality int")
    docs = documents(rows)
    field = quality.train(docs, labels)
    got = {r["doc_id"]: r for r in quality.score_quality(docs, field).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(got[i]["predicted"] == int(i % 4 != 0) for i in range(400)) >= 396
    assert not got[None]["held_out"] and {r["held_out"] for r in got.values()} == {True, False}
    assert quality.good_documents(docs, field).columns == docs.columns
    assert 295 <= quality.good_documents(docs, field).filter("doc_id < 400").count() <= 305
    assert quality.train(docs, labels.filter("quality = 1")) is None
    assert {r["score"] for r in quality.score_quality(docs, None).collect()} == {0.5}
    assert quality.score_quality(documents([]), field).count() == 0


def test_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(1)
    emissions, steps = draw.normal(size=7), draw.normal(size=(2, 2))
    at = np.array([0, 4, 5, 7])
    want = np.zeros(7)
    for a, b in zip(at[:-1], at[1:], strict=True):
        weights = {}
        for code in range(2 ** (b - a)):
            y = [code >> i & 1 for i in range(b - a)]
            weights[tuple(y)] = np.exp(sum(emissions[a + i] for i, v in enumerate(y) if v) + sum(steps[u, v] for u, v in zip(y, y[1:], strict=False)))
        for i in range(b - a):
            want[a + i] = sum(w for y, w in weights.items() if y[i]) / sum(weights.values())
    assert np.allclose(quality.marginals(emissions, at, steps), want)


PAGES = {
    "<body><nav>menu</nav><article><header><h1>T &amp; t</h1><p>by me</p></header><p>a  b<br>c<p>d<div class='ad'>X<p>y</p></div><p>e <a href='x>y'>l</a></p>"
    "<aside>s</aside><form>f</form><div id=comments><p>bad</p></div>z</article><footer>f</footer>": "T & t\n\na b c\n\nd\n\ne l\n\nz",
    "<script>var t='</p>';</script><article><h1>h</h1><p><b>Foo.<br><p>Bar</p></article><footer>q": "h\n\nFoo.\n\nBar",
    "<!-- <article>no</article> --><main><p>1 &lt; 2 &amp;&amp; 3 < 4</p></main>": "1 < 2 && 3 < 4",
    "<p>plain<style>p{}</style> page": "plain page",
    "<article><p>unclosed": "unclosed",
    "<article><p>A one</p><svg class=i /><p>B two</p></article>": "A one\n\nB two",
    "<article><p>a <button class='x>y'>no</button> b</p><select><option>no</select><svg><title>no</title><svg/><text>no</text></svg><p>c</article>": "a b\n\nc",
    "<article><p>a</p><button>b<p>c</p><canvas><p>d</p><math/><iframe src=x><object><p>e</p></article>": "a\n\nb\n\nc\n\nd\n\ne",
    "<article><p>a</p><button>b<p>c</p><button>no</button><p>d</p></article></button>": "a\n\nb\n\nc\n\nd",
    "<article><p>" + "<div>" * 3_000 + "deep" + "</div>" * 3_000 + "</article>": "deep",
    "": "",
    None: "",
}


def test_pages(spark):
    rows = [(i, f"http://h{i}.example/x", h, "y") for i, h in enumerate(PAGES)] + [(None, None, "<p>z", "y"), (70, None, "<p>" + "long " * 50_000, "y")]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {**dict(enumerate(PAGES.values())), None: "z", 70: ("long " * 50_000).strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_like_a_plain_parser_reads_them(spark, sf_dir):
    """All pages of the tables hold an article, so a plain walk over the markup gives their text."""
    pages = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(pages).collect()}
    want = {r["page_id"]: brute.main_text(r["html"]) for r in pages.collect()}
    assert got == want


def test_what_a_host_repeats_is_dropped_from_unmarked_pages(spark):
    draw = random.Random(1)
    words = lambda n: " ".join(f"u{draw.randrange(10**6)}" for _ in range(n))
    standing = words(20)
    bodies = [(words(30), words(40)) for _ in range(12)]
    rows = [(i, "https://user@A.example:80/p", f"<p>{standing}</p><p>{a}</p><div>{b} {standing}</div>") for i, (a, b) in enumerate(bodies)]
    rows += [(99, "https://b.example/p", f"<p>{standing}</p>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"{a}\n\n{b} {standing}" for i, (a, b) in enumerate(bodies)}, 99: standing}


def test_open_blocks_beside_an_article_stay_unless_the_host_repeats_them(spark):
    words = lambda k, n: " ".join(f"{k}w{i}" for i in range(n))
    rows = [(i, "http://a.example/p", f"<div>{words(i, 90)}</div><article><p>card {i}</p></article><div>{words('standing', 20)}</div>") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{words(i, 90)}\n\ncard {i}" for i in range(5)}


@pytest.mark.parametrize("group_bytes", [1 << 30, 20_000, 1])
def test_what_is_shared_depends_neither_on_groups_nor_on_the_host_s_size(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(html_text, "GROUP_BYTES", group_bytes)
    words = lambda k, n: " ".join(f"{k}w{i}" for i in range(n))
    notes = {k: words(f"note{k}", 12) for k in (2, 3)}  # on 2 and on 3 of 60 pages
    note = lambda i: "".join(f"<div>{notes[k]}</div>" for k in notes if i % 20 == 0 and i < 20 * k)
    rows = [(i, f"http://a.example/{i}", f"<p>{words(i, 30)}</p>{note(i)}") for i in range(60)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: words(i, 30) + (f"\n\n{notes[2]}" if i in (0, 20) else "") for i in range(60)}


def test_suffix_ranks_and_shared_runs():
    draw = np.random.default_rng(1)
    tokens = np.append(draw.integers(0, 3, 200), -1)
    for depth in (1, 3, 8, 11):
        ranks = html_text.suffix_ranks(tokens, depth)
        starts = [tuple(tokens[i : i + depth]) for i in range(len(tokens))]
        order = sorted(set(starts))
        assert [order.index(s) for s in starts] == ranks.tolist()
    covered = html_text.shared_runs([[9, 1, 2, 3, 4, 8], [1, 2, 3, 4], [7, 1, 2, 3]], least=2, depth=4)
    assert [c.astype(int).tolist() for c in covered] == [[0, 1, 1, 1, 1, 0], [1, 1, 1, 1], [0, 0, 0, 0]]
