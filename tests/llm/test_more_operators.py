"""Operators 2, 3, 5, 6 and 10 and the pipeline: SQL, plain versions and odd rows."""
import math
import random
import re
import sys
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loanlab.llm import html, license_scan, pii, topk, urls
from loanlab.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))
import oracle_check  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in oracle_check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toArrow(), con.sql(ORACLE[name]).arrow()
    want = want.read_all() if hasattr(want, "read_all") else want
    assert oracle_check.digest(got)[:3] == oracle_check.digest(want)[:3]


def test_licence_rows(docs):
    rows = [(1, "Released under the MIT License."), (2, "x CC-BY-NC cc by nc!"), (3, None), (4, ""), (5, "under the mit licence"), (6, "a " * 50_000 + "Apache License, Version 2.0"),
            (7, "the GNU General Public License and under the MIT License"), (7, "the GNU General Public License and under the MIT License"), (None, "ünder the mit license under the mit license")]
    out = {}
    for r in license_scan.license_scan(docs(rows)).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert (out[1][0].n_base, out[1][0].first_word, out[1][0].base_labels, out[1][0].labels) == (1, 1, "mit", "mit")
    assert (out[2][0].n_base, out[2][0].first_word, out[2][0].last_word, out[2][0].labels) == (2, 1, 4, "cc-by-nc")
    for i in (3, 4):
        assert (out[i][0].n_words, out[i][0].n_base, out[i][0].first_word, out[i][0].labels, out[i][0].score) == (0, 0, None, "", 0.0)
    assert out[5][0].labels == "" and out[6][0].labels == "apache-2" and out[6][0].first_word == 50_000
    assert len(out[7]) == 2 and out[7][0].labels == "gpl,mit" and out[7][0].base_labels == "mit"
    assert (out[None][0].n_base, out[None][0].first_word) == (1, 4)
    assert license_scan.license_scan(docs(rows).limit(0)).count() == 0


def plain_top(rows, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for q, v in {i: min(x for j, x in ok if j == i) for i, _ in ok if i % 100 == 0}.items():
        best = sorted((-dot(v, w), i) for i, w in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(1100, None), (1200, [None] + [1.0] * 5), (1300, [float("nan")] * 6), (1400, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (300, [9.0] * 6), (1500, [2.0, 1.0]), (1600, []), (7, [0.1] * 6), (7, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, 0, i) for i, v in rows], "vec_id long, embedding array<double>, score int, query_id long")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 100 = 0")).collect()))
    assert got == plain_top(rows)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id < 3")
    assert sorted(map(tuple, topk.top_k(few, few.where("vec_id % 100 = 0")).collect())) == plain_top([r for r in rows if r[0] is not None and r[0] < 3])


def luhn_ok(s):
    return pii.luhn(re.sub(r"\D", "", s)) == 0


def test_entities_and_forms():
    t = 'Mrs Anna Smith and Mr. Smith (anna.s@mail.example.com, +1 (826) 555-4081 190.137.223.204) paid 4111 1111 1111 1111, ssn 123-45-6789, token = "deadbeefdeadbeef1234"; GB82 WEST 1234 5698 7654 32. Not: 4111111111111112, 300.1.1.1, abcdef0123456789abcdef0123456789'
    found = [(t[s:e], k) for s, e, k in pii.entities(t)]
    assert found == [("Anna Smith", "woman"), ("Smith", "man"), ("anna.s@mail.example.com", "email"), ("+1 (826) 555-4081", "phone"), ("190.137.223.204", "ip"), ("4111 1111 1111 1111", "card"),
                     ("123-45-6789", "ssn"), ("deadbeefdeadbeef1234", "secret"), ("GB82 WEST 1234 5698 7654 32", "iban")]
    for v, k in found:
        n = pii.normal(k, v)
        s = pii.rendered(k, v, n, 0, "key")
        assert s != v and s == pii.rendered(k, v, n, 0, "key") != pii.rendered(k, v, n, 0, "other")
        if k in ("card", "phone", "ssn", "iban", "secret"):
            assert re.sub(r"\d", "0", re.sub("[a-f]", "0", s)) == re.sub(r"\d", "0", re.sub("[a-f]", "0", v))
    assert luhn_ok(pii.surrogate("card", "4111111111111111", 3))
    assert pii.iban_rest(pii.surrogate("iban", "GB82WEST12345698765432", 1)) == 1
    assert pii._script(pii.surrogate("man", "иван", 0)[0]) == "cyrillic"


def test_surrogates_are_distinct_and_consistent(docs):
    # a form with 90 values and 40 entities: first draws must collide
    rows = [(i, f"at 1.2.3.{10 + i} and a{i % 3}@mail.example.com") for i in range(40)]
    rows += [(100, None), (101, ""), (None, "at 1.2.3.10"), (102, "x " * 30_000 + "1.2.3.10"), (103, "clean 12 text"), (103, "clean 12 text")]
    out = pii.pseudonymise(docs(rows)).collect()
    assert out[0].n_words == "extra" and len(out) == len(rows)
    made = {}
    for r in out:
        if r.doc_id is not None and r.doc_id < 40:
            old = next(t for i, t in rows if i == r.doc_id)
            for (s, e, k), (s2, e2, k2) in zip(pii.entities(old), pii.entities(r.text)):
                made.setdefault((k, old[s:e]), set()).add(r.text[s2:e2])
    assert all(len(v) == 1 for v in made.values())
    assert len({next(iter(v)) for v in made.values()}) == len(made) == 43
    by = {r.doc_id: r for r in out}
    first = next(iter(made[("ip", "1.2.3.10")]))
    assert by[None].text == f"at {first}" and by[102].text.endswith(first)
    assert by[100].text is None and by[101].text == "" and by[103].text == "clean 12 text" and by[103]._entities == 0
    assert pii.pseudonymise(docs(rows).limit(0)).count() == 0


def plain_rule(host, path):
    best = None
    for said, rule in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (said, rule)
    return best


def test_url_rules_and_method(spark, sf):
    given = ["http://A.Example.ORG/es/1?x", "https://x.com/de/5#a", "https://x.com/fr/5", "http://x.example.org/en/12", "http://x.example.org/en/2", "http://example.org", "x.org/es", None, "", "a://b://c.org/x", "HTTP://org/?q", "http://net/fr/ü", "http://notcom/de/1", "http://u.com"]
    rows = [(i, u, "h") for i, u in enumerate(given)] + [(0, given[0], "h")]
    rows += [(1000 + i, f"http://bad.com/de/{i}", "h") for i in range(60)] + [(2000 + i, f"http://bad.com/x/{i}.html", "h") for i in range(5)]  # its labelled rows are all blocked
    rows += [(3000 + i, f"http://mix.com/{'de' if i % 2 else 'fr'}/{i}", "h") for i in range(60)] + [(4000, "http://mix.com/x/1", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = {}
    for r in urls.judge(df).collect():
        out.setdefault(r.page_id, []).append(r)
    assert sum(map(len, out.values())) == len(rows) and len(out[0]) == 2
    for i, u in enumerate(given):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        want = plain_rule(host, path)
        assert (out[i][0].host, out[i][0].path, out[i][0].rule) == (host, path, want and want[1])
        if want:
            assert out[i][0].verdict == want[0]
    assert {out[2000 + i][0].verdict for i in range(5)} == {"block"} and out[2000][0].rule is None
    assert out[4000][0].verdict == "allow" and out[7][0].verdict == "allow"
    assert urls.judge(df.limit(0)).count() == 0


P = "<p>Plain sentences, one after another, make this text. They go on for a while, as prose does.</p>"
T = "Plain sentences, one after another, make this text. They go on for a while, as prose does."


def test_html_pages(spark, sf):
    pages = [
        f'<html><body><nav><a href=/>Home</a></nav><article><h1>T &amp; t</h1><p><b>One<br><p>two\n  words</article><footer>&copy; x',
        f'<body><div id="menu">Menu</div><div class="content"><h2>Head</h2>{P}{P}<ul><li>a one<li>b two</ul><div class="ad">Buy</div></div><section class="comments">{P}</section><aside>Side</aside>',
        "", None, "<script>var x = '<p>no</p>'</script><style>p{}</style>", "no tags at all",
        f"<main>{P}<form><p>Name</p></form></main><div class='cookie-notice'><p>We use cookies.</p></div>",
        "<article>" + "<p>long line of words.</p>" * 5000 + "</article>",
    ]
    df = spark.createDataFrame([(i, f"u{i}", h, "x") for i, h in enumerate(pages)] + [(0, "u0", pages[0], "x"), (None, None, pages[0], "x")], "page_id long, url string, html string, text string")
    out = {}
    for r in QUERIES["op10_html_text"](spark, sf(pages=df)).collect():
        out.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text)
    text = {i: rs[0].text for i, rs in out.items()}
    assert text[0] == text[None] == "T & t\n\nOne\n\ntwo words" and len(out[0]) == 2
    assert text[1] == f"Head\n\n{T}\n\n{T}\n\na one\n\nb two"
    assert text[2] == text[3] == text[4] == "" and text[5] == "no tags at all"
    assert text[6] == T and text[7].count("\n\n") == 4999
    assert QUERIES["op10_html_text"](spark, sf(pages=df.limit(0))).count() == 0


def test_decoding_has_no_contradictions():
    rng = random.Random(1)
    root = html.parse(f"<div><div>{P}<div>{P}</div></div><div>{P}</div></div><p>x</p>")
    order, _ = html.features(root)
    import numpy as np
    for _ in range(50):
        p = np.array([rng.random() for _ in order])
        got = html.decoded(order, p)
        # best of all consistent labellings, by enumeration over sets closed under ancestors
        best, texts = -1e9, None
        for mask in range(1 << len(order)):
            on = {id(n) for i, n in enumerate(order) if mask >> i & 1}
            if any(id(n) in on and n.parent is not None and id(n.parent) not in on for n in order) or id(order[0]) not in on:
                continue
            s = sum(math.log(p[i] if id(n) in on else 1 - p[i]) for i, n in enumerate(order))
            if s > best:
                best, texts = s, [n.text for n in order if n.text and id(n) in on]
        assert got == texts


def test_pipeline(spark, sf, docs):
    import corpus_pipeline
    import brute
    item = " ".join(brute.prose(31, 30))
    long = lambda s: " ".join(brute.prose(s, 80))
    rows = [(1, long(1), "aa"), (2, long(1), "aa"), (3, long(2) + " write to joe@mail.example.com", "aa"), (4, "1 2 3", "aa"), (5, None, "aa"), (6, long(3) + " " + item, "aa"), (7, long(4), "aa"), (7, long(4), "aa")]
    d = docs(rows).drop("n_words")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    where = sf(documents=d, benchmark=bench)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "tokens"]
    got = {}
    df = spark.read.parquet(f"{where}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, where)
        got[name] = df.toPandas()
        if name != "tokens":
            assert df.columns == d.columns
    assert sorted(got["language"].doc_id) == [1, 2, 3, 6, 7, 7]
    assert sorted(got["near_duplicates"].doc_id) == [1, 3, 6, 7]
    assert sorted(got["decontamination"].doc_id) == [1, 3, 7]
    texts = dict(zip(got["personal_data"].doc_id, got["personal_data"].text))
    assert "joe@mail" not in texts[3] and "@" in texts[3] and texts[1] == rows[0][1]
    assert sorted(corpus_pipeline.run(spark, where).toPandas().doc_id) == [1, 3, 7]


def test_cards_beside_other_numbers():
    for text, want in [("card 4111111111111111 123", ["4111111111111111"]), ("4111 1111 1111 1111 12/27", ["4111 1111 1111 1111"]),
                       ("12 4111111111111111", ["4111111111111111"]), ("4111111111111111 20 items", ["4111111111111111"]),
                       ("no 7 4111-1111-1111-1111 123 5500000000000004 1", ["4111-1111-1111-1111", "5500000000000004"]),
                       ("3782 822463 10005 1234", ["3782 822463 10005"]), ("4111111111111112 123", []), ("4111111111111111x 1", []),
                       ("4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", ["4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"])]:
        assert [text[s:e] for s, e, k in pii.entities(text) if k == "card"] == want, text


def test_surrogates_never_run_out(docs):
    """More one-letter addresses at one domain than there are letters to draw; every kind grows after WIDEN attempts."""
    rows = [(i, f"write to {c}@x.com") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    made = [r.text.split()[-1] for r in pii.pseudonymise(docs(rows)).collect()]
    assert len(set(made)) == 26 and all(pii.entities(m) == [(0, len(m), "email")] for m in made)
    for kind, value in [("email", "a@x.com"), ("woman", "li"), ("person", "Ի"), ("secret", "a*******"), ("ssn", "123-45-6789"), ("phone", "+1 234 567"),
                        ("card", "4222222222222"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("ip", "1.2.3.4")]:
        n = pii.normal(kind, value)
        early, late = (pii.surrogate(kind, n, a) for a in (pii.WIDEN - 1, 2 * pii.WIDEN + 8))
        assert len(late) > len(early), kind
        assert pii.normal(kind, pii.rendered(kind, value, n, 2 * pii.WIDEN + 8, pii.KEY)) == pii.normal(kind, late)
    assert luhn_ok(pii.surrogate("card", "4222222222222", 40)) and pii.iban_rest(pii.surrogate("iban", "GB82WEST12345698765432", 40)) == 1


@pytest.mark.parametrize("part", ["<b ", "<div>", '<a "', "<a '\"", "<li>", "<!x", "<!--", "<p>", "</p", "<script", "<div><li>", "<li></li>", "&", "<ul><div>"])
def test_malformed_pages_are_linear(part):
    """Ten times the page takes about ten times as long, whatever its tags and quotes lack."""
    import time

    def seconds(size):
        t = time.process_time()
        html.features(html.parse(part * (size // len(part)) + "'"))
        return time.process_time() - t
    seconds(2_000)
    assert seconds(200_000) < 40 * max(seconds(20_000), 0.01)


def test_tags_without_an_end():
    def texts(node):
        return ([node.text] if node.text else []) + [t for k in node.kids for t in texts(k)]
    assert texts(html.parse('a <b "x> y')) == ['a <b "x> y']                       # the quote never closes
    assert texts(html.parse('<p>one</p><a href="x>two<p>three</p>')) == ["one", '<a href="x>two', "three"]
    assert texts(html.parse("x <!-- open <p>y")) == ["x"] and texts(html.parse("1 < 2 <!-- z")) == ["1 < 2"]


def test_top_k_of_huge_values(spark):
    rows = [(100, [1e306, -1.0]), (1, [1e306, 1.0]), (2, [-1e306, 1e308]), (3, [1.7e308, 0.0]), (4, [0.5, 0.25]), (200, [2.0, 4.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(v, v.where("vec_id % 100 = 0")).collect()}
    assert len(got) == 10 and got[100, 1] == got[100, 3] == 2**63 - 1 and got[100, 2] == -(2**63 - 1) and got[200, 4] == 2048 * 512 + 4096 * 256


def test_long_local_parts_and_clashing_names(spark, docs):
    long = "a" * 400 + ".b"
    rows = [(1, f"write to {long}@example.org now"), (2, "x@@y.org q@.org a.b@c-d.example.com"), (3, None)]
    df = docs(rows).withColumns({"_redo": F.lit("keep"), "_own": F.lit(7), "id": F.col("doc_id"), "_kinds": F.lit("old")})
    out = {r.doc_id: r for r in pii.pseudonymise(df).collect()}
    assert "aaaa" not in out[1].text and out[1]._entities == 1 and out[1]._redo == "keep" and out[1]._own == 7 and out[1]._kinds == "email"
    assert "a.b@c-d" not in out[2].text and out[3].text is None
    assert len(pii.entities("a@" * 50_000)) == 0


def test_one_letter_addresses_avoid_real_ones(spark, docs):
    """Every letter of one domain is taken, so no surrogate may be one of them."""
    rows = [(i, f"{chr(97 + i)}@x.com") for i in range(26)]
    got = [r.text for r in pii.pseudonymise(docs(rows)).collect()]
    assert len(set(got)) == 26 and not set(got) & {t for _, t in rows}
