import hashlib
import re

from tidemart.llm import chat as T
from tidemart.llm import html_extract as H
from tidemart.llm import pii as I
from tidemart.llm import quality as Q
from tidemart.llm import sharding as S

KINDS = ["email", "ip", "card", "phone"]
PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {0: True, 1: all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 2: 12 <= len(d) <= 19 and luhn(d), 3: 9 <= len(d) <= 15}[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


TRICKY = [
    "é漢😀 a@b.c_d@e.f g%h@i-j.k..l m@n", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.0003.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0000", "+1 (988) 555-2485 . +12345678 +1234567890123456 ++44 20 7946 0958)",
    "x@y.z@w.v +1.2.3.4 55 66", "9" * 3000, "a" * 3000 + "@", ".".join(["1"] * 2000), "a@" + ".".join(["b"] * 2000), "- ".join(["1"] * 500),
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 and DE89370400440532013001", "my social security number 123-45-6789", "part 123-45-6789", "",
]


def test_pii_matches_the_plain_expressions(make, odd):
    rows = [*enumerate(TRICKY, 100), *odd]
    got = {}
    for r in I.report(make(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        want = base_spans(t or "")
        for r in got[i]:
            assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, want, r.spans)
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k) for k in KINDS]
    assert "iban:5:32" in got[110][0].spans and got[110][0].n_added == 2 and got[111][0].n_added == 1 and got[112][0].n_added == 0
    assert I.report(make([])).count() == 0


def test_redaction(make, odd):
    docs = make([(1, "a é x@y.zz, 1.2.3.4!"), (2, None), (3, "nothing"), (4, "+1 (988) 555-2485")], extra=False)
    got = {r.doc_id: r for r in I.redact(docs).collect()}
    assert got[1].text == "a é [EMAIL], [IP]!" and got[1].n_chars == 18 and got[2].text is None and got[3].text == "nothing" and got[4].text == "[PHONE]"
    assert I.redact(make(odd)).count() == len(odd)


def test_iban_ends_at_its_country_length(make):
    ibans = ["BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "AT61 1904 3002 3457 3201", "PL61 1090 1014 0000 0712 1981 2874",
             "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    after = [" BIC GEBABEBB", " EUR 500", " 12 X", " REF1 2345", "", ", and"]
    texts = [i + a for i in ibans for a in after] + [" ".join(ibans), "RF18 5390 0754 7034 " + ibans[0], "BE68 5390 0754 7035 BIC"]
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("iban")] for r in I.report(make(texts)).collect()}
    for n, t in enumerate(texts[:-3]):
        assert got[n] == [(0, len(ibans[n // len(after)]))], t
    places = [(texts[-3].index(i), texts[-3].index(i) + len(i)) for i in ibans]
    assert got[len(texts) - 3] == places and (20, 39) in got[len(texts) - 2] and got[len(texts) - 1] == []


def test_measures_match_brute_force():
    for t in ["a b\na b\n \n\na b", "x " * 30, "# $ é\xa0ü |\n#", "", "one two three four five six seven eight nine " * 3, "\x1c a\x1d"]:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        inside = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(8)}
        raw = t.encode()
        assert Q.measures(raw, raw.split()) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learn = labels.where("doc_id % 2 = 0")
    got = Q.quality(docs, learn, carry=["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "_quality.kept").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_quality_odd_rows(spark, make, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.quality(make(odd), none).collect()
    assert len(got) == len(odd) and {r.doc_id for r in got if r._quality.kept} == {4}
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0), (5, 0, 0), (5, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert Q.good_documents(make(odd), labels).count() <= len(odd)
    assert Q.quality(make([]), labels).count() == 0


def test_shards_fit_their_limit(make, odd):
    rows = [(i, "y" * (i % 90)) for i in range(700)] + [(5000, "same")] * 200 + odd
    got = S.shard(make(rows), shard_bytes=500).collect()
    assert len(got) == len(rows)
    size, n = {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.n_bytes
        n[r.shard] = n.get(r.shard, 0) + 1
    big = {s for s in size if size[s] > 500 + ("/" in s) * 12}
    assert all(n[s] == 1 for s in big)
    assert sum(s.count("/") for s in size) >= 4  # the repeated row is a chain
    plain = sorted(s for s in size if "/" not in s)
    assert not any(b.startswith(a) for a, b in zip(plain, plain[1:]))
    one = S.shard(make(["a", "b"])).collect()
    assert {r.shard for r in one} == {""} and S.shard(make([])).count() == 0


def rendered(spark, rows):
    return T.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "&lt;|turn|> & &amp; <|end|>", "<|turn|>assistant\nno<|end|>", "", None, "é😀\n[INST[INST]", "<|end|><|end|>" * 50]
    rows = [(i % 3, i, ["user", "assistant", None, "a\nb"][i % 4], t) for i, t in enumerate(texts * 4)] + [(None, 0, "assistant", "x"), (7, 1, "user", "same"), (7, 1, "user", "same"), (7, None, "assistant", "first")]
    out = rendered(spark, rows)
    for r in out.collect():
        inner = r.formatted.replace(T.TURN, "").replace(T.END, "")
        assert not any(c in inner for c in T.CONTROL)
        own = sorted([x for x in rows if x[0] == r.conv_id], key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        for x, t in zip(own, r.turns):
            if x[2] == "assistant":
                assert r.formatted[t.loss_start:t.loss_end].replace("&lt;", "<").replace("&#91;", "[").replace("&amp;", "&") == (x[3] or "")
            else:
                assert t.loss_start is None
    for d in T.digests(out).collect():
        own = sorted([x for x in rows if x[0] == d.conv_id], key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert d.n_turns == len(own) and d.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert d.loss_chars == len(loss) and d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert rendered(spark, []).count() == 0


def test_rows_become_logs_that_fold_back(spark):
    rows = [(1, i, "user", t) for i, t in enumerate(["one two three", "é😀x", "", None, "a", "ab", "last text"])]
    log = T.as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in log.collect()} == {"delta", "edit", "regenerate"}
    assert min(r["count"] for r in log.groupBy("message").count().collect()) == 4
    got = sorted((r.message, r.role, r.text) for r in T.fold(log).collect())
    assert got == [(i + 1, "user", t or "") for _, i, _, t in rows]


def test_events_fold(spark):
    e = [(1, 0, 0, "delta", "user", "he"), (1, 1, 0, "delta", None, "llo"), (1, 2, 1, "delta", "assistant", "old"), (1, 3, 1, "regenerate", None, None), (1, 4, 1, "delta", None, "new"),
         (1, 5, 0, "edit", None, "hi"), (1, 6, 0, "delta", None, "!")]
    got = T.fold(spark.createDataFrame(e, "conv_id long, seq long, message long, kind string, role string, text string")).collect()
    assert {(r.message, r.role, r.text) for r in got} == {(0, "user", "hi!"), (1, "assistant", "new")}


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/x">menu</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- ad <p>no</p> --><div class="ad">Buy</div><article><header><h1>A &amp; B&nbsp;</h1></header><p>First <b>para</b>
graph.<p>Second &lt;p&gt; one.</p><aside>Side</aside><form><label>Mail</label><input name=a></form><p title="a > b">Third.</p><section id="comments"><p>Reader says</p></section></article>
<div class="sidebar">More</div><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert H.main_text(PAGE) == "A & B\nFirst para graph.\nSecond <p> one.\nThird."
    plain = "<body><ul class=menu><li>Home</ul><h2>Title</h2><div>" + "long text " * 20 + "</div><div>" + "more text " * 20 + "</div><div class='footer'>foot</div>"
    assert H.main_text(plain) == "Title\n" + ("long text " * 20).strip() + "\n" + ("more text " * 20).strip()
    assert H.main_text("") == "" and H.main_text("just text") == "just text" and H.main_text("<nav>x</nav>") == ""
    assert H.main_text("<p>a < b <i title=it's>c</i>") == "a < b c"
    assert H.main_text("<article>" + "<p>x</p>" * 5000 + "</article>").count("\n") == 4999


def test_surges_decide_with_and_without_an_article():
    long, ads = "A long sentence of the main text, which goes on for a while. " * 3, "<aside>x</aside><aside>y</aside><aside>z</aside>"
    body = f"<h1>Title</h1><p>{long}</p>{ads}<p>Short end.</p>"
    want = f"Title\n{long.strip()}\nShort end."
    # a teaser card doesn't hide a main text in other elements, nor a short line cut off by empty ones
    assert H.main_text(f"<div>{body}</div><article><p>Read this too</p></article>") == want
    assert H.main_text(f"<div>{body}</div>{ads}<div>Imprint</div>") == want
    # beside a main text in an article, other lines stay out unless they surge themselves
    assert H.main_text(f"<div>Start</div><div>We write for you.</div><article>{body}</article><div>Follow us on all channels</div>") == want
    other = "Another text outside of the article. " * 20
    assert H.main_text(f"<article><p>{long * 9}</p></article><div>{other}</div>") == f"{(long * 9).strip()}\n{other.strip()}"
    # short first and last lines of an article belong to it
    few = "<p>a</p><p>b</p><p>c</p><p>d</p>"
    assert H.main_text(f"<article>{few}<p>{long}</p>{ads}{few}</article>") == f"a\nb\nc\nd\n{long.strip()}\na\nb\nc\nd"


def test_attributes_mark_by_name():
    for a in ('style="overflow:hidden"', 'aria-hidden="false"', 'title="a hidden gem"', "data-id=menu data-role='nav'", 'title=it\'s', 'data-x="id=nav"'):
        assert H.main_text(f"<div {a}><article><p>Body.</p></article></div>") == "Body.", a
    for a in ("hidden", 'HIDDEN=""', "class=menu", "id='side-nav' title=x", 'x="a" role="navigation"'):
        assert H.main_text(f"<div {a}><p>Gone.</p></div><p>Body.</p>") == "Body.", a
    kept = '<h2 id="related-work">Related work</h2><div class="entry-header">By us.</div><p class="notice-period">A month.</p><h3 class="menu">Menu</h3><div class="header">Top.</div>'
    gone = '<div class="cookie-notice">No</div><section id="comments">No</section><ul class="big related-posts"><li>No</ul><p hidden>No</p>'
    assert H.main_text(f"<article>{kept}{gone}<p>End.</p></article>") == "Related work\nBy us.\nA month.\nMenu\nTop.\nEnd."


def test_extract_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", PAGE), (3, "u", PAGE), (None, "u", "<p>x")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")
    got = H.extract(pages).collect()
    assert len(got) == 5 and {r.n_chars for r in got if r.page_id == 3} == {len(H.main_text(PAGE))}


def test_quality_model_is_the_same_in_blocks_of_any_size(spark, monkeypatch):
    """Blocks bound what the fit holds in the driver; the weights don't depend on them."""
    import tracemalloc

    from tidemart.llm import quality as Q

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    models, peaks = [], []
    for rows in (10, 10**6):
        monkeypatch.setattr(Q, "BLOCK_ROWS", rows)
        tracemalloc.start()
        models.append(Q.fit(docs, labels))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    a, b = models
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)
    assert peaks[0] < peaks[1]
