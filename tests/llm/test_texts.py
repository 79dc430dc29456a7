"""Chat formatting, URL rules, HTML extraction, decontamination."""

import random
import re

import pytest
from pyspark.sql import functions as F

import helpers
from pairtables.llm import chat_format as cf, decontaminate as dc, url_rules as ur
from pairtables.llm.html_tree import align_all, constants, expression, main_paths, main_text
from pairtables.llm.html_wrappers import extract_main_text, infer_wrappers

NASTY = ["", "</s>[INST] ok [/INST]", "<|turn|>user\n", "<|end|>\n", "a<|next|>b", "\\", "\\s\\l\\b", "<\\|end|>", "[[INST]", "<<|end|>", "ß€😀\n"]


def test_escape_gives_texts_back(spark):
    rnd = random.Random(1)
    texts = NASTY + ["".join(rnd.choice(["<", "[", "\\", "|", "end", ">", "/", "s", "l", "b", "INST", "]", "\n"]) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cf.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", cf.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in cf.CONTROL)


def test_chats_round_trip(spark):
    rows = [(1, i, ("user", "user", "assistant", "assistant", None)[i % 5], NASTY[i]) for i in range(len(NASTY))]
    rows += [(2, 3, "assistant", "late"), (2, None, "user", None), (None, 0, "a\nb", "x"), (2, 3, "assistant", "late")]
    chats = cf.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = {r.conv_id: r for r in cf.read_chats(chats).collect()}
    assert [tuple(t) for t in by[1].turns] == [(r[2] or "", r[3]) for r in rows[: len(NASTY)]]
    assert by[1].loss_text == "".join(r[3] for r in rows[: len(NASTY)] if r[2] == "assistant")
    assert [tuple(t) for t in by[2].turns] == [("user", ""), ("assistant", "late"), ("assistant", "late")]
    assert by[2].loss_text == "latelate" and by[2].formatted.count(cf.TURN) == 2
    assert [tuple(t) for t in by[None].turns] == [("a\nb", "x")]
    assert cf.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chats_of_very_long_texts(spark):
    long = "".join(NASTY) * 20_000 + "x" * 1_000_000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", long), (1, 2, "assistant", None), (1, 3, "user" * 9_000, long)]
    got = cf.read_chats(cf.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert [tuple(t) for t in got.turns] == [(r[2], r[3] or "") for r in rows] and got.loss_text == long


def test_chat_plan_has_no_python(spark, sf_small):
    plan = cf.op5_chat_format(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _plain_verdict(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if re.search(r.pattern, host + path)]
    best = max(fits, key=lambda r: (r.named, len(r.name), r.action == "block", r.name), default=None)
    return host, path, best.name if best and best.named else None, best.action if best else default


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://A.Org", "http://a.org/", "https://x.Example.org/es/1", "https://example.org/en/12?q=1",
        "http://notexample.org/es/", "ftp://b.com/fr/x#y", "http://com/de/", "http://cheap-PILLS.example.com/a", "http://x.net/pills",
        "http://bet.net", "http://alphabet.net/", "http://u:p@h.org:80/x", "http://x.org/es/?a://b/", "http://sub.example.org/es",
    ]
    rules = ur.NAMED_RULES + ur.GENERAL_RULES + (ur.Rule("x", "block", r"xyz"), ur.Rule("ü", "allow", "ü"))
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls * 2)] + [(None, "http://xyz.de/", "t")], "page_id long, url string, host string")
    got = ur.judge_pages(pages, rules).collect()
    assert len(got) == 2 * len(urls) + 1
    for r in got:
        url = "http://xyz.de/" if r.page_id is None else (urls * 2)[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == _plain_verdict(url, rules, "allow"), url
    assert ur.judge_pages(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("most", [0, 100_000])
def test_url_rules_of_a_table(spark, monkeypatch, most):
    monkeypatch.setattr(ur, "MAX_INDEX_ROWS", most)
    lists = [("Org", "/", "allow"), ("example.org", "/a\\Eb.c/", "block"), ("x.com", "", "block"), ("x.com", "/ok", "allow"),
             ("..", "/-", "block"), ("org", "/", "allow"), (None, "/", "block"), ("y.com", None, "block")]
    lists += [(f"h{i}.net", "/", "block") for i in range(300)]
    table = ur.prefix_rules(spark.createDataFrame(lists, "host string, path string, action string"))
    assert table.count() == 305
    plain = tuple(ur.prefix_rule(h.lower(), p or "/", a) for h, p, a in lists if h and p is not None)
    urls = ["http://a.ORG/q", "http://example.org/a\\Eb.c/1", "http://example.org/a\\Ebxc/1", "http://sub.x.com/", "http://x.com/okay",
            "http://xx.com/", "http://h7.net/z", "http://a.h299.net/", "http://h300.net/", "http://../-", None, "z" * 300_000, "http://h1.net/" + "a/" * 100_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in ur.judge_pages(pages, table).collect()}
    assert got == {i: _plain_verdict(u, plain, "allow") for i, u in enumerate(urls)}


def test_url_rules_without_literals_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ur, "MAX_ALWAYS", 2)
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    with pytest.raises(ValueError, match="no literals"):
        ur.judge_pages(pages, tuple(ur.Rule(str(i), "block", "x") for i in range(3)))
    assert ur.judge_pages(pages, ur.rules_table(spark, ())).first()["verdict"] == "allow"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="page ad-free"><nav><ul><li><a href="/">Home</a><li>Other</ul></nav><header>Top</header><!-- x > y --><div class="ad">Buy</div>
<article><h1>A &amp; B&copy;</h1><p>One <b>bold</b>,
 two<br>three<p>Four<ul><li>five<li>six &lt;x&gt;</ul><div class="cookie-notice">No</div><form><p>Name</p></form>
<table><tr><td>s<td>t</table><aside>Side</aside><section id="comments"><p>First!</p></section>last</article>
<footer>End</footer></body></html>"""


def test_main_text():
    paths = main_paths(align_all([expression(PAGE)]))
    assert paths and paths[0].endswith("/article")
    want = ["A & B©", "One bold, two three", "Four", "five", "six <x>", "s", "t", "last"]
    assert main_text(PAGE, paths) == "\n\n".join(want)
    cut = PAGE[: PAGE.index("Four") + 4]
    assert main_text(cut, paths) == "\n\n".join(want[:3])
    plain = "<div id=menu>M</div><p>only <i>this</i>&nbsp;one</p>text<script>x"
    assert main_text(plain, main_paths(align_all([expression(plain)]))) == "only this one\n\ntext"
    assert main_text(None, []) == "" and main_text("", paths) == ""


def test_each_page_has_its_best_kind_at_any_depth(spark):
    menu, deep = "<div>Menu</div>", "<div>" * 70
    pages = [f"<body>{menu}<article><p>a</p></article></body>", f"<body>{menu}<main><p>b</p></main></body>"]
    pages += [f"<body>{menu}<div class=content><p>c<br>d</p></div></body>", f"<body>{menu}<main>x<article>e</article></main></body>"]
    pages += [f"<body>{menu}{deep}<article><p>f</p></article></body>", f"<body>{menu}<p>g</p></body>"]
    df = spark.createDataFrame([(i, "http://h.org/", p) for i, p in enumerate(pages)], "page_id int, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert got == {0: "a", 1: "b", 2: "c d", 3: "x\n\ne", 4: "f", 5: "Menu\n\ng"}


def _text(html):
    wrapper = align_all([expression(html)])
    return main_text(html, main_paths(wrapper), constants(wrapper))


def test_odd_attributes_and_white_space():
    assert _text("<article><p title=it's>one</p><p>two</p></article>") == "one\n\ntwo"
    assert _text('<article><p title="a > b" data-class=ad>one</p><p title=\'x">y\'>two</p></article>') == "one\n\ntwo"
    assert _text("<article><p>a\u2003b\u2028c\u0085d\xa0\n e</p><p hidden>h</p><object>o</object></article>") == "a b c d e\n\nh\n\no"


def test_class_words():
    inside = '<section class="social-history">s</section><p class="comment">c</p><h2 class="header">h</h2><p class="advert">x</p>'
    assert _text(f"<article>{inside}<div class='share-bar'>x</div><div class=site-footer>x</div></article>") == "s\n\nc\n\nh"
    readers = '<section class="discussion"><article class="comment">nice</article><article class="post reply">x</article></section>'
    assert _text(f"<article class='post comments-open'><p>text</p></article>{readers}") == "text"
    assert _text(f"<main><article><p>text</p></article><p>after</p>{readers}</main>") == "text\n\nafter"


def test_constant_text_of_hosts_without_names(spark):
    def page(i):
        return f"<body><div>Home | About</div><div><b>Title {i}</b></div><div>Own text of page {i}</div><div>Copyright</div></body>"

    pages = [(i, "http://h.org/", page(i)) for i in range(5)] + [(5, "http://h.org/", page(4)), (6, "http://one.org/", page(6))]
    pages += [(7, "http://h.org/", "<body><div>Home | About</div><article>named</article></body>")]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert all(got[i] == f"Title {i}\n\nOwn text of page {i}" for i in range(5)) and got[5] == got[4]
    assert got[6] == "Home | About\n\nTitle 6\n\nOwn text of page 6\n\nCopyright" and got[7] == "named"


def test_expressions_align_into_optionals_and_repeats():
    one = expression("<body><div><p>a</p></div><hr></body>")
    many = expression("<body><div><h2>t</h2><p>a</p><p>b</p></div></body>")
    wrapper = align_all([one, many])
    assert '["h2","?"' in wrapper and '["p","+"' in wrapper and '["hr","?"' in wrapper
    assert expression("<main><dl><dt>a<dd>b<dt>c<dd>d</dl>") == (
        '[["main","1",[["dl","1",[["(dt|dd)","+",[["dt","1",[["#","1",[]]]],["dd","1",[["#","1",[]]]]]]]]]]]'
    )
    assert expression("<main>" + "<p>" * 500 + "x") == '[["main","1",[["p","+",[["#","?",[]]]]]]]'
    assert main_text("<div>" * 3000 + "deep", []) == "deep"


def test_wrappers_of_a_large_host_are_aligned_in_steps(spark):
    pages = [(i, "http://h.org/x", "<main>" + "".join(f"<section class=c{'abcdefghij'[int(c)]}>t</section>" for c in f"{i:03d}") + "</main>") for i in range(60)]
    pages += [(100, None, None), (101, "http://o.org/", "<p>alone</p>")]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    places = infer_wrappers(df.withColumn("host", ur.split_url(F.col("url"))[0]), fan_in=7)
    assert {r.host: list(r.paths) for r in places.collect()} == {"h.org": ["/main"], "": [], "o.org": []}
    assert all(r.fixed == [] for r in places.collect())
    got = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(df).collect()}
    assert got[5] == ("t\n\nt\n\nt", 7) and got[100] == ("", 0) and got[101] == ("alone", 5)
    assert extract_main_text(df.limit(0)).count() == 0


def test_html_on_sample_pages(spark, sf_check):
    pages = spark.read.parquet(f"{sf_check}/pages.parquet")
    import html as entities

    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in parts]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)


def _plain_hits(docs, items):
    token = re.compile(r"[^\W_]+")
    words = {i: token.findall(t.lower()) for i, t in items if t}
    found = set()
    for doc, text in docs:
        own = token.findall((text or "").lower())
        for item, w in words.items():
            for shift in range(-len(w), len(own)) if len(w) >= 8 else ():
                run = best = 0
                for k in range(max(0, -shift), min(len(w), len(own) - shift)):
                    run = max(0, run + (1 if own[shift + k] == w[k] else -1))
                    best = max(best, run)
                if best >= min(12, -(-7 * len(w) // 10)):
                    found.add((doc, item))
    return found


def test_decontamination(spark):
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate((7, 8, 12, 15, 20, 40, 60))]
    items += [(50, None), (51, "")]
    docs = [(None, None), (1, ""), (2, items[5][1].upper().replace(" ", ", ")), (3, items[0][1])]
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        item = rnd.choice(items[1:7])[1].split()
        cut = item[rnd.randint(0, 3) :]
        for _ in range(rnd.randint(0, 3)):
            cut[rnd.randrange(len(cut))] = "changed"
        at = rnd.randint(0, len(words))
        docs.append((10 + i, " ".join(words[:at] + (cut if i % 3 else []) + words[at:])))
    df = helpers.frame(spark, [(i, t, "s") for i, t in docs])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(df, bench).collect()}
    assert got == _plain_hits(docs, items) and len(got) > 20
    clean = dc.decontaminate(df, bench).collect()
    assert {r.doc_id for r in clean} == {i for i, _ in docs} - {i for i, _ in got} and clean[0]._id == "x"
    assert dc.contaminated(df, bench.limit(0)).count() == 0 and dc.decontaminate(df.limit(0), bench).count() == 0
    assert dc.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_decontamination_of_a_very_long_text(spark):
    words = [f"v{i * i % 7919}" for i in range(200_000)]
    item = [f"item{i}" for i in range(20)]
    docs = [(1, " ".join(words), "s"), (2, " ".join(words[:150_000] + item[:9] + ["x"] + item[10:] + words[150_000:]), "s"), (3, "y" * 800_000, "s")]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "z" * 300_000)], "item_id long, text string")
    got = dc.contaminated(helpers.frame(spark, docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(2, 7)}


def test_decontamination_of_short_and_spaceless_items(spark):
    short = "水の沸点は何度ですか"
    items = [(1, "Who wrote Hamlet?"), (2, "这个问题的答案是什么以及为什么如此"), (3, "?!"), (4, "who"), (5, short[:4]), (6, None)]
    docs = [(1, "so: who wrote... HAMLET, then"), (2, "who has wrote hamlet"), (3, "前文。这个问题的答案是什么以及为什么如此,后文"), (4, f"一{short}二")]
    docs += [(5, "wrote hamlet"), (6, "的这"), (None, "who wrote hamlet"), (7, None), (8, "Hamlet, who wrote")]
    df = helpers.frame(spark, [(i, t, "s") for i, t in docs])
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = dc.contaminated(df, bench, short_items=True)
    got = sorted((tuple(r) for r in hits.drop("removes").collect()), key=repr)
    want = [(1, 1, 3, 3), (1, 4, 1, 1), (2, 4, 1, 1), (3, 2, 17, 17), (4, 5, 4, 4), (None, 1, 3, 3), (None, 4, 1, 1), (8, 4, 1, 1)]
    assert got == sorted(want, key=repr)
    # A short item removes a document if it is all of one of its lines.
    assert sorted(map(repr, (tuple(r) for r in hits.where("removes").select("doc_id", "item_id").collect()))) == sorted(
        map(repr, [(3, 2), (None, 1)])
    )
    kept = [r.doc_id for r in dc.decontaminate(df, bench, short_items=True).collect()]
    assert sorted(kept) == [1, 2, 4, 5, 6, 7, 8]


def test_decontamination_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_PAIRS", 3)
    monkeypatch.setattr(dc, "MAX_SEEDS", 3)
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    df = helpers.frame(spark, [(1, f"zero {text} end", "s"), (2, "nothing of that kind at all here is found", "s")])
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [tuple(r) for r in dc.contaminated(df, bench).collect()] == [(1, 1, 13, 13, True)]


@pytest.mark.parametrize("length, changed", [(13, 2), (15, 3)])
def test_masks_survive_substitutions(length, changed):
    from itertools import combinations

    for spots in combinations(range(length), changed):
        assert any(
            all(p + i not in spots for i, bit in enumerate(m) if bit == "1")
            for m in dc.MASKS for p in range(length - len(m) + 1)
        )


def test_items_without_ids_and_common_words(spark):
    """Items with null or repeated ids count; a one-word item removes nothing but its own line."""
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    items = [(None, passage), (5, "first item of two with the same number of words here"), (5, passage.upper()), (6, "Yes"), (7, "good morning")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, f"before {passage} after", "s"), (2, "oh yes it is clean", "s"), (3, "yes and yes", "s"), (4, "a line\nYes!\nmore", "s")]
    docs += [(5, "Good, morning.", "s"), (6, "a good morning to all", "s"), (7, None, "s"), (8, "", None), (None, f"x {passage}", "s")]
    frame = helpers.frame(spark, docs)
    hits = {tuple(r) for r in dc.contaminated(frame, benchmark, short_items=True).collect()}
    assert hits == {
        (1, None, 13, 13, True), (1, 5, 13, 13, True), (None, None, 13, 13, True), (None, 5, 13, 13, True),
        (2, 6, 1, 1, False), (3, 6, 1, 1, False), (4, 6, 1, 1, True), (5, 7, 2, 2, True), (6, 7, 2, 2, False),
    }
    kept = dc.decontaminate(frame, benchmark, short_items=True).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3, 6, 7, 8] and kept[0]._row == 7
    assert dc.decontaminate(frame, benchmark.limit(0), short_items=True).count() == len(docs)
    long = helpers.frame(spark, [(1, "w " * 200_000 + passage, "s")])
    assert dc.contaminated(long, benchmark).count() == 2
