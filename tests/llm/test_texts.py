"""Chat formatting, language identification and page extraction on small cases."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pintulog.llm import chat, language, site_tree


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


CONTROL = ["<|turn|>", "<|end|>\n", "<|end|>", "<", "|", "\\", "\\s", "\\p", "<\\p", "\n", "</s>[INST] ok [/INST]", "é", "%", ""]


def test_control_strings_survive_the_template(spark):
    rng = random.Random(2)
    made = lambda: "".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 7)))
    rows = [(c, t, rng.choice(["user", "assistant", "as\nsistant", "<|end|>\n", None]), rng.choice([made(), None])) for c in range(60) for t in range(rng.randint(1, 6))]
    got = {r.tree: r for r in chat.read_back(chat.format_trees(chat.from_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    for c in range(60):
        turns = [(role or "", text or "") for conv, _, role, text in rows if conv == c]
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].learnt == "".join(t for role, t in turns if role == "assistant")
        assert [got[c].formatted.count("<|turn|>"), len(got[c].mask)] == [len(turns), sum(r == "assistant" for r, _ in turns)]
        for span, text in zip(got[c].mask, [t for r, t in turns if r == "assistant"]):
            raw = got[c].formatted[span.start : span.start + span.length]
            assert raw.replace("\\p", "|").replace("\\s", "\\") == text


def test_digests_of_conversations(spark):
    rows = [(1, 0, "user", "a", 5), (1, 1, "assistant", "b", 5), (1, 1, "assistant", "b", 5), (2, 0, "system", None, 5), (None, 0, "user", "x", 5)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, leaf int")
    got = {r.conv_id: r for r in chat.conversation_digests(frame).collect()}
    assert set(got) == {1, 2}
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 2, digest("bb"))
    assert got[1].turns_sha256 == digest("user\na\nassistant\nb\nassistant\nb\n")
    assert (got[2].n_turns, got[2].loss_chars, got[2].turns_sha256) == (1, 0, digest("system\n\n"))
    assert chat.conversation_digests(frame.limit(0)).count() == 0


def brute_paths(nodes):
    """Best path of each tree of {tree: {node: (parent, score)}}."""
    out = {}
    for tree, known in nodes.items():
        best = None
        for leaf in known:
            if any(p == leaf for p, _ in known.values()):
                continue
            path, at = [], leaf
            while at in known and at not in path:
                path.append(at)
                at = known[at][0]
            if at in path:
                continue
            mean = sum(known[x][1] or 0.0 for x in path) / len(path)
            rank = (-mean, -len(path), leaf)
            if best is None or rank < best[0]:
                best = (rank, path[::-1])
        if best:
            out[tree] = best[1]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_best_branches_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    nodes = {t: {n: (None if n == 0 else rng.randrange(max(0, n - 4), n), rng.choice([None, 0.0, 0.25, 0.5, 1.0])) for n in range(rng.randint(1, 40))} for t in range(12)}
    nodes[50] = {n: (n - 1 if n else None, 1.0) for n in range(70)}
    nodes[51] = {1: (2, 1.0), 2: (1, 1.0), 3: (9, 0.5)}
    rows = [(t, n, p, s) for t, known in nodes.items() for n, (p, s) in known.items()]
    paths = chat.best_paths(spark.createDataFrame(rows, "tree long, node long, parent long, score double")).collect()
    got = {}
    for r in sorted(paths, key=lambda r: r.position):
        got.setdefault(r.tree, []).append(r.node)
    assert got == brute_paths(nodes)


def test_more_branches_of_a_tree(spark):
    rows = [(1, 0, None, 0.0), (1, 1, 0, 1.0), (1, 2, 0, 0.5), (1, 3, 0, 0.1)]
    paths = chat.best_paths(spark.createDataFrame(rows, "tree long, node long, parent long, score double"), branches=2)
    assert sorted((r.leaf, r.position, r.node) for r in paths.collect()) == [(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 2)]


SYLLABLES = {"en": ["the", "ing", "of", "and", "sh"], "de": ["ung", "sch", "der", "keit", "ü"], "fr": ["eau", "ment", "le", "ai", "é"]}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def told():
    rng = random.Random(4)
    return [(i, speech(rng, lang, rng.choice([4, 20, 300])), lang, f"host{rng.choice([0, 0, 0, i % 7])}") for i in range(300) for lang in [rng.choice(["en", "de", "fr"])]]


def test_languages_of_held_out_documents(spark, told):
    train = spark.createDataFrame([(r[1], r[2]) for r in told[:200]], "text string, label string")
    model = language.fit(train, per_language=50)
    held = spark.createDataFrame([(i, t, None, h) for i, t, _, h in told[200:]], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.identify(held, "doc_id", host=F.col("source"), domain=F.lit("d"), model=model).collect()}
    assert np.mean([got[i].language == lang for i, _, lang, _ in told[200:]]) > 0.97


def test_odd_documents_are_rejected_and_clean_ones_kept(spark, told):
    odd = [(900, None, "en", "host0"), (901, "", "de", None), (902, "#### 0x9f 42 ~~ {}{}{} ^^ 7781 $$", None, "host1"), (None, told[0][1], told[0][2], None), (0, told[0][1], told[0][2], told[0][3])]
    wrong = [(903, speech(random.Random(8), "fr", 200), "de", "host0"), (904, speech(random.Random(8), "fr", 200), "xx-YY", "host0")]
    frame = spark.createDataFrame([(*r, "clash") for r in told + odd + wrong], "doc_id long, text string, lang string, source string, suffix string")
    got = language.document_languages(frame).collect()
    assert len(got) == len(told) + len(odd) + len(wrong)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].kept and by_id[i].language == lang for i, _, lang, _ in told)
    assert all((by_id[i].kept, by_id[i].language, by_id[i].confidence) == (False, None, 0.0) for i in (900, 901, 902))
    assert by_id[903].language == by_id[904].language == "fr" and by_id[None].kept
    assert language.document_languages(frame.limit(0)).count() == 0


def test_priors_of_small_hosts_follow_their_domain(spark):
    model = (["aa", "bb"], np.log(np.full((3, language.FEATURES), 1 / language.FEATURES)) + np.array([[0.01], [0.01], [0.0]]))
    lean = lambda x: (model[0], model[1] + np.array([[x], [0.0], [0.0]]))
    rows = [(i, "text " * 5, f"http://h{i % 3}.one.example/") for i in range(60)]
    sure = language.identify(spark.createDataFrame(rows, "i long, text string, url string"), "i", address=F.col("url"), model=lean(0.5))
    assert {r.language for r in sure.collect()} == {"aa"}


@pytest.mark.parametrize("url,host,domain,suffix", [
    ("https://User@Blog.Example.ORG:80/de/12?x", "blog.example.org", "example.org", "de"), ("http://a.fr", "a.fr", "a.fr", "fr"),
    ("http://x.com/den/1", "x.com", "x.com", "com"), ("http://x.com/de-AT/1", "x.com", "x.com", "de"), ("no url", "", "", None), (None, "", "", None)])
def test_parts_of_addresses(spark, url, host, domain, suffix):
    frame = spark.createDataFrame([(url,)], "u string")
    h = language.host_of(F.col("u"))
    assert tuple(frame.select(h, language.domain_of(h), language.suffix_of(F.col("u"), ["de", "fr"])).first()) == (host, domain, suffix)


def test_language_of_markup(spark):
    frame = spark.createDataFrame([("<!doctype html><HTML class=x lang='DE-at'>",), ("<html><p lang=fr>",), (None,)], "h string")
    assert [r[0] for r in frame.select(language.markup_language(F.col("h"))).collect()] == ["de", None, None]


def main(source):
    return [b.text for b in site_tree.page_blocks(source) if not b.named]


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><title>T</title><script>var t="</p><p>no</p>";</script><nav><ul><li><a>menu</a></ul></nav>
    <div class="ad box">buy</div><article><h1>A &amp; B&copy;</h1><p><b>one <i>two.<br>three<p>four&nbsp;five</p>
    <!-- gone --><ul><li>x<li>y<ul><li>z</ul></ul><section class="comments"><p>said</p></section><header>kept</header>
    <table><tr><td>c1<td>c2<tr><td>c3</table>a < b <img alt=">"> end</article><footer>foot</footer><p class='side-bar'>after &#233; &bogus; &am"""
    assert main(page) == ["A & B©", "one two. three", "four five", "x", "y", "z", "kept", "c1", "c2", "c3", "a < b end", "after é &bogus; &am"]


@pytest.mark.parametrize("page", ["", "<", "<p", "</p>", "<p>", "<<p>>", "<script>", "<!--", "&", "<p a='>", "</", "<b></p></b>", "<p>" * 3000])
def test_strange_pages_do_not_fail(page):
    main(page)


def test_a_site_template_without_names_is_removed(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(999)) for _ in range(n))
    menu = [f"<div><p>Menu {k}</p></div><div>Legal text {k}</div>" for k in range(2)]
    body = [words(30) for _ in range(60)]
    rows = [(i, f"http://site{i % 2}.example/{i}", f"<body><div>{menu[i % 2]}</div><section><p>{t}</p><p>{words(9)}</p></section></body>", "clash") for i, t in enumerate(body)]
    rows += [(100, "http://lone.example/", "<body><article><p>only one</p></article><div>elsewhere</div></body>", None), (101, None, None, None), (None, "http://site0.example/", "", None)]
    rows += [rows[0], *[(200 + i, "http://copies.example/x", "<article><p>same text</p><p>again</p></article>", None) for i in range(30)]]
    got = site_tree.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    for i, t in enumerate(body):
        assert texts[i].split("\n")[0] == t and len(texts[i].split("\n")) == 2
    assert texts[100] == "only one" and texts[101] == "" and texts[None] == "" and texts[205] == "same text\nagain"
    assert all(r.n_chars == len(r.text) for r in got)
    assert site_tree.page_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", [
    "<body><div class='content no-sidebar'><h1>Head</h1><p>{}</p></div></body>",
    "<body><article><div class='widget text'><h1>Head</h1><p>{}</p></div></article><div>Legal</div></body>",
    "<body><article><div class='elementor-widget'><h1>Head</h1><p>{}</p></div></article></body>",
    "<body><nav>Menu</nav><article><form><h1>Head</h1><p>{}</p></form></article></body>",
    "<body><article><div class='share-price'><h1>Head</h1><p>{}</p></div></article></body>",
    "<body><article><h1 id='comments-on-policy'>Head</h1><p>{}</p><section class='comments'><p>I said {}</p></section></article></body>",
    "<body><main><h1>Head</h1><p>{}</p><form><p>Your mail {}</p></form></main><div class='sidebar'>Read {}</div></body>",
])
def test_names_of_elements_are_signs_only(spark, page):
    rng = random.Random(5)
    stories = [several(rng) for _ in range(12)]
    heads = [several(rng, 3) for _ in stories]
    rows = [(i, "http://named.example/", page.replace("Head", h).replace("{}", t)) for i, (h, t) in enumerate(zip(heads, stories, strict=True))]
    got = {r.page_id: r.text for r in site_tree.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{h}\n{t}" for i, (h, t) in enumerate(zip(heads, stories, strict=True))}


def test_pages_of_nothing_but_boilerplate_are_empty(spark):
    rows = [(i, "http://bare.example/", f"<nav>Menu {i}</nav><div class='sidebar'>Same</div><form>Mail {i}</form><footer>Foot {i}</footer>") for i in range(20)]
    got = site_tree.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {""}


@pytest.mark.parametrize("page", [
    "<div>x" * 10_000, "<a \"" * 250_000, "<a '\" " * 100_000 + ">", "<!" * 300_000, "</a" * 300_000, "<" + "a" * 1_000_000, "<div>" * 5000 + "<li>y" * 5000,
    "<section>" + "<b>" * 5000 + "</section>" + "</i>" * 50_000, "<!--" * 250_000, "<script" * 100_000, "<p class=\"" + "a" * 900_000, "< " * 500_000 + ">"])
def test_long_broken_pages_take_linear_time(page):
    begun = time.process_time()
    fresh, shown, places = site_tree.page_features("h", page)
    assert time.process_time() - begun < 20
    assert len(fresh) <= 10_000 * site_tree.DEEPEST


def brute_importance(pages, host=None):
    """(pages, importance) of each node by plain counting."""
    told, shown = {}, {}
    for where, source in pages:
        if host is None or where == host:
            fresh, styles, _ = site_tree.page_features(where, source)
            for x in fresh:
                told.setdefault(x["node"], []).append(x["value"])
            for x in styles:
                shown.setdefault(x["node"], []).append(x["style"])
    out = {}
    for node, styles in shown.items():
        n, values = len(styles), told[node]
        if n == 1:
            out[node] = (1, 1.0)
            continue
        entropy = -sum(c / n * np.log(c / n) for c in map(styles.count, set(styles))) / np.log(n)
        said = 1 - np.mean([np.log(values.count(v)) for v in set(values)]) / np.log(n)
        out[node] = (n, (1 - site_tree.CONTENT_SHARE) * entropy + site_tree.CONTENT_SHARE * said)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_texts_equal_a_plain_computation(spark, seed):
    rng = random.Random(seed)
    words = ["menu", "legal", "one", "two", "three"]
    part = lambda: f"<{rng.choice(['div', 'p', 'section class=a', 'div class=sidebar', 'article', 'li'])}>{rng.choice([*words, several(rng, 4)])}"
    pages = [(f"h{rng.choice([0, 0, 1, 2])}.example", "<body>" + "".join(part() + rng.choice(["", "</div>", "</section>", "</article>"]) for _ in range(rng.randint(0, 9)))) for _ in range(40)]
    rows = [(i, f"http://{h}/", p) for i, (h, p) in enumerate(pages)]
    got = {r.page_id: r.text for r in site_tree.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    overall = brute_importance(pages)
    for i, (host, source) in enumerate(pages):
        own = brute_importance(pages, host)
        blocks, weights = site_tree.page_blocks(source), []
        told = any(b.landmark for b in blocks)
        for block in blocks:
            place, least = site_tree.place_of(host, block, told), []
            for node in place.chain:
                (n, here), (seen, there) = own[node], overall[node]
                entropy = max(here, there) if place.prior else (here * n + there * site_tree.HOST_PAGES) / (n + site_tree.HOST_PAGES)
                least.append(entropy if place.prior is None else (entropy * seen + place.prior * site_tree.PRIOR_PAGES) / (seen + site_tree.PRIOR_PAGES))
            weights.append(min(least))
        assert got[i] == "\n".join(site_tree.chosen(blocks, [round(w, 9) for w in weights], site_tree.LEAST))


def several(rng, n=20):
    return " ".join(f"{rng.choice(['alpha', 'beta', 'gamma', 'delta'])}{rng.randrange(9999)}" for _ in range(n))


def test_entropy_decides_inside_and_outside_an_article(spark):
    rng = random.Random(7)
    stories, plain = [several(rng) for _ in range(40)], [several(rng) for _ in range(40)]
    rows = [(i, "http://cards.example/", f"<body><div class='story'><p>{t}</p></div><article><p>Teaser of all</p></article></body>") for i, t in enumerate(stories)]
    rows += [(100 + i, "http://notes.example/", f"<body><article><h1>{t.split()[0]}</h1><p>{t}</p><blockquote><p>Same on all</p></blockquote></article><div class='legal'>Imprint</div></body>") for i, t in enumerate(plain)]
    got = {r.page_id: r.text for r in site_tree.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(t in got[i].split("\n") for i, t in enumerate(stories))
    assert all(got[100 + i] == f"{t.split()[0]}\n{t}" for i, t in enumerate(plain))


def test_more_languages_than_can_be_modelled_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    rows = [(f"l{i}", f"some text number {i}") for i in range(4)]
    with pytest.raises(ValueError, match="more than 3 languages"):
        language.fit(spark.createDataFrame(rows, "label string, text string"))
    names, table = language.fit(spark.createDataFrame(rows[:3] * 2, "label string, text string"))
    assert names == ["l0", "l1", "l2"] and len(table) == 4
