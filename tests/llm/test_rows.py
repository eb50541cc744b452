"""Operators that judge each text by itself, against plain Python."""

import random
import re
from collections import Counter
from html.parser import HTMLParser

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scriptorium.llm import html_text, license_scan, pii, quality_classifier, quality_rules, token_counts

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_rules(docs, rows, empty):
    got = quality_rules.judged(docs, out="q").select("doc_id", "q.*").collect()
    want = []
    for doc_id, text, *_ in rows:
        text = text or ""
        w = SPACE.findall(text)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        often = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if SPACE.search(x)]
        want.append((doc_id, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(want)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality_rules.kept_documents(empty).count() == 0


def _spans(text):
    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    return [(k, m.start(), m.end()) for k, p in plain.items() for m in re.finditer(p, text) if fits(k, m.group())]


def test_pii_base_spans(docs, rows, empty):
    got = Counter((r.doc_id, tuple(map(tuple, r.base))) for r in pii.detected(docs).collect())
    assert got == Counter((d, tuple(_spans(t or ""))) for d, t, *_ in rows)
    assert pii.detected(empty).count() == 0 and pii.masked(empty).count() == 0


def test_pii_contexts_reveal_identifiers(spark):
    seeds = [(i, f"please call me at +1 (4{i:02d}) 555-24{i:02d} now") for i in range(12)]
    new = [(100 + i, f"please call me at 555-123-45{i:02d} now, version 2.0 of 1234567") for i in range(3)]
    docs = spark.createDataFrame(seeds + new + new, "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.detected(docs).collect()}
    assert all(found[100 + i] == [("phone", 18, 30)] for i in range(3))
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[100] == "please call me at [PHONE] now, version 2.0 of 1234567"
    assert pii.masked(docs).count() == docs.count()


def test_pii_bootstrapping_goes_on_from_what_it_finds(spark):
    texts, want = [], {}

    def add(text, found=None, kind="phone"):
        if found:
            want[len(texts)] = [(kind, text.index(found), text.index(found) + len(found))]
        texts.append(text)

    for i in range(4):
        add(f"please call me at +1 (4{i:02d}) 555-24{i:02d} now", f"+1 (4{i:02d}) 555-24{i:02d}")
        add(f"kindly dial +1 (5{i:02d}) 555-24{i:02d} today", f"+1 (5{i:02d}) 555-24{i:02d}")
        add(f"reach us via +1 (6{i:02d}) 555-24{i:02d} or", f"+1 (6{i:02d}) 555-24{i:02d}")
        add(f"reach us via a{i}@example.org or", f"a{i}@example.org", "email")
    for i in range(10):
        add(f"please call me at 555-123-45{i:02d} now", f"555-123-45{i:02d}")  # more unseen values than seeds
        add(f"kindly dial 030 123 45{i:02d} today", f"030 123 45{i:02d}")  # spaced groups
        add(f"reach us via 888-123-45{i:02d} or")  # a context of two kinds
        add(f"the invoice has number 99-{i}-777-22 in it")  # no labelled value
    for i in range(4):
        add(f"my desk line is 555-123-45{i:02d} here", f"555-123-45{i:02d}")  # what the first hop found
        add(f"my desk line is 77{i}.88.99 here", f"77{i}.88.99")  # second hop
        add(f"and fax it to 77{i}.88.99 please", f"77{i}.88.99")
        add(f"and fax it to 1234567{i} please", f"1234567{i}")  # third hop
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in pii.detected(docs).collect() if r.spans} == want
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[17] == "kindly dial [PHONE] today"


def test_pii_numbers_unlike_the_kind_are_left(spark):
    """A few seeds in a context of ordinary numbers do not make these identifiers."""
    texts = [f"Order number {52893411 + i} was paid." for i in range(30)] + [f"Order number +44 20 7946 10{i:02d} was paid." for i in range(3)]
    texts += [f"parcel code {4520017733 + i} sent" for i in range(20)] + [f"parcel code +44 20 7946 20{i:02d} sent" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in pii.detected(docs).collect() if r.spans} == {30, 31, 32, *range(53, 57)}
    assert {r.doc_id for r in pii.masked(docs).collect() if r.text != texts[r.doc_id]} == {30, 31, 32, *range(53, 57)}


def test_pii_precision_and_recall_of_contexts(spark):
    """Planted contexts: precision 1.0, recall 1.0 of unseen identifiers whose context has at least three seeds."""
    rnd = random.Random(12)
    number = lambda n: "".join(rnd.choice("123456789") for _ in range(n))
    seed = {"phone": lambda: f"+49 30 {number(3)} {number(4)}", "email": lambda: f"n{number(5)}@example.org", "ip": lambda: f"10.{rnd.randrange(256)}.{rnd.randrange(256)}.7"}
    unseen = {"phone": lambda: f"0{number(3)} {number(3)} {number(4)}", "email": lambda: f"n{number(5)}@localhost", "ip": lambda: f"10-{rnd.randrange(256)}-{rnd.randrange(256)}-8"}
    texts, want = [], set()
    for k in range(12):
        kind = ("phone", "email", "ip")[k % 3]
        for _ in range(rnd.randint(3, 9)):
            texts.append(f"contact{chr(97 + k)} via {seed[kind]()} today")
        for _ in range(rnd.randint(1, 20)):
            want.add(len(texts))
            texts.append(f"contact{chr(97 + k)} via {unseen[kind]()} today")
    for k in range(12):  # contexts of ordinary numbers, some with a few seeds among them
        for _ in range(rnd.randint(0, 3)):
            texts.append(f"item{chr(97 + k)} code {seed['phone']()} sold")
        for _ in range(rnd.randint(25, 40)):
            texts.append(f"item{chr(97 + k)} code {number(rnd.choice([6, 8, 10]))} sold")
    found = {r.doc_id for r in pii.detected(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() if len(r.spans) > len(r.base)}
    assert found == want


def test_pii_context_words_are_whole(spark):
    long = "https://example.org/" + "x" * 100
    seeds = [(i, f"see {long} at +1 (4{i:02d}) 555-24{i:02d} now") for i in range(4)]
    new = [(10, f"see {long}  at 555-123-4567 now"), (11, f"see {long}\nat\n555-123-4568 now"), (12, f"see {long.replace('org', 'com')} at 555-123-4569 now")]
    found = {r.doc_id: len(r.spans) for r in pii.detected(spark.createDataFrame(seeds + new, "doc_id long, text string")).collect()}
    assert found == {0: 1, 1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 12: 0}


def test_token_counts(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = Counter((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows)
    assert Counter(map(tuple, token_counts.counted(docs, path).collect())) == want
    assert token_counts.counted(empty, path).count() == 0


def test_license_windows_of_a_very_long_text():
    """A text of notices only: memory stays a small multiple of the text."""
    import tracemalloc

    own = license_scan.Notices(license_scan.NOTICES, {})
    words = license_scan.words_of(" ".join(t for _, t, _ in license_scan.NOTICES) * 60)
    assert sum(map(len, words)) > 250_000
    tracemalloc.start()
    found = own.best(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(found) == {label for label, _, _ in license_scan.NOTICES} and peak < 60 << 20


def test_license_scan(docs, rows, empty):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))

    want = []
    for doc_id, text, *_ in rows:
        w = words(text or "")
        at = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        shares = {}
        for line in (text or "").split("\n"):
            own = set(words(line))
            met = [(label, frozenset(words(t)) & own, len(set(words(t)) & own) / len(set(words(t)))) for label, t in license_scan.TEMPLATES
                   if 100 * len(set(words(t)) & own) >= license_scan.THRESHOLD * len(set(words(t)))]
            for label, shared, share in met:
                if not any(shared < other for _, other, _ in met):
                    shares[label] = max(share, shares.get(label, 0))
        base = {label for _, label in at}
        starts = [i for i, _ in at]
        want.append((doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                     ",".join(sorted(base | shares.keys())), 1.0 if base else max(shares.values(), default=0.0)))
    assert Counter(map(tuple, license_scan.scanned(docs).collect())) == Counter(want)
    assert license_scan.scanned(empty).count() == 0


def test_license_notices_wrapped_and_edited(spark):
    notice = {label: text for label, text, _ in license_scan.NOTICES}  # the whole notice where there is one
    wrap = lambda text, n: "\n".join(" ".join(text.split()[i:i + n]) for i in range(0, len(text.split()), n))
    cases = [
        (wrap(license_scan.TEMPLATES[1][1], 7), "mit"), (wrap(license_scan.TEMPLATES[12][1], 5), "bsd"), (wrap(license_scan.TEMPLATES[14][1], 9), "mpl"),
        ("Licensed under the GNU Lesser General\nPublic License, version 3.", "gpl,lgpl"), ("Licensed under CC BY-NC 3.0.", "cc-by-nc"),
        ("Licensed under CC BY\n4.0. Licensed under CC BY-NC\n4.0.", "cc-by,cc-by-nc"), ("a All rights\nreserved. b", "reserved"),
        *((f"x y {wrap(notice[k], 9)} z", k) for k in ("mit", "bsd", "mpl", "unlicense")),
        (wrap(notice["mit"].replace("sublicense", "sublicense, rent").replace("holders", "owners").replace("Permission is hereby", "Permission is"), 11), "mit"),
        (wrap(notice["bsd"].replace("must retain", "should keep"), 8), "bsd"), (wrap(notice["lgpl"], 10), "gpl,lgpl"),
        # Another licence with most of the words, and words that stand too far apart.
        ("Permission is hereby granted, free of charge, to any person or organization obtaining\na copy of the software and accompanying documentation covered by this license", ""),
        ("all " + "word " * 20 + "rights\n" + "word " * 20 + "reserved", ""), ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ]
    got = {r.doc_id: r for r in license_scan.scanned(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(len(cases))] == [labels for _, labels in cases]
    assert got[4].score == 6 / 7


def test_license_windows_against_brute_force():
    rnd, notices = __import__("random").Random(7), license_scan.Notices(license_scan.NOTICES, {})
    texts = [license_scan.words_of(t) for _, t, _ in license_scan.NOTICES]
    for _ in range(120):
        words = []
        for _ in range(3):
            part = list(rnd.choice(texts))
            for _ in range(rnd.randint(0, max(1, len(part) // 4))):
                at = rnd.randrange(len(part))
                part[at:at + 1] = rnd.choice([[], ["x"], [part[at], "y"]])
                part = part or ["x"]
            words += part + ["z"] * rnd.randint(0, 6)
        met = []
        for k, (label, text, keys) in enumerate(license_scan.NOTICES):
            own, length = set(license_scan.words_of(text)), license_scan.window_words(text)
            for i in range(len(words)):
                at = [j for j in range(i, min(i + length, len(words))) if words[j] in own]
                shared = {words[j] for j in at}
                if words[i] in own and set(keys.split()) <= shared and 100 * len(shared) >= license_scan.NOTICE_THRESHOLD * len(own):
                    met.append((k, label, i, at[-1] + 1, shared, len(shared) / len(own)))
        want = {}
        for k, label, a, b, shared, share in met:
            if not any(j != k and c <= a and b <= d and shared < other for j, _, c, d, other, _ in met):
                want[label] = max(share, want.get(label, 0))
        assert notices.best(words) == want


PAGE = (
    '<html><head><title>No</title><style>p{}</style></head><body><nav><a href="/a">Home</a></nav><div class="cookie-notice">We use cookies on this site</div>'
    '<article><h1>Title &amp; more</h1><p><b>Short.<br><p>A  long\n paragraph&nbsp;with <a href="x">a link</a><script>if (a < b) {"</p>"}</script>'
    '<section class="comments"><p>First reader says hello to everyone here</p></section><p>Last</article><footer>&copy; us</footer><!-- open'
)


@pytest.mark.parametrize("page, text", [
    (PAGE, "Title & more\nShort.\nA long paragraph with a link\nLast"), ("", ""), ("<p>", ""), ("<nav><a>x</a></nav>", ""),
    ("word " * 40, ("word " * 40).strip()), ('<main><div>one</div><aside>two</aside><form>three <input></form></main>', "one"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


_LONG = ["word " * 60, "text " * 70, "body " * 80, "last " * 50]


@pytest.mark.parametrize("page, text", [
    # The body stands beside an article that is a heading or a teaser.
    ("<article><h1>A title</h1></article>" + "".join(f"<div>{t}</div>" for t in _LONG), "\n".join(["A title", *map(str.strip, _LONG)])),
    ("<article><a href='/x'>Read this other story too</a></article><div><a href=a>One</a></div><div><a href=b>Two</a></div>"
     + "".join(f"<div>{t}</div>" for t in _LONG), "\n".join(map(str.strip, _LONG))),
    # Link lists in unnamed containers of an article, and a lone block beside it.
    (f"<article><p>{_LONG[0]}<div><div><a href=a>One more</a></div><div><a href=b>Another one</a></div></div><p>{_LONG[1]}</article><div>{_LONG[3]}</div>",
     f"{_LONG[0].strip()}\n{_LONG[1].strip()}"),
    # Furniture named on elements whose end may be left out.
    (f"<article><p>{_LONG[0]}<ul><li>one item<li class='comment'>Nice work<li>two items</ul><p class=ad>Buy this</p>after it</article>",
     f"{_LONG[0].strip()}\none item\ntwo items\nafter it"),
    (f"<main><table><tr><td class='sidebar'>Links here<td>{_LONG[0]}<tr class=toolbar><td>Edit<tr><td>cell</table><dl><dt>term<dd class=share>Share it<dt>next</dl></main>",
     f"{_LONG[0].strip()}\ncell\nterm\nnext"),
    (f"<main><script>x</script><p class=byline>By me<div>{_LONG[0]}</div><ul><li class=tags>a<ul><li>b</ul>c</li><li>d</ul>e</main>", f"{_LONG[0].strip()}\nd\ne"),
])
def test_main_text_by_counts_and_names(page, text):
    assert html_text.main_text(page) == text


ARTICLE = " ".join(f"Sentence {k} of the article tells what happened on that day and why it did." for k in range(12))


@pytest.mark.parametrize("name", ["no-sidebar", "overflow-hidden", "with-comments", "has-share", "tags-travel", "two-col sidebar-left", "post comments-open", "entry search-result-17", "promo-free layout"])
def test_html_names_of_wrappers(name):
    menu = "<div class='main-nav'><a href=a>Home</a> <a href=b>About</a></div>"
    for tag in ("div", "article", "section", "body"):
        page = f"<html>{menu}<{tag} class=\"{name}\"><h1>Title</h1><p>{ARTICLE}</p><div class='social-share'>Share this</div></{tag}><div id=site-footer>Contact us</div></html>"
        assert html_text.main_text(page).split("\n")[-1] == ARTICLE, (name, tag)


@pytest.mark.parametrize("name", ["comments", "comment-list", "site-header", "cookie-banner", "sidebar_widget", "newsletter box", "ad-slot", "related-posts sidebar"])
def test_html_names_of_furniture(name):
    other = "Other words that a reader wrote below the text about something else entirely. " * 3
    page = f"<body><div><p>{ARTICLE}</p></div><div class='{name}'><p>{other}</p></div></body>"
    assert html_text.main_text(page) == ARTICLE


def test_html_open_controls():
    for control in ("<button>Share", "<button class=x>Share</button><button>Save", "<select><option>One<option>Two</select>", "<select><option>One<option>Two", "<option>One", "<button>A</button>"):
        assert html_text.main_text(f"<div>{control}<p>{ARTICLE}</p><p>{ARTICLE}</p></div>").split("\n")[-2:] == [ARTICLE, ARTICLE], control


class _Blocks(HTMLParser):
    """Blocks of well-formed pages by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.skip = [], "", 0

    def flush(self):
        if self.text.split():
            self.out.append(" ".join(self.text.split()))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "button", "select"):
            self.skip += 1
            self.text += " " * (tag in ("button", "select"))
        elif tag in ("br", "img"):
            self.text += " "
        elif tag not in html_text.INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag in ("script", "style", "button", "select"):
            self.skip -= 1
        elif tag not in html_text.INLINE:
            self.flush()

    def handle_data(self, data):
        if not self.skip:
            self.text += data


def test_html_blocks_equal_a_parser():
    rnd = random.Random(8)
    word = lambda: rnd.choice(["a", "bc", "d&amp;e", "&eacute;t&#233;", "x&nbsp;y", "&lt;b&gt;", "1 &gt; 0"])

    def node(depth: int) -> str:
        kind = rnd.random()
        if depth == 0 or kind < 0.35:
            return rnd.choice([" ", "\n", ""]) + " ".join(word() for _ in range(rnd.randint(1, 6)))
        if kind < 0.55:
            return f"<{(t := rnd.choice(['b', 'em', 'a href=x', 'span']))}>{node(0)}</{t.split()[0]}>"
        if kind < 0.62:
            return rnd.choice(["<br>", "<!-- no <p> -->", "<script>if (a < b) { x = '<p>' }</script>", "<button type=button>Go <b>on</b></button>", "<hr/>", "<img alt='<p>' src=a>"])
        inner = "".join(node(depth - 1) for _ in range(rnd.randint(1, 4)))
        return f"<{(t := rnd.choice(['div', 'section', 'blockquote', 'pre', 'h2']))} class='c d'>{inner}</{t}>"

    for _ in range(400):
        page = "<html><body>" + "".join(node(3) for _ in range(5)) + "</body></html>"
        parser = _Blocks()
        parser.feed(page)
        parser.close()
        parser.flush()
        assert [b.text for b in html_text.flat_blocks(page)] == parser.out, page


def test_html_recall_and_precision():
    """Words of pages of several kinds: recall and precision of main text, each page by itself."""
    rnd = random.Random(9)
    para = lambda n: " ".join(f"word{rnd.randrange(900)}" for _ in range(n)) + "."
    links = lambda n: " ".join(f"<a href=/{k}>Link {k}</a>" for k in range(n))
    low_recall = low_precision = 0
    for k in range(120):
        paragraphs = [para(rnd.randint(25, 90)) for _ in range(rnd.randint(3, 9))]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        shell = ("<article>{}</article>", "<main>{}</main>", "<div class='content with-sidebar'>{}</div>", "<td>{}</td>", "<section class='post no-comments'>{}</section>", "<div>{}</div>")[k % 6]
        if "td" in shell:
            shell = f"<table><tr>{shell}<td class=sidebar>{links(9)}</td></tr></table>"
        before = rnd.choice([f"<nav>{links(6)}</nav>", f"<div id=header><ul><li>{links(1)}<li>{links(1)}</ul></div>", f"<div class='top-bar'>{links(8)}</div>"])
        after = rnd.choice(["", f"<div class='comment-list'><p>{para(60)}</p><p>{para(40)}</p></div>", f"<aside><p>{para(30)}</p></aside>"]) + f"<footer>{para(12)} {links(4)}</footer>"
        got = Counter(html_text.main_text(f"<html><body>{before}{shell.format(body)}{after}</body></html>").split())
        want = Counter(" ".join(paragraphs).split())
        shared = (got & want).total()
        low_recall += shared < 0.99 * want.total()
        low_precision += shared < 0.95 * got.total()
    assert (low_recall, low_precision) == (0, 0)


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_text.extracted(pages).collect()
    assert len(got) == 3 and {r.n_chars for r in got} == {0, len(html_text.main_text(PAGE))}
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_quality_classifier(spark, docs, empty):
    good = [(i, f"The quiet house number {i} stood by a river, and it was old.") for i in range(120)]
    bad = [(200 + i, f"The%%% quiet&&& house### number*** {i} stood$$$ by%%% a### river.") for i in range(60)]
    own = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200), None) for i, _ in good + bad], "doc_id long, quality int, toxic int")
    got = quality_classifier.scored(own, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 180 and 20 < len(held) < 80
    assert sum((r.score >= 0.7) == (r.doc_id < 200) for r in held) >= 0.95 * len(held)
    odd = quality_classifier.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in odd} == {0.5} and len(odd) == docs.count()
    assert quality_classifier.scored(empty, labels).count() == 0


def test_follow_the_leader_prefers_what_separates():
    w, bias = quality_classifier.train(["good fine", "bad awful"] * 20, __import__("numpy").array([1, 0] * 20))
    features = quality_classifier.Features()
    score = lambda t: w[features.of([t])[0]].sum()
    assert score("good") > 0 > score("bad")


def test_bounds_of_sample(spark):
    assert quality_classifier.held_out(F.lit(None).cast("long")) is not None and quality_classifier.SAMPLE <= 10_000
