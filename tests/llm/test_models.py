"""Trained operators: exact inference against enumeration, exact parts against brute force, held-out accuracy."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglark.llm import language, main_text, page_tree, pii, pii_rules, pii_tagger, quality_trees, rule_ensemble, statistics, trees
from tests.llm.conftest import DOCS

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# --- language


def test_language_of_held_out_documents(docs):
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(odd, empty, odd_rows):
    got = language.languages(odd).collect()
    assert len(got) == len(odd_rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} >= {3, 4, 6, 9}
    assert language.languages(empty).count() == 0
    assert language.keep_known(odd).columns == odd.columns


def test_windows_hold_every_byte():
    for text in ("", "a", "ab" * 64, "é" * 100):
        rows = language.windows(text)
        assert rows[:, : language.WINDOW].tobytes().rstrip(b"\0") == text.encode()


# --- statistics, rules, trees


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_counts_equal_plain_python(docs, odd_rows):
    rng = random.Random(3)
    texts = [r.text for r in docs.limit(150).collect()] + [r[1] for r in odd_rows]
    texts += ["".join(rng.choice("aA é\n\t#\xa0") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    for text in texts:
        assert statistics.measure(text)[0] == plain_counts(text)


def test_rule_ensemble(spark, docs, labels, odd, empty, no_labels):
    got = {r.doc_id: r for r in rule_ensemble.quality(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held)
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert rule_ensemble.quality(odd, labels).count() == 12
    assert rule_ensemble.quality(empty, labels).count() == 0
    assert {r.score for r in rule_ensemble.quality(odd, no_labels).collect()} == {0.5}


def test_rules_as_columns_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.random((200, len(statistics.FEATURES)))
    y = (x[:, 0] + 0.3 * x[:, 2] > 0.6).astype(float)
    bias, rules = rule_ensemble.fit(x, y)
    assert 0 < len(rules) < 200
    total = bias + sum(w * rule_ensemble.holds(r, x) for w, r in rules)
    df = spark.createDataFrame([tuple(map(float, row)) for row in x], list(statistics.FEATURES))
    got = [r.s for r in df.select(rule_ensemble.compiled(bias, rules).alias("s")).collect()]
    assert np.allclose(got, trees.sigmoid(total))


def test_trees_respect_the_signs():
    rng = np.random.default_rng(2)
    x = rng.random((800, len(statistics.FEATURES)))
    y = (rng.random(800) < 0.5 + 0.3 * np.sin(9 * x[:, 2])).astype(float)
    forest = quality_trees.fit(x, y)
    falling = statistics.FEATURES.index("s_symbols")
    rows = np.repeat(x[:50], 40, axis=0)
    rows[:, falling] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(forest.score(rows).reshape(50, 40), axis=1) <= 1e-12).all()
    base, single = trees.boost(x, y, 5, 3)
    flat = quality_trees.Forest(base, single).score(x)
    assert np.allclose(flat, trees.sigmoid(base + sum(t.predict(x) for t in single)))


def test_quality_trees(docs, labels, odd, empty, no_labels):
    got = {r.doc_id: r for r in quality_trees.quality_rules(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i].score >= 0.3) == truth[i] for i in held) / len(held) > 0.9
    for r in got.values():
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.score >= 0.3)
    rows = quality_trees.quality_rules(odd, no_labels).collect()
    assert len(rows) == 12 and not any(r.kept for r in rows if r.n_words < 10)
    assert quality_trees.quality_rules(empty, labels).count() == 0


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if pii_rules.is_card(m[0])]
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def test_base_spans_equal_the_patterns(docs):
    rng = random.Random(1)
    texts = ["".join(rng.choice("a@.-+1 23(9)%4_\né") for _ in range(rng.randint(0, 40))) for _ in range(20_000)]
    texts += [r.text for r in docs.limit(300).collect()]
    texts += ["4111 1111 1111 1111 and 4111-1111-1111-1112", "a@b.c@d.e", "256.1.1.1 1.2.3.4.5 0001.2.3.4", "1" * 5000 + ".2.3.4"]
    for text in texts:
        if len(text) < 5000:
            assert pii_rules.base_spans(text) == plain_spans(text)
    assert pii_rules.base_spans(texts[-1]) == []


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    tagger = pii_tagger.Tagger()
    tagger.step, tagger.first = rng.normal(size=(9, 9)), rng.normal(size=9)
    e = rng.normal(size=(3, 1, 9))
    p, pairs, first = tagger.marginals(e)
    want, total = np.zeros((3, 9)), 0.0
    for tags in itertools.product(range(9), repeat=3):
        w = np.exp(tagger.first[tags[0]] + sum(e[i, 0, t] for i, t in enumerate(tags)) + sum(tagger.step[a, b] for a, b in zip(tags, tags[1:])))
        total += w
        for i, t in enumerate(tags):
            want[i, t] += w
    assert np.allclose(p[:, 0], want / total) and np.isclose(pairs.sum(), 2)


def test_overlapping_windows_become_one_list():
    found = [(10, 40, 0, True), (32, 60, 0, False), (70, 80, 3, False), (70, 80, 3, False), (0, 5, 1, True), (100, 110, 2, True)]
    assert pii_tagger.reconciled(found, 200) == [(10, 60, 0), (0, 5, 1), (70, 80, 3)]


def test_personal_data(docs, odd, empty):
    got = pii.personal_data(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        base = plain_spans(r.text)
        assert r.base_sha256 == pii_rules.sha256(pii_rules.joined(base))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for *_, k in base) for i in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert {f"{pii_rules.KINDS[k]}:{s}:{e}" for s, e, k in base} <= set(spans)
        assert len(spans) == len(base) + r.n_added
    assert all(r.spans == "" for r in pii.personal_data(odd).collect())
    assert pii.personal_data(empty).count() == 0


def test_tagger_learns_spans_without_a_pattern(docs):
    tagger = pii.train(docs, "doc_id", "text")
    text = "Ther onen for it, (555) 555-3824 " + "of thing and " * 3
    assert len(tagger.decode(pii_tagger.anchored_windows(text)[1])) > 0


def test_spelled_out_addresses_without_a_digit(spark):
    """Learned from plain addresses, found in prose that holds neither a digit nor an at sign."""
    rng = random.Random(5)
    words = "the of and there looked to in is he for on with they at be from had by word but".split()
    names = "john mary peter.miller anna lucas.gray nora olive.stone frank".split()
    hosts = "example mailhost post.example web north.example inbox".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [f"{prose(rng.randint(3, 40))} {rng.choice(names)}@{rng.choice(hosts)}.{rng.choice(('com', 'org'))} {prose(30)}" for _ in range(1200)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    tagger = pii.train(docs, "doc_id", "text")
    spelled, found = [], 0
    for _ in range(60):
        lead, address = prose(rng.randint(3, 40)), f"{rng.choice(names)} at {rng.choice(hosts)} dot com"
        spelled.append((f"{lead} {address} {prose(30)}", (len(lead) + 1, len(lead) + 1 + len(address), 0)))
    for (text, span), (base, added) in zip(spelled, pii.find_all([t for t, _ in spelled], tagger), strict=True):
        assert base == [] and not re.search("[0-9@]", text)
        found += span in added
    assert found >= 10


def test_spans_are_those_of_all_windows(docs, monkeypatch):
    """Also where spans are longer than a window; an untrained tagger finds odd ones all over."""
    texts = [r.text for r in docs.limit(40).collect()] + ["x" * 200 + " at " + "y" * 200 + " dot com", "a at at b dot c " * 30]
    for seed in range(4):
        tagger = pii_tagger.Tagger(seed)
        tagger.bias[0] = 0.5
        got = pii.find_all(texts, tagger)
        with monkeypatch.context() as m:
            m.setattr(pii, "anchored_windows", lambda t: (np.arange(0, len(t), pii_tagger.STEP), None))
            assert got == pii.find_all(texts, tagger)


# --- pages


def test_sum_product_equals_enumeration():
    tree = page_tree.parse("<body><div class=nav><p>a b c</p>d</div><article><p>e f. <b>g</b></p></article></body>")
    forest, model = main_text.Forest([tree]), main_text.Model()
    rng = np.random.default_rng(0)
    model.node, model.edge = rng.normal(size=model.node.shape), rng.normal(size=model.edge.shape)
    n = len(tree.parent)
    want, total = np.zeros(n), 0.0
    for y in itertools.product((0, 1), repeat=n):
        score = sum(forest.x[i] @ model.node for i in range(n) if y[i])
        score += sum(model.edge[forest.kind[i], y[tree.parent[i]], y[i]] for i in range(1, n))
        total += np.exp(score)
        want += np.exp(score) * np.array(y)
    assert np.allclose(model.beliefs(forest)[0], want / total)


def test_main_text_of_composed_pages():
    model, rng = main_text.train([]), random.Random(99)
    pages = [main_text.composed(rng) for _ in range(60)]
    got = main_text.extract(model, [h for h, _ in pages])
    assert sum(g == t for g, (_, t) in zip(got, pages)) >= 57


def test_text_after_a_self_closed_svg_or_math():
    for tag in ('<svg class="icon"/>', "<math/>", "<SVG a='b' />"):
        for page in (f"<article><p>One two {tag}three.</p></article>", f"<body>{tag}<p>Four.</p><svg><text>x</text></svg><p>Five.</p></body>"):
            plain = page_tree.parse(page.replace(tag, ""))
            assert page_tree.parse(page).text == plain.text and any(plain.text)
    assert page_tree.parse("<p>a<svg><path/><text>x</text></svg>b</p>").text[-1] == "ab"
    assert page_tree.parse("<p>a<script/>x</script>b</p>").text[-1] == "ab"
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='t'>x=2</annotation></semantics></math>"
    assert page_tree.parse(f"<p>So {formula} holds.</p>").text[-1] == "So x=2 holds."


def test_a_rights_notice_late_in_a_run_of_text_is_a_feature():
    late, none = (page_tree.parse(f"<p>{'word ' * 200}{end}.</p>") for end in ("All rights reserved", "All is well"))
    assert page_tree.features(late)[-1][6] == 1 and page_tree.features(none)[-1][6] == 0


def test_broken_pages(spark, empty):
    pages = [None, "", "text", "<p>a<p>b", "<div><script>x</script>", "<" * 500, "<article><p>One &amp; two<b> three</b>four.<br>Five six<table><tr><td>c", '<article><p title="a>b">Seven eight nine.</article>']
    df = spark.createDataFrame([(i, None, p, "x") for i, p in enumerate(pages)] * 2, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in main_text.main_text(df).collect()}
    assert len(got) == len(pages)
    assert got[0].text == got[1].text == got[4].text == ""
    assert got[6].text.startswith("One & two threefour. Five six") and got[7].text == "Seven eight nine."
    assert all(r.n_chars == len(r.text) for r in got.values())
