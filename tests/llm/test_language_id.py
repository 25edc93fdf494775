from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrate.llm import language_id as L
from tests.llm.fixtures import ODD_TEXTS, documents

WORDS = {"en": "the of and with that this was not for you have from they which one".split(),
         "de": "der die und nicht mit das ein auch sich für über schön werden können".split(),
         "fr": "le la les des une est pour dans qui avec être même très français où".split()}


def text_of(rng, lang, words):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, lang, 60), lang) for i in range(90) for lang in WORDS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return L.fit(labelled)


def test_held_out_accuracy(spark, model):
    rng = random.Random(2)
    rows = [(i, text_of(rng, lang, rng.choice([4, 12, 80])), lang, f"h{i % 5}") for i in range(60) for lang in WORDS]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string").withColumn("said", F.lit(None))
    found = L.identify(frame, model, "text", "said", ["host"])
    assert found.where("language = lang").count() >= 0.97 * len(rows)


def test_fusion_matches_brute_force(spark, model):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        lang = rng.choice(list(WORDS))
        said = lang if rng.random() < 0.7 else rng.choice([*WORDS, None, "XX"])
        rows.append((i, text_of(rng, lang, rng.choice([1, 1, 2, 30])), said, rng.choice(["com", "de", None]), f"{lang if i % 3 else 'x'}.com"))
    rows += [(200 + i, text, "en", "com", "h.com") for i, text in enumerate(ODD_TEXTS)]
    frame = spark.createDataFrame(rows, "page_id long, text string, declared string, suffix string, host string").selectExpr(
        "*", "1 as language", "2 as probability", "3 as _logs")
    found = {r.page_id: r for r in L.identify(frame, model, "text", "declared", ["suffix", "host"]).collect()}
    assert len(found) == len(rows)

    names = [*model.languages, L.UNKNOWN]
    logs = {r[0]: model.evidence(r[1]) for r in rows}
    def softmax(x):
        e = np.exp(np.array(x) - max(x))
        return e / e.sum()
    keyed = [(r[0], (r[2] or "").lower(), r[3] or "", r[4] or "") for r in rows]
    soft = {i: softmax(x) for i, x in logs.items() if x is not None}
    def sums(match):
        return sum((soft[k[0]] for k in keyed if k[0] in soft and match(k)), np.zeros(len(names)))
    total = sums(lambda k: True)
    prior = (total + 1 / len(names)) / (total.sum() + 1)
    prior = np.append(prior[:-1] / prior[:-1].sum() * (1 - L.UNKNOWN_PRIOR), L.UNKNOWN_PRIOR)
    lean = lambda own, above: (own + L.SMOOTHING * above) / (own.sum() + L.SMOOTHING)
    for i, said, suffix, host in keyed:
        if logs[i] is None:
            assert (found[i].language, found[i].probability) == (L.UNKNOWN, 1.0)
            continue
        by_suffix = lean(sums(lambda k: k[2] == suffix), prior)
        by_host = lean(sums(lambda k: k[2:] == (suffix, host)), by_suffix)
        own = sums(lambda k: k[1] == said)
        declared = (own + L.SMOOTHING * own.sum() / total.sum()) / (total + L.SMOOTHING)
        post = softmax(np.array(logs[i]) + np.log(by_host) + np.log(declared))
        assert found[i].language == names[int(post.argmax())]
        assert found[i].probability == pytest.approx(post.max(), rel=1e-6)
        assert found[i].text_language == names[int(np.argmax(logs[i]))]


def test_declaration_and_host_decide_short_texts(spark, model):
    rows = [(i, " ".join(WORDS["de"]), "de", "a.de") for i in range(40)] + [(i + 50, " ".join(WORDS["fr"]), "fr", "b.fr") for i in range(40)]
    rows += [(100, "ok", "de", "a.de"), (101, "ok", "fr", "b.fr"), (102, "ok", None, "b.fr")]
    frame = spark.createDataFrame(rows, "page_id long, text string, declared string, host string")
    found = {r.page_id: r.language for r in L.identify(frame, model, "text", "declared", ["host"]).collect()}
    assert (found[100], found[101], found[102]) == ("de", "fr", "fr")


def test_page_parts(spark):
    html = ('<!DOCTYPE html><HTML class="x" lang=\'DE-at\'><head><style>p{}</style><script>var t="</p>";</script></head>'
            '<body><!-- no <b> --><p>Gr&uuml;&szlig; <b>dich</b></body></html>')
    pages = spark.createDataFrame([(1, "https://U@Sub.Example.CO.de:80/en?x", html), (2, None, None), (3, "no address", "plain"), (4, "http://localhost", "")],
                                  "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as host")
    found = {r.page_id: r for r in L.page_parts(pages).collect()}
    assert (found[1].declared, found[1].host, found[1].domain, found[1].suffix) == ("de", "sub.example.co.de", "co.de", "de")
    assert found[1].text.split() == ["Grüß", "dich"]
    assert (found[2].text, found[2].declared, found[2].host) == ("", None, "")
    assert (found[3].text, found[3].suffix) == ("plain", "") and found[4].domain == "localhost"


def test_pages_as_parts_then_identify(spark, model):
    rng = random.Random(4)
    rows = [(i, f"https://h{i % 4}.example.{'de' if i % 2 else 'org'}/x",
             f'<html lang="{rng.choice(["de", "fr", "xx"])}"><p>{text_of(rng, rng.choice(list(WORDS)), 5)}</p>') for i in range(50)]
    pages = spark.createDataFrame([*rows, (90, None, None)], "page_id long, url string, html string").selectExpr("*", "1 as host")
    parts = L.page_parts(pages).drop("html")
    want = L.identify(parts, model, "text", "declared", ["suffix", "domain", "host"])
    found = L.identify_pages(pages, model)
    key = lambda r: (r.page_id, r.host, r.domain, r.suffix, r.declared, r.language, round(r.probability, 9), r.text_language)
    assert sorted(map(key, found.collect())) == sorted(map(key, want.collect()))


def test_accepted_rows(spark, labelled):
    odd = documents(spark, ODD_TEXTS)
    both = labelled.withColumn("source", F.lit("s")).unionByName(odd.select("doc_id", "text", "lang", "source")).selectExpr(
        "*", "1 as language", "2 as _text", "3 as declared")
    kept = L.accepted(both)
    assert kept.columns == both.columns
    texts = [r.text for r in kept.collect()]
    assert len([t for t in texts if len(t or "") > 100]) == labelled.count()
    assert not {None, "", " ", "!!! *** ###", "123 4567  89"} & set(texts)


def test_no_rows_and_no_labels(spark):
    none = documents(spark, []).limit(0)
    assert L.accepted(none).count() == 0
    blind = L.fit(none)
    assert blind.languages == ()
    found = L.identify(documents(spark, ["some words"]), blind, "text", "lang", ["source"]).collect()
    assert [r.language for r in found] == [L.UNKNOWN]


def test_the_fit_is_bounded_and_repeats(labelled):
    first, second = L.fit(labelled, rows=50), L.fit(labelled.repartition(5), rows=50)
    assert first.languages == second.languages and np.array_equal(first.logs, second.logs)


def test_copies_count_once_and_every_label_is_fitted(spark, labelled):
    most = labelled.where("lang <> 'fr'").unionByName(labelled.where("lang = 'fr'").limit(1))
    low = most.where("lang = 'en'").orderBy(F.xxhash64("lang", "text")).limit(1)
    copies = most.unionByName(low.withColumn("doc_id", F.explode(F.sequence(F.lit(0), F.lit(999)))))
    first, second = L.fit(most, rows=30), L.fit(copies, rows=30)
    assert second.languages == ("de", "en", "fr")
    assert first.languages == second.languages and np.array_equal(first.logs, second.logs)


HOSTILE = ("<html ", "<script ", "<!-- ", "<style>", "</script", "<a b='", "<script></script  ", '<html a="', "<html" + " x", "< ")


@pytest.mark.parametrize("pattern", HOSTILE)
def test_markup_takes_time_in_proportion_to_its_length(pattern):
    page = pattern * (1_000_000 // len(pattern))
    started = time.perf_counter()
    L.visible(page)
    L.visible("<html " + page + ">")
    assert time.perf_counter() - started < 5


def test_what_is_visible():
    assert L.visible("a<b>c</b><!-- <p>x</p> -->d<script>1 < 2</SCRIPT >e<style>p{}</style>f &amp; g") == ("a c  d e f & g", None)
    assert L.visible("a <!-- never closed <b>c") == ("a  c", None)
    assert L.visible("1 < 2 and <script>x") == ("1  x", None) and L.visible("1 < 2") == ("1 < 2", None)
    assert L.visible('<!-- <html lang="de"> --><html data-lang="de" lang="fr">x') == ("  x", "fr")
    assert L.visible("<html title='a lang=de' LANG = EN-us>")[1] == "en"
    assert L.visible("<html><html lang=de>")[1] is None and L.visible("<htmlx lang=de>")[1] is None
