"""Operators on pages and labels, and the pipeline."""

import collections
import html
import itertools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from nestweave.llm import html_text, toxicity
from nestweave.llm import sentencepiece_codec as codec
from nestweave.llm.components import components
from nestweave.llm.language import identify_languages
from nestweave.llm.urls import judge_urls

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    names = "documents pages labels benchmark".split()
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in names}


def test_url_rules(spark, tables):
    odd = [(-1, None), (-2, "nothing"), (-3, "HTTP://A.ORG?x"), (-4, "http://A.Example.ORG/es/1"), (-5, "x://y/://b.com/de/?z")]
    odd += [(-6, "http://notorg/x"), (-7, "https://www.example.org/en/12#a"), (-8, "http://b.com/de/?z")]
    frame = spark.createDataFrame(odd, "page_id long, url string").withColumnRenamed("url", "url")
    pages = tables["pages"].select("page_id", "url").unionByName(frame).selectExpr("*", "'mine' as host")
    rows = {r.page_id: r for r in judge_urls(pages).collect()}
    assert len(rows) == pages.count()
    assert (rows[-1].host, rows[-1].path, rows[-2].host) == ("", "", "")
    assert (rows[-3].host, rows[-3].path, rows[-3].rule) == ("a.org", "", None)
    assert (rows[-4].host, rows[-4].rule, rows[-4].verdict) == ("a.example.org", "example.org/es/", "block")
    assert (rows[-5].host, rows[-5].path) == ("y", "/://b.com/de/")
    assert rows[-6].rule is None
    assert rows[-7].rule == "example.org/en/1"
    assert (rows[-8].rule, rows[-8].verdict) == ("com/de/", "block")
    assert {r.verdict for r in rows.values()} <= {"allow", "block"}


def test_url_rules_without_labels(spark):
    frame = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in judge_urls(frame).collect()} == {"allow"}
    assert judge_urls(frame.limit(0)).count() == 0


def cut_value(scores, joined, kept):
    cost = sum(max(0.0, s) for s, k in zip(scores, kept, strict=True) if not k)
    cost += sum(max(0.0, -s) for s, k in zip(scores, kept, strict=True) if k)
    return cost + sum(w for a, b, w in joined if kept[a] != kept[b])


def test_minimum_cut_is_the_least():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 8))
        scores = rng.normal(0, 2, n).round(1).tolist()
        joined = [(a, b, float(rng.integers(1, 4))) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        least = min(cut_value(scores, joined, kept) for kept in itertools.product([True, False], repeat=n))
        assert cut_value(scores, joined, html_text.content_side(scores, joined)) == pytest.approx(least)


def test_main_text(tables):
    rows = html_text.extract_text(tables["pages"], keep=("page_id", "url", "html")).collect()
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = re.sub(r"<(?:h1|p|br|/h1|/p)>", " ", re.sub(r"</?b>", "", article))
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text)


def test_main_text_of_other_pages(spark):
    page = """<html><head><title>T</title></head><body><div id=menu><a href=1>Home</a> <a>About</a></div>
    <div class="cookie-notice">We use cookies</div><header>Site</header><div><h1>Big&nbsp;title</h1>
    <p>First paragraph, with a <a href="x>y">link</a> and <b>bold</b>text. It goes on for a while.
    <p>Second&mdash;unclosed, but a fine long paragraph.</div><div class="comments"><p>Nice article, thanks!</p></div>
    <form><label>Name</label></form><!-- c --><footer>&copy; 2020</footer></body></html>"""
    odd = [page, None, "", "plain text only, without any markup at all.", "<p>", "a<!-- x", "<script>x", "<a" * 50]
    frame = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").selectExpr("*", "null as url")
    frame = frame.selectExpr("page_id", "html", "cast(url as string) url")
    found = [r.text for r in html_text.extract_text(frame).orderBy("page_id").collect()]
    assert found[0] == (
        "Big title First paragraph, with a link and boldtext. It goes on for a while. "
        "Second—unclosed, but a fine long paragraph."
    )
    assert found[1:3] == ["", ""]
    assert found[3] == odd[3]


def test_skipped_elements_end(spark):
    """Only raw text reaches to the end of a page: not an open head, a closed drawing or an open list of choices."""
    told = "<p>The first long paragraph of the text, with some words, and more of them.</p><p>And the second one, as long as that.</p>"
    bodies = [
        f"<head><title>T</title><meta charset=x><script>a()</script><body>{told}",
        f"<html><head><title>T</title>{told}",
        f"<head><title>T<body>{told}",
        f'<body><svg width="1"/><math />{told}',
        f"<body><svg><title>no</title><text>no</text></svg><select><option>no</select>{told}",
        f"<body><svg><path>{told}",
        f"<body><div><button><div>no</div></button><select><option>no</div>{told}",
        f"<body><video src=x>{told}",
        f"<body>{told}<textarea>no",
    ]
    frame = spark.createDataFrame([(k, "", b) for k, b in enumerate(bodies)], "page_id long, url string, html string")
    found = [r.text for r in html_text.extract_text(frame).orderBy("page_id").collect()]
    expected = "The first long paragraph of the text, with some words, and more of them. And the second one, as long as that."
    assert found == [expected] * len(bodies)


def test_regions_can_be_outweighed(spark):
    """Markup that names a region wrongly does not decide, and a wrapper of the whole page names none."""
    first = "The first paragraph goes on for quite a while, with several words, marks, and nothing else in it. " * 4
    second = "The second one, which is as long as the first, tells the rest of the story; it ends here. " * 4
    told = f"<p>{first}</p><p>{second}</p>"
    menu = "<ul class=menu><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul>"
    links = "".join(f"<li><a href={k}>Link {k}</a></li>" for k in range(8))
    bodies = [
        f"<form id=aspnetForm>{menu}<div>{told}</div><div class=footer>Imprint</div></form>",
        f"<div class='content has-sidebar'>{menu}{told}</div>",
        f"{menu}<div class='share-wrapper'>{told}</div><footer>Imprint</footer>",
        f"{menu}<div class='sidebar'><article>{told}</article></div><footer>Imprint</footer>",
        f"{menu}<article><p>{first}</p><ul>{links}</ul><p>{second}</p></article>",
        f"{menu}<article>{told}</article><div class=comments><p>{first.upper()}</p></div>",
        f"{menu}<article><p>{first}</p><p class=alert>{second * 2}</p><p>{first}</p></article>",
    ]
    frame = spark.createDataFrame([(k, "", f"<body>{b}</body>") for k, b in enumerate(bodies)], "page_id long, url string, html string")
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").unionByName(frame.withColumn("page_id", -1 - frame["page_id"]))
    found = [r.text for r in html_text.extract_text(pages).where("page_id < 0").orderBy("page_id", ascending=False).collect()]
    assert found[:-1] == [" ".join(f"{first} {second}".split())] * (len(bodies) - 1)
    assert found[-1] == " ".join(f"{first} {second * 2} {first}".split())


def test_languages(spark, tables):
    odd = [(-1, None, None), (-2, "http://a.de/x", "<p></p>"), (-3, "http://zz.example.com", '<html lang="fr"><body></body>')]
    pages = tables["pages"].unionByName(spark.createDataFrame(odd, "page_id long, url string, html string"))
    rows = {r.page_id: r for r in identify_languages(pages, tables["documents"]).collect()}
    assert len(rows) == pages.count()
    right = [r.lang == re.search(r"://[^/]*/(\w\w)/", r.url)[1] for r in rows.values() if r.page_id >= 0]
    assert sum(right) >= 0.97 * len(right)
    assert rows[-1].text_lang is None and rows[-1].lang is not None
    assert rows[-3].lang == "fr"
    assert all(0 < r.confidence <= 1 for r in rows.values())
    unknown = identify_languages(pages, tables["documents"].limit(0)).collect()
    assert {r.lang for r in unknown} == {None}


def test_toxicity(spark):
    mean = "idiot moron scum".split()
    rows = []
    for k in range(400):
        filler = [f"w{(k * 7 + j) % 97}" for j in range(40)]
        if k % 5 == 0:
            filler[::9] = [mean[(k + j) % 3] for j in range(5)]
        rows.append((k, " ".join(filler)))
    rows += [(1000, None), (1001, ""), (1002, "You, IDIOT! What a moron."), (None, "idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.where("doc_id < 400").selectExpr("doc_id", "if(doc_id % 5 = 0, 1, 0) toxic")
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(found) == len(rows)
    tested = [r for r in found.values() if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in tested) >= 0.95 * len(tested)
    assert found[1002].predicted == 1 and found[1002].evidence
    assert found[1000].predicted == found[1001].predicted == 0
    none = toxicity.score_toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}


def test_toxicity_of_small_samples_and_rare_insults(spark):
    """Few examples, and an insult that few of many have, are enough."""

    def scored(n, rare):
        insults = ["moron", *[f"insult{j}" for j in range(rare)]]
        rows, labels = [], []
        for k in range(n):
            filler = [f"w{(k * 7 + j * j) % 97}" for j in range(40)]
            if k % 4 == 0:
                filler[::10] = [insults[k // 4 % len(insults)]] * 4
            rows.append((k, " ".join(filler)))
            labels.append((k, int(k % 4 == 0)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        tested = [r for r in found if r.held_out]
        return [sum(r.predicted == (r.doc_id % 4 == 0) for r in tested if (r.doc_id % 4 == 0) == t) / sum((r.doc_id % 4 == 0) == t for r in tested) for t in (True, False)]

    for n, rare in ((60, 0), (1000, 40)):
        toxic, clean = scored(n, rare)
        assert toxic >= 0.8 and clean >= 0.9, (n, toxic, clean)


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    examples = []
    for k in range(500):
        terms = np.sort(rng.choice(30, int(rng.integers(1, 6)), replace=False))
        weights = rng.random(len(terms)).round(1) + 0.1
        examples.append(toxicity.Example(k, k % 2, terms, weights / np.sqrt((weights**2).sum())))
    index = toxicity.Index(examples, 30)
    dense = np.zeros((500, 30))
    for e in examples:
        dense[e.doc_id, e.terms] = e.weights
    for e in examples[:60]:
        found = index.nearest(e.terms, e.weights, 7)
        scores = dense[:, e.terms] @ e.weights
        expected = sorted((-s, k) for k, s in enumerate(scores.tolist()) if 0 < s < 1 - 1e-9)
        least = -expected[6][0] if len(expected) > 6 else 0.0
        expected = [(s, k) for s, k in expected if -s >= least - 1e-9]
        assert [s for s, _ in found] == pytest.approx([-s for s, _ in expected])
        assert {k for _, k in found} == {k for _, k in expected}


def test_terms_are_looked_up_once(monkeypatch):
    """What finding terms costs follows the distinct ones of a batch; rows, terms and numbers are those of a plain count."""
    texts = pa.array(["moron idiot " * 500, None, "idiot else", "other " * 300])
    keys = np.unique(toxicity._terms(pa.array(["moron", "idiot"]))[1])
    asked = []
    plain = np.searchsorted

    def counted(ordered, values, **more):
        asked.append((ordered, np.size(values)))
        return plain(ordered, values, **more)

    monkeypatch.setattr(np, "searchsorted", counted)
    known = toxicity.Known(keys)
    row, term, n, other, times = known.find(texts)
    assert sum(size for ordered, size in asked if ordered is known.keys) <= 10
    where = {int(k): j for j, k in enumerate(known.keys)}
    expected = collections.Counter((int(r), int(k)) for r, k in zip(*toxicity._terms(texts), strict=True))
    assert dict(zip(zip(row.tolist(), term.tolist(), strict=True), n.tolist(), strict=True)) == {
        (r, where[k]): c for (r, k), c in expected.items() if k in where
    }
    assert sorted(zip(other.tolist(), times.tolist(), strict=True)) == sorted((r, c) for (r, k), c in expected.items() if k not in where)
    assert not len(toxicity.Known(keys[:0]).find(texts)[0])


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    label = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: label[n] for n in linked}


def test_pipeline(spark, tables):
    docs = tables["documents"]
    odd = [(0, "repeated id with another text than before", "en", "x", 1), (None, "a text without an id", None, None, None)]
    odd += [(9001, None, None, None, None), (9002, "", "en", "x", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    item = tables["benchmark"].first().text
    prose = docs.where("doc_id = 1").first().text
    planted = [(9100, prose + " " + item, "en", "x", 1), (9101, prose, "en", "x", 1), (9102, prose + " write to a@b.co now", "en", "x", 1)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = docs.select("doc_id").collect()
        docs = step(spark, docs, FOLDER).cache()
        assert docs.columns == tables["documents"].columns, name
        assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before}
    kept = {r.doc_id: r for r in docs.collect()}
    assert not {9001, 9002, 9100, 9101} & set(kept)
    assert all("a@b.co" not in r.text and r.n_chars == len(r.text) for r in kept.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert len(last) == len(kept) and all(r.round_trip for r in last)


def test_near_copies_without_ids(spark):
    base = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]
    texts = [
        (7, base),
        (None, [*base[:-1], "x"]),  # a near copy of a document with an id
        (None, base),
        (None, other),
        (None, other),
        (None, [*other[:-1], "x"]),  # of one without
        (None, ["alone", "here"]),
        (9, ["something", "else"]),
    ]
    rows = [(i, " ".join(t), "en", "x", 1) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_copies(spark, docs, FOLDER)
    assert left.columns == docs.columns
    found = left.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [7, 9]
    loose = [r.text for r in found if r.doc_id is None]
    assert len(loose) == 2 and "alone here" in loose
    none = corpus_pipeline.near_copies(spark, docs.where("doc_id is null"), FOLDER).collect()
    assert len(none) == 3 and {r.doc_id for r in none} == {None}


def test_pipeline_decodes_written_ids(spark):
    """A task of the last stage runs one Python step, so that an executor keeps one worker a core."""
    rows = [(k, t, "en", "web", len(t or "")) for k, t in enumerate(["two words", "", None, "été ▁ 漢字", "two words"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    done = corpus_pipeline.tokens(spark, docs, FOLDER)
    assert done._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = {r.doc_id: r.ids for r in codec.encode(docs, path).collect()}
    assert {r.doc_id: (r.ids, r.n_tokens) for r in done.collect()} == {k: (v, len(v)) for k, v in ids.items()}
    assert all(r.round_trip for r in done.collect())


def test_pipeline_sends_small_batches(spark):
    """Long texts reach Python in batches of bounded bytes, all of them."""
    docs = spark.range(0, 4000, 1, 1).selectExpr("id doc_id", "repeat('abcdefg ', 512) text", "'en' lang", "'web' source", "4096L n_chars")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    for step in (corpus_pipeline.quality_rules, corpus_pipeline.near_copies, corpus_pipeline.benchmark_free, corpus_pipeline.tokens):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        step(spark, docs.limit(0), FOLDER)
        found = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in found) == 4000
        assert max(r.size for r in found) <= 2 * corpus_pipeline.BATCH_BYTES
