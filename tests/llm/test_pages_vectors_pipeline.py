"""Pages, vectors, the registered queries and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kpiloom.llm import ball_tree, page_templates, queries
from tests.conftest import SF_DIR


def page(title: str, paragraphs: list[str], body: str = "article") -> str:
    text = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
        f'<nav><ul><li><a href="/">Home</a></li><li>About</li></ul></nav><div class="sidebar">Most read</div>'
        f'<div class="ad">Buy now</div><{body}><h1>{title}</h1>{text}<div class="comments"><p>first!</p></div></{body.split()[0]}>'
        f'<form><input name="q">Search</form><footer>&copy; site</footer>')


@pytest.mark.parametrize("body", ["article", 'div id="content"', "main"])
def test_main_text_without_its_surroundings(spark, body):
    rng = random.Random(1)
    rows, want = [], {}
    for k in range(12):
        own = [f"text {k} {rng.random()} &amp; <b>bold</b>  tail" for _ in range(rng.randint(1, 4))]
        rows.append((k, f"https://www.example.org/a/{k}", page(f"Title {k}", own, body)))
        want[k] = " ".join([f"Title {k}", *[p.replace("&amp;", "&").replace("<b>", "").replace("</b>", "").replace("  ", " ") for p in own]])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = page_templates.main_text(df, page_templates.Settings(group=5)).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_main_text_of_odd_pages(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://a.b/c", "<p>one<p>two <i>x</i>y<br>z"), (3, "http://a.b/c", "<p>one<p>two <i>x</i>y<br>z"),
            (None, "http://a.b/d", "<div><article>long " + "word " * 20000 + "</article>"), (5, "http://c.d", "plain &lt; text"),
            (6, "http://c.e", "<script>never closed"), (7, "http://c.f", "</div></p>a<!-- b -->c<")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.url): r.text for r in page_templates.main_text(df).collect()}
    assert got[1, None] == "" and got[2, "x"] == "" and got[3, "http://a.b/c"] == "one two xy z"
    assert got[5, "http://c.d"] == "plain < text" and got[6, "http://c.e"] == "" and len(got[None, "http://a.b/d"].split()) == 20001
    assert page_templates.main_text(df).count() == len(rows) and page_templates.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("inner,want", [
    ("<header><h1>Head</h1></header><p>one</p>", "Head one"),
    ("<p>one</p><figure><img><figcaption>A caption</figcaption></figure>", "one A caption"),
    ("<p>mass <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here</p>", "mass E=m here"),
    ('<p class="legal notice">Read this.</p><p class="related work">Others did.</p>', "Read this. Others did."),
    ('<p>one</p><p class="ad">Buy</p><div class="related">More</div><footer>foot</footer>', "one"),
    ("<h2>Ingredients</h2><p>flour %d</p><h2>Method</h2><p>bake %d</p>", None),
])
def test_article_keeps_its_own_parts(inner, want):
    pages = [f"<body><nav>Home</nav><article>{inner.replace('%d', str(k))}</article></body>" for k in range(6)]
    for k, text in enumerate(page_templates.extract(pages if want is None else pages[:1])):
        assert text == (want if want is not None else f"Ingredients flour {k} Method bake {k}")


def test_all_articles_of_a_page_are_taken():
    page = "<main id=a><p>first part</p></main><div>between</div><article id=b><p>second part is longer</p></article>"
    assert page_templates.extract([page]) == ["first part second part is longer"]


def test_equivalence_classes():
    vectors = {"a": {0: 1, 1: 1, 2: 1}, "b": {0: 1, 1: 1, 2: 1}, "c": {0: 2, 1: 1, 2: 1}, "d": {0: 1}}
    assert page_templates.classes(vectors, 3, page_templates.Settings()) == {"a", "b"}


def test_classes_are_ordered_and_nested():
    pages = [list("abxc"), list("abcx"), list("axbc"), list("abcx")]
    assert page_templates.ordered(set("abxc"), pages) == list("abc")
    assert page_templates.ordered(set("ab"), [list("aabb"), list("abab")]) == []
    places = lambda *x: [np.array(x)]
    assert page_templates.nested(places(1, 2, 3, 4), 2, places(0, 5), 2)
    assert not page_templates.nested(places(1, 6), 2, places(0, 5), 2)
    # "the" is in the template and in the text: the first stands in a gap of its own.
    marks = page_templates.template([["a", "the", "b", *["the"] * n] for n in (0, 2, 1, 0)], [0, 1, 2, 3], page_templates.Settings())
    assert marks == [[True] * 3 + [False] * n for n in (0, 2, 1, 0)]


def test_template_blocks_have_slots():
    """Outside the article a mostly fixed block goes with what fills its slots, inside it stays."""
    rng = random.Random(6)
    own = [" ".join(str(rng.random()) for _ in range(12)) for _ in range(8)]
    by = [f"By {name} on day {7 * k + 3}" for k, name in enumerate("John Mary Ann Bob Eve Tom Zoe Ian".split())]
    records = ["".join(f"<p>Name: {rng.random()} Age: {k}</p>" for k in range(n)) for n in (1, 3, 2, 5, 4, 1, 2, 3)]
    told = [r.replace("<p>", "").replace("</p>", " ").strip() for r in records]
    assert page_templates.extract([f"<div>{b}</div><div id=t><p>{t}</p>{r}</div>" for b, t, r in zip(by, own, records)]) == [
        f"{t} {r}" for t, r in zip(own, told)]
    assert page_templates.extract([f"<article><p>{b}</p><p>{t}</p></article>" for b, t in zip(by, own)]) == [
        f"{b} {t}" for b, t in zip(by, own)]


@pytest.mark.parametrize("body", ["article", "main", "div"])
def test_unnamed_template_inside_the_article(body):
    rng = random.Random(3)
    own = [" ".join(str(rng.random()) for _ in range(20)) for _ in range(9)]
    pages = [f"<body><{body}><div class=x1>Read our offers</div><p>{t}</p><div><p>By the desk</p></div></{body}></body>" for t in own]
    assert page_templates.extract(pages) == own


def test_all_sections_of_pages_without_article():
    rng = random.Random(4)
    words = [[" ".join(str(rng.random()) for _ in range(n)) for n in (3, 20)] for _ in range(8)]
    pages = [
        f"<body><div id=top>Our site</div><div id=lead><p>{a}</p></div><div id=body><p>{b}</p></div><nav>Go</nav></body>"
        for a, b in words]
    assert page_templates.extract(pages) == [f"{a} {b}" for a, b in words]
    assert page_templates.extract(pages[:1]) == [f"Our site {words[0][0]} {words[0][1]}"]


@pytest.mark.parametrize("body", ["article", "div"])
def test_copied_pages_are_no_template(body):
    rng = random.Random(5)
    text = [" ".join(str(rng.random()) for _ in range(10)) for _ in range(4)]
    page = "<body><nav>{0}</nav><{1}><p>{2}</p><p>{3}</p></{1}></body>"
    same = [page.format(k, body, " ".join(text[:2]), " ".join(text[2:])) for k in range(40)]
    edited = [page.format(k, body, " ".join(text), f"edition {k}") for k in range(6)]
    assert page_templates.extract(same) == [" ".join(text)] * 40
    assert page_templates.extract(edited) == [f"{' '.join(text)} edition {k}" for k in range(6)]
    other = page.format(0, body, "something else", "here")
    assert page_templates.extract([*same, other])[-1] == "something else here"


def brute_top_k(ids, vectors, k=5):
    scaled = np.floor(np.array(vectors, dtype=float) * 256).astype(np.int64)
    out = set()
    for q in range(len(ids)):
        if ids[q] % 50 == 0:
            scores = scaled @ scaled[q]
            best = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:k]
            out |= {(ids[q], r + 1, ids[j], int(scores[j])) for r, j in enumerate(best)}
    return out


@pytest.mark.parametrize("settings", [ball_tree.Settings(), ball_tree.Settings(shard_rows=40, block=2, leaf=4)])
def test_top_k_is_exact(spark, settings):
    rng = np.random.default_rng(2)
    ids = list(range(0, 400))
    vectors = [rng.normal(size=8).round(1).tolist() for _ in ids[:300]] + [[0.5] * 8] * 100
    rows = [(i, v, "x") for i, v in zip(ids, vectors)]
    odd = [(1000, None, ""), (1050, [1.0, None] + [0.0] * 6, ""), (1100, [float("nan")] * 8, ""), (None, [1.0] * 8, ""), (7, vectors[7], ""), (1150, [], "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string").repartition(5)
    got = ball_tree.top_k(df, F.col("vec_id") % 50 == 0, settings).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == brute_top_k(ids, vectors)
    assert len(got) == 8 * 5
    assert ball_tree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("size", [1e6, 3e7, 1e12, 1e300])
def test_large_components_have_exact_scores(spark, size):
    """Sums of products above 2^53, above 2^63, and far above what a long holds."""
    rng = random.Random(int(np.log10(size)))
    vectors = [[rng.uniform(-size, size) for _ in range(4)] for _ in range(120)] + [[size] * 4, [-size] * 4]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(3)
    whole = [[int(np.floor(256 * x)) if abs(256 * x) < np.inf else 0 for x in v] for v in vectors]
    got = {}
    for r in ball_tree.top_k(df, F.col("vec_id") % 50 == 0, ball_tree.Settings(shard_rows=30, leaf=4)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    low, high = -(1 << 63) + 1, (1 << 63) - 1
    for q in range(0, len(vectors), 50):
        exact = {i: sum(a * b for a, b in zip(whole[q], v)) for i, v in enumerate(whole) if i != q}
        best = sorted((-min(max(s, low), high), i) for i, s in exact.items())[:5]
        assert sorted(got[q]) == [(k, i, -s) for k, (s, i) in enumerate(best, start=1)]


def test_few_candidates_are_all_returned(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (50, [1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in ball_tree.top_k(df, F.col("vec_id") % 50 == 0).collect()]
    assert got == [(0, 1, 1)]


def test_registered_queries_cover_their_tables(spark):
    registered = queries.registered()
    assert [n.split("_")[0] for n in registered] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.statements()) <= set(registered)


def test_pipeline_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram jaccard join", "mixing sources to target weights", "packing"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SF_DIR)
        assert out.columns == docs.columns and out.count() == 0


def test_pipeline_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    packed = corpus_pipeline.run(spark, SF_DIR).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.sum(F.when(F.col("start") == 0, 1)).alias("rows")).collect()
    assert {r.doc_id: r.rows for r in packed} == dict(ids)


def test_pipeline_takes_odd_rows(spark, tmp_path, documents, odd):
    """NULL, empty, blank and very long texts, missing ids, copies, and columns of clashing names."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60")
    strange = documents(odd + [(300 + k, "a clean sentence about nothing in particular, told twice.\n" * 2) for k in range(4)])
    rows = docs.unionByName(strange.withColumn("doc_id", F.col("doc_id") + 10_000))
    for name in ("score", "_key", "taken"):
        rows = rows.withColumn(name, F.lit("mine"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, str(tmp_path)).collect(), rows.schema)
        assert kept.where("score <> 'mine' or _key <> 'mine' or taken <> 'mine'").count() == 0
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    starts = Counter(r.doc_id for r in packed.where("start = 0").collect())
    assert starts == ids and not {10_001, 10_002, 10_003} & set(ids)
    assert len([i for i in ids if i and 10_300 <= i < 10_304]) <= 1
