"""What a query may not leave out, on inputs where a cut would show."""

import duckdb
import numpy as np
import pytest

from decisionkit.llm import ann, licenses, pii, webtext


def neighbours(ids, x, q, k=10):
    far = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
    far[ids == q] = np.inf
    return ids[np.lexsort((ids, far))[:k]].tolist()


@pytest.mark.parametrize("kind", ["sf0.1", "shards"])
def test_no_true_neighbour_is_missing(spark, kind):
    from pyspark.sql import functions as F

    if kind == "sf0.1":
        path = "/root/testdata/sf0.1/embeddings.parquet"
        table = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}' ORDER BY vec_id").fetchnumpy()
        ids, x, frame = table["vec_id"], np.stack(table["embedding"]).astype(float), spark.read.parquet(path)
    else:  # three shards about as large as the default
        ids, x = np.arange(12_000), np.random.default_rng(3).normal(size=(12_000, 64)).astype(np.float32).astype(float)
        frame = spark.createDataFrame(list(zip(ids.tolist(), x.tolist())), "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert set(got) == set(ids[ids % 100 == 0].tolist())
    assert all([found[k] for k in sorted(found)] == neighbours(ids, x, q) for q, found in got.items())


def selected(spark, texts, kind):
    """Per text the spans of a kind."""
    got = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    cut = {r["doc_id"]: [s.split(":") for s in filter(None, r["spans"].split(","))] for r in got}
    return [[t[int(a) : int(b)] for k, a, b in cut[i] if k == kind] for i, t in enumerate(texts)]


def private_texts():
    draw = np.random.default_rng(5)
    number = lambda n: "".join(map(str, draw.integers(0, 10, n)))
    texts = []
    for k in range(240):
        texts.append([f"some words and name{k}@host{k % 7}.example more words", f"call +1 ({number(3)}) 555-{number(4)} then", f"seen 10{k % 9}.153.118.{k % 200 + 20} in", f"key {number(16)} and", "plain words only"][k % 5])
    return texts


def test_spelt_addresses_and_bare_numbers_are_selected(spark):
    mails = ["jane.doe [at] mail [dot] com", "sam(at)site.org", "kim (at) firm.example"]
    phones = ["(017) 555-7713", "415-555-0100", "212 555 0187"]
    texts = private_texts() + [f"some words and {m}. More words" for m in mails] + [f"call {p} then" for p in phones] + ["seen 96.153.118.61 in"]
    n = len(private_texts())
    assert selected(spark, texts, "email")[n : n + 3] == [[m] for m in mails]
    found = selected(spark, texts, "phone")
    assert found[n + 3 : n + 6] == [[p] for p in phones] and found[-1] == []


def test_personal_data_of_one_row_is_that_among_many(spark):
    alone = ["call 415-555-0100 then", "jane.doe [at] mail [dot] com", "seen 96.153.118.61 in", "number 4111111111111112 and", "build 500.2.1.7 of", "row 7 [at] 8.9 of"]
    many = [pii.personal_data(spark.createDataFrame(list(enumerate(alone + more)), "doc_id long, text string")).where("doc_id < 6").orderBy("doc_id").collect() for more in ([], private_texts())]
    want = ["phone:5:17", "email:0:28", "ip:5:18", "", "", ""]
    assert [[r["spans"] for r in rows] for rows in many] == [want, want]
    one = spark.createDataFrame([(3, alone[0])], "doc_id long, text string")
    assert pii.personal_data(one).first()["spans"] == want[0]


def test_thresholds_of_a_rare_kind_see_all_its_proposals(spark):
    texts = private_texts() + [f"words and name{k}@host.example words" for k in range(3000)]
    found = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).cache()
    _, aside = pii._scored(found, 200, 2, 2)
    cards, known = aside.where("kind = 'card'").count(), found.where("kind = 'card'").count()
    assert known > 40 and known / 10 < cards < known  # the fitting sample has some, and all others calibrate
    assert aside.where("kind = 'email'").count() > 5000


def extracted(spark, pages):
    """Texts of pages, each on a host of its own."""
    rows = [(k, f"http://h{k}.org/a", h) for k, h in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in webtext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [got[k] for k in range(len(pages))]


def test_wrappers_named_like_furniture_keep_their_text(spark):
    names = ["layout no-sidebar", "has-banner", "elementor-widget-text-editor", "post-social", "menu-closed"]
    pages = [f"<div class='{n}'><p>the story</p></div>" for n in names] + ["<article class='post comments-open'><p>the story</p></article>"]
    pages += [f"<div class='{n}'><article><p>the story</p></article></div>" for n in ("widget", "comments", "menu")]
    pages += [f"<article><div class='{n}'><p>the story</p></div></article>" for n in names]
    pages += [f"<article><p>the story</p></article><div class='{n}'><article>remark</article></div>" for n in ("comments", "comments-area")]
    pages += [f"<p>the story</p><div class='{n}'>menu</div>" for n in ("site-footer", "ad", "nav-menu", "side-bar", "top widget_2")]
    assert extracted(spark, pages) == ["the story"] * len(pages)


def test_teasers_do_not_replace_the_story(spark):
    story = "a story of quite a few words"
    pages = [f"<div><p>{story}</p></div><{tag}><article>teaser</article></{tag}>" for tag in ("aside", "nav", "footer")]
    pages += [f"<{tag}>menu<article>{story}</article>" for tag in ("aside", "nav")] + [f"<nav>menu<article>{story}</article><nav>more</nav>"]
    pages += [f"<div><div class=ad>buy<article>{story}</article></div><p>out", f"<form><div>x</div><article>{story}</article></form>"]
    assert extracted(spark, pages) == [story] * len(pages)
    cards = f"<div>Site name</div><p>{story} {{0}}</p><article class=card>teaser {{0}}</article><div>Contact us</div>"
    rows = [(k, f"https://h.org/news/{k}", cards.format(k)) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in webtext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert got == {k: f"{story} {k}\nteaser {k}" for k in range(3)}


def test_articles_lose_the_lines_that_their_neighbours_share(spark):
    page = "<nav>menu</nav><article><h1>Story {0}</h1><p>Read all about it here.</p><p>what happened on day {0} and after it</p><p>Share this</p></article><p>out</p>"
    rows = [(k, f"https://h.org/news/{k}", page.format(k)) for k in range(4)]
    near = "<article><p>one text that two pages hold</p><p>seen {0}</p></article>"  # near-equal articles are text
    rows += [(k, f"https://copies.org/{k}", near.format(k)) for k in (10, 11)] + [(20, "https://alone.org/", page.format(20))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in webtext.main_text(pages).collect()}
    want = {k: f"Story {k}\nwhat happened on day {k} and after it" for k in range(4)} | {k: f"one text that two pages hold\nseen {k}" for k in (10, 11)}
    assert got == want | {20: "Story 20\nRead all about it here.\nwhat happened on day 20 and after it\nShare this"}


def test_footrules_of_a_block_are_those_of_its_queries():
    draw = np.random.default_rng(11)
    prefixes, asked = (np.array([draw.permutation(20)[:6] for _ in range(n)]) for n in (50, 9))
    pivot = prefixes.ravel()
    listed = np.argsort(pivot, kind="stable")
    starts = np.searchsorted(pivot[listed], np.arange(21))
    members, places = np.repeat(np.arange(50), 6)[listed], np.tile(np.arange(6), 50)[listed]
    place = lambda prefix: np.array([list(prefix).index(p) if p in prefix else 6 for p in range(20)])
    want = [[np.abs(place(a) - place(b)).sum() for b in prefixes] for a in asked]
    assert (ann._footrules(asked, starts, members, places, 50, 6) == want).all()


def test_licenses_read_their_documents_once(spark, tmp_path):
    """Later passes read where template words stand, and a text of any length costs its own length."""
    rows = [(1, "x " * 3000 + "released under the mit license " + "y " * 3000), (2, None), (3, "the and of"), (3, "released under the mit " + "z " * 40 + "license")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    out = licenses.license_scan(spark.read.parquet(f"{tmp_path}/docs"))
    assert f"{tmp_path}/docs" not in "".join(out.inputFiles())
    assert sorted((r["doc_id"], r["n_words"], r["labels"], round(r["score"], 6)) for r in out.collect()) == [(1, 6005, "mit", 1.0), (2, 0, "", 0.0), (3, 3, "", 0.0), (3, 45, "mit", 0.8)]
    odd = {r["doc_id"]: r["labels"] for r in licenses.license_scan(spark.read.parquet(f"{tmp_path}/docs").where("doc_id = 1"), block_words=67).collect()}
    assert odd == {1: "mit"}
