"""Every query against SQL or brute force on the smallest tables."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from decisionkit.llm import licenses, secrets
from decisionkit.llm.queries import ORACLES, QUERIES, vocabulary
from tests.llm import brute
from tools.check import compare, connect

NAMES = {int(n[2:].split("_")[0]): n for n in QUERIES}


@pytest.fixture(scope="module")
def docs(sf):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, sf, n):
    return [r.asDict() for r in QUERIES[NAMES[n]](spark, sf).collect()]


def test_queries_and_the_pipeline_are_registered():
    assert sorted(NAMES) == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "personal_data", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf).toArrow(), connect(sf).sql(ORACLES[name]).to_arrow_table()) == []


def test_licenses(spark, sf, docs):
    want, text = brute.licenses(docs), dict(docs)
    for r in rows(spark, sf, 2):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want[r["doc_id"]]
        more = brute.contained(text[r["doc_id"]], licenses.TEMPLATES, licenses.THRESHOLD, licenses.BLOCK_WORDS)
        assert r["labels"] == ",".join(sorted(set(more) | set(filter(None, r["base_labels"].split(",")))))
        assert r["score"] == pytest.approx(1.0 if r["n_base"] else max(more.values(), default=0.0))


def test_packing(spark, sf, docs):
    from tokenizers import Tokenizer

    got, want = rows(spark, sf, 3), brute.pieces(docs, Tokenizer.from_file(vocabulary("word")))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in map(sorted, sequences.values()):
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert len(sequences) <= 1.05 * sum(r["length"] for r in got) / 2048 + 2


def test_personal_data(spark, sf, docs):
    want, got = brute.personal(docs), rows(spark, sf, 4)
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == want[r["doc_id"]][:5]
        assert set(want[r["doc_id"]][5]) <= set(r["spans"].split(","))


def test_secrets(spark, sf, docs):
    got, text = rows(spark, sf, 11), dict(docs)
    assert len(got) == len(docs)
    for r in got:
        base = brute.base_secrets(text[r["doc_id"]] or "")
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert r["base_sha256"] == brute.sha(",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base))
        assert r["spans"] == brute.secret_spans(text[r["doc_id"]] or "", secrets.GENERATORS, secrets.KINDS, secrets.ROLES, secrets.REACH, secrets.LEAST_KINDS, secrets.BREAK)


def test_prefix_trie(spark, sf):
    table = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in rows(spark, sf, 12)), key=str) == brute.trie(table)


def test_whitening(spark, sf):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, n, deviations, coordinates, explained = brute.whitening(table)
    got = {(r["vec_id"], r["component"]): r for r in rows(spark, sf, 13)}
    assert len(got) == 8 * len(ids) and all(r["n"] == n and r["identity_error"] < 1e-9 for r in got.values())
    found = np.array([[got[i, k]["whitened"] for k in range(1, 9)] for i in ids])
    assert np.allclose(found * np.sign((found * coordinates).sum(axis=0)), coordinates, atol=1e-7)
    assert [got[i, 1]["deviation"] for i in ids] == deviations
    assert np.allclose([got[ids[0], k]["explained"] for k in range(1, 9)], explained, rtol=1e-10)


def test_nearest_vectors(spark, sf):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY vec_id").fetchnumpy()
    ids, x = table["vec_id"], np.stack(table["embedding"]).astype(float)
    got, hits = {}, 0
    for r in rows(spark, sf, 5):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(ids[ids % 100 == 0].tolist())
    for q, answers in got.items():
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        assert sorted(answers) == list(range(1, 11))
        assert all(s == pytest.approx(far[ids == v][0], abs=1e-12) for v, s in answers.values())
        hits += len({v for v, _ in answers.values()} & set(ids[np.lexsort((ids, far))[:10]].tolist()))
    assert hits >= 9 * len(got)


def test_near_duplicates(spark, sf, docs):
    want = brute.near(docs, 4, 80)
    for r in rows(spark, sf, 8):
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])


def test_round_trip(spark, sf, docs):
    from tokenizers import Tokenizer

    want = brute.round_trip(docs, Tokenizer.from_file(vocabulary("byte")))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(spark, sf, 9)} == want


def test_main_text(spark, sf):
    import html
    import re

    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    got = rows(spark, sf, 10)
    assert len(got) == len(pages)
    for r in got:
        article = re.split("</article>", pages[r["page_id"]].split("<article>")[1])[0]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1|br)>", article))
        assert r["text"] == "\n".join(filter(None, parts)) and r["n_chars"] == len(r["text"])


def test_toxicity(spark, sf, docs):
    import zlib

    got = rows(spark, sf, 6)
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


def test_held_out_toxicity(spark):
    """On the largest tables here: documents whose labels were never learnt from."""
    import zlib

    sf = "/root/testdata/sf0.1"
    labels = duckdb.sql(f"SELECT doc_id, max(toxic) FROM '{sf}/labels.parquet' WHERE toxic IN (0, 1) GROUP BY doc_id").fetchall()
    from decisionkit.llm import toxicity

    read = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    got = {r["doc_id"]: r for r in toxicity.toxicity(read("documents"), read("labels")).collect()}
    aside = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    y = np.array([y for _, y in aside])
    assert len(y) > 1000 and brute.auc([r["score"] for r, _ in aside], y) > 0.95
    for column in ("predicted", "rejected"):
        picked = np.array([bool(r[column]) for r, _ in aside])
        assert (picked & (y == 1)).sum() > 0.8 * y.sum() and (picked & (y == 1)).sum() > 0.9 * picked.sum()
    assert all(0.5 <= r["threshold"] <= 1 for r in got.values()) and len({r["threshold"] for r in got.values()}) > 1


def test_pipeline(spark, sf, docs):
    """Stage by stage: what each keeps follows from what it was given."""
    given = spark.read.parquet(f"{sf}/documents.parquet")
    kept = given
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), given.schema)
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert set(after) <= set(before)
        if name == "exact_dedup":
            import re

            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]), i)
            assert set(after) == set(first.values())
        if name == "near_dedup":
            want = brute.near(list(before.items()), 5, 80)
            assert set(after) == {i for i, (_, c) in want.items() if c == i}
        if name == "personal_data":
            found = brute.personal(list(before.items()))
            assert set(after) == set(before)
            assert all((after[i] == before[i]) == (not found[i][5]) for i in before)
            assert not any(v[5] for v in brute.personal(list(after.items())).values())
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert {r["doc_id"] for r in packed} == set(after)
