"""The pipeline's stages against brute force on their own inputs, and as a whole."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from webloom.llm import common, langid, linear, mixing, packing, pii
from webloom.llm.queries import good_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(None, "It thtiing. Oned en and edeaes in in onsthe. Reinheon the of and that.", "en", None, None), (900001, None, "en", "src1", None), (900002, "", None, "src1", 0), (900003, "Mail a.b@c.example.com the of and that erthe thering ofthe inthat.", "en", "src0", 1), (900003, "Mail a.b@c.example.com the of and that erthe thering ofthe inthat.", "en", "src0", 1)]
    return common.written(docs.unionByName(spark.createDataFrame(more, docs.schema)), "test").withColumns({"found": F.lit(1), "rate": F.lit(2.0), "copies": F.lit(1)})


@pytest.fixture(scope="module")
def steps(spark, base):
    out, docs = [], base
    for name, stage in cp.STAGES:
        got = common.written(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, got))
        docs = got
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_contract(steps):
    assert [n for n, _, _ in steps] == ["language", "near_dedup", "pii", "mixing", "packing"] and cp.ORACLE_SQL is None
    for name, _, got in steps[:-1]:
        assert got.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")], name


def test_language(spark, steps):
    _, before, after = steps[0]
    coder = langid.Coder(langid.profiles(before, good_ids(spark, SF)))
    want = Counter()
    for r in rows(before):
        lang, _ = coder.judge(r["text"], 0.01)
        if lang:
            want[r["doc_id"], r["text"], lang, r["source"], r["n_chars"]] += 1
    assert Counter(tuple(r.values()) for r in rows(after)) == want
    assert 0.95 * before.count() < after.count() < before.count()


def test_near_dedup(steps):
    _, before, after = steps[1]
    had, left = rows(before), rows(after)
    ids = Counter((r["doc_id"], r["text"]) for r in left)
    assert all(n == 1 for n in ids.values())

    def shingles(t):
        h = common.words_of([t])[1].tolist()
        return {tuple(h[i : i + 3]) for i in range(max(1, len(h) - 2))} if h else set()

    s = {(r["doc_id"], r["text"]): shingles(r["text"]) for r in had}
    jac = lambda a, b: len(s[a] & s[b]) / max(1, len(s[a] | s[b]))
    stay = list(ids)
    assert not any(jac(a, b) >= 0.65 for k, a in enumerate(stay) for b in stay[:k])
    gone = set(s) - set(stay)
    assert gone and all(max(jac(g, o) for o in s if o != g) >= 0.35 for g in gone)


def test_texts_of_shared_ids_have_a_kept_copy(spark):
    words = [" ".join(f"{w}{i}" for i in range(60)) for w in ("red", "blue", "green")]
    rows = [(3, words[0]), (5, words[0]), (5, words[1]), (9, words[1]), (9, words[2]), (None, words[2]), (None, words[2]), (7, None), (8, ""), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({"row": F.lit(1), "h": F.lit(1)})
    got = [(r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(3, words[0]), (5, words[1]), (9, words[2]), (7, None), (8, "")], key=str)


def test_personal_data(spark, steps):
    _, before, after = steps[2]
    own = pii.Surrogates(pii.session_key(spark))
    want = Counter()
    for r in rows(before):
        t = pii.pseudonymise(r["text"], own)[0]
        want[r["doc_id"], t, r["lang"], r["source"], len(t)] += 1
    assert Counter(tuple(r.values()) for r in rows(after)) == want
    assert any("a.b@c.example.com" in r["text"] for r in rows(before)) and not any("a.b@c.example.com" in r["text"] for r in rows(after))


def test_mixing(spark, steps):
    _, before, after = steps[3]
    model = mixing.train_domains(before, spark.read.parquet(f"{SF}/labels.parquet"))
    had = rows(before)
    texts = [r["text"] for r in had]
    doc, bucket = common.doc_features(texts, linear.BITS)
    p = model.probabilities(len(texts), doc, bucket)
    tokens = np.bincount(doc, minlength=len(texts)) - 3
    want = tokens.sum() * np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    gram = (p * tokens[:, None]).T @ p
    eta = 1 / np.linalg.eigvalsh(gram / np.sqrt(np.outer(np.diag(gram), np.diag(gram)))).max()
    r = np.ones(len(texts))
    for _ in range(200):
        total = (r * tokens) @ p
        if np.abs(total - want).max() <= 1e-6 * want.sum():
            break
        r = np.maximum(0, r - p @ (eta * (total - want) / np.diag(gram)))
    count = Counter((x["doc_id"], x["text"]) for x in rows(after))
    for x, rate in zip(had, r):
        assert math.floor(rate - 1e-6) <= count[x["doc_id"], x["text"]] <= math.ceil(rate + 1e-6)
    assert sum(count.values()) == pytest.approx(r.sum(), rel=0.15)


def test_packing(steps):
    _, before, after = steps[4]
    c = packing.Counter()
    want = Counter()
    for r in rows(before):
        want[r["doc_id"]] += c.count(r["text"]) + 1
    got = Counter()
    fill = Counter()
    for r in rows(after):
        got[r["doc_id"]] += r["token_end"] - r["token_start"]
        fill[r["window_id"]] += r["token_end"] - r["token_start"]
    assert got == want and all(n == 4096 for w, n in fill.items() if w < max(fill))


def test_run(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["window_id", "position", "source", "doc_id", "token_start", "token_end"] and out.count() > 100


def test_empty(spark, base):
    for _, stage in cp.STAGES:
        assert stage(spark, base.where("false"), SF).count() == 0
