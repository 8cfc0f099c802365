from collections import defaultdict

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_near_dup import brute  # noqa: E402
from tests.llm.test_text_models import brute_em, plain_votes, statistics  # noqa: E402
from tests.llm.test_tokens import crc, ids_of, library  # noqa: E402, F401
from tierflow.llm import toxicity  # noqa: E402


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "packing"]


def test_each_stage_on_what_the_one_before_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept[-1], sf)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        kept.append(spark.read.parquet(f"{tmp_path}/{k}"))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert ids[0] > ids[1] > ids[2] >= ids[3] == ids[4]
    text = {r.doc_id: r.text for r in docs.collect()}
    for i in ids[2]:
        s = statistics(text[i])
        assert s[0] >= 50 and 100 * s[4] <= 50 * s[0]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [i for i in ids[0] if i in labels and not labels[i].toxic]
    assert sum(i in ids[1] for i in clean) >= 0.98 * len(clean)
    groups = defaultdict(set)
    for i, (n, root) in brute([(i, text[i]) for i in sorted(ids[2])][:250], 80).items():
        groups[root].add(i)
    for g in groups.values():
        assert len(g & ids[3]) <= 1
    run = corpus_pipeline.run(spark, sf)
    assert run.count() == kept[4].count()


def plain_score(model, text):
    """A text's score, clause by clause and unit by unit."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends, _, feats = toxicity.unit_features(raw, np.array([0, len(raw)]))
    lexicon = toxicity.Lexicon(model.learned)
    weight = np.max([lexicon.look(h) for h in feats], axis=0) if len(starts) else np.zeros(0)
    clauses, last = [], 0
    for k in range(len(starts)):
        if k == 0 or set(raw[starts[k - 1] : starts[k]].tolist()) & set(b".!?;:\n"):
            clauses.append(([], []))
        listed = next((kind for kind, words in toxicity.LISTS.items() if int(feats[0][k]) in words), toxicity.WORD)
        clauses[-1][0].append(toxicity.INSULT if weight[k] > 0 else listed)
        clauses[-1][1].append(float(weight[k]) or toxicity.GENERAL)
    sums, top = dict.fromkeys(toxicity.READINGS, 0.0), 0.0
    for symbols, weights in clauses:
        top = max(top, toxicity.read_clause(symbols, weights, sums))
    return float(model.scores(np.array([[*sums.values(), top, len(starts)]]))[0])


def test_every_stage_against_plain_python(spark, tmp_path, library):  # noqa: F811
    """Each stage's rows on the whole of a table, recomputed from the texts; then the whole run."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    left = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.train(docs, labels)
    left = {i: t for i, t in left.items() if plain_score(model, t) < 0.5}
    wanted = [set(left)]
    votes = {i: list(plain_votes(t).values()) for i, t in left.items()}
    quality = dict(zip(left, brute_em(list(votes.values())), strict=True))
    left = {i: t for i, t in left.items() if not ((n := statistics(t))[0] < 50 or 100 * n[4] > 50 * n[0]) and quality[i] >= 0.5}
    wanted.append(set(left))
    left = {i: left[i] for i, (_, root) in brute(left.items(), 80).items() if i == root}
    wanted.append(set(left))
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, kept, sf).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        assert {r.doc_id for r in kept.collect()} == wanted[k], k
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf).collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == wanted[2]
    for i, rows in pieces.items():
        ids, at = ids_of(library, left[i]), 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)


def test_repeated_ids_keep_the_largest_row(spark, tmp_path):
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(7, text, "en", "a", 1), (7, text + " more", "en", "a", 2), (7, text + " more", "fr", "a", 0), (8, text.replace("word", "other"), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 4):
        got = {r.doc_id: (r.text, r.lang, r.n_chars) for r in corpus_pipeline.near_dedup(spark, docs.repartition(parts), "").collect()}
        assert got == {7: (text + " more", "fr", 0), 8: (rows[3][1], "en", 1)}


def test_edges(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "x", "en", None, 1), (2, " ".join(f"word{k}" for k in range(80)), "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int"
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, data in (("rows", [(*r, 1) for r in rows] + [(*rows[2], 1)]), ("none", [])):
        d = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema).write.parquet(f"{d}/documents.parquet")
        labels.write.parquet(f"{d}/labels.parquet")
        got = corpus_pipeline.run(spark, d).collect()
        assert {r.doc_id for r in got} == ({2} if data else set())
        assert len(got) == (1 if data else 0)
