"""Cases that every operator on documents defines: null ids, repeated rows, nulls, clashing and unusual columns."""

from collections import Counter

import pytest

from tierflow.llm import byte_bpe, lm, media, near_dup, packing, quality, toxicity, wavelet

TEXT = "some text of a few words, said twice"
SCHEMA = "doc_id long, text string, h long, c long, row long, hub string, key string, row_number int, n_tokens string, feature int, ids string"
ROWS = [(None, TEXT), (None, TEXT), (5, TEXT), (5, TEXT), (None, None), (6, ""), (7, "x" * 200_000), (8, TEXT.upper())]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, 2, 3, "hub", "key", 4, "n", 5, "ids") for i, t in ROWS], SCHEMA).repartition(3)


OPERATORS = {
    "byte_bpe": (lambda d, s: byte_bpe.digest(byte_bpe.encode_documents(d)), ("n_tokens", "ids_sha256", "decoded_sha256")),
    "media": (lambda d, s: media.media_features(d), ("n_bytes", "payload_sha256", "media_sha256", "feature")),
    "quality": (lambda d, s: quality.quality(d), (*quality.STATS, "base_failed", "kept")),
    "lm": (lambda d, s: lm.score(d, head=32, rounds=1), ("n_tokens", "n_known", "base_score")),
    "toxicity": (lambda d, s: toxicity.toxicity(d, s.createDataFrame([(None, 1), (5, 0), (5, None)], "doc_id long, toxic int")), ("score", "predicted")),
    "near_dup": (lambda d, s: near_dup.near_dup(d, 85), ("n_shingles",)),
    "wavelet": (lambda d, s: wavelet.store_tokens(d), ("n_tokens", "ids_crc32")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_null_and_repeated_ids(spark, odd, name):
    run, columns = OPERATORS[name]
    got = run(odd, spark).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ROWS)
    same = {tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in got if r.doc_id == 5}
    assert len(same) == 1  # equal texts, equal values
    nulls = Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in got if r.doc_id is None)
    assert nulls[next(iter(same))] >= 2 and sum(nulls.values()) == 3  # the null text may have the same values


def test_packing_of_null_ids(odd):
    got = packing.pack_documents(odd).collect()
    totals = Counter()
    for r in got:
        totals[r.doc_id] += r.length
    whole = {i: r.doc_tokens for r in got for i in [r.doc_id] if i in (6, 7, 8)}
    assert all(totals[i] == n for i, n in whole.items()) and whole[6] == 1
    five = next(r.doc_tokens for r in got if r.doc_id == 5)
    assert totals[5] == 2 * five and totals[None] == 2 * five + 1


def test_a_cluster_names_its_shared_folder(spark):
    from tierflow.llm.base import shared_dir

    class Conf:
        def get(self, *a):
            return None

    class Cluster:
        conf, sparkContext = Conf(), type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())
    assert shared_dir(spark).startswith("file://")


def test_plans_move_texts_once(spark, odd):
    """Operators that keep rows in place have no exchange; html and text cross at most one."""
    for make in (byte_bpe.encode_documents, packing.pack_documents, lambda d: d.mapInArrow(media._to_media, media.MEMBERS)):
        plan = make(odd.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Repartition") <= 1  # the fixture's own


def test_tables_without_training_rows(spark):
    """Only held-out documents: all counts are 0; labels of one class: the general list alone scores."""
    import zlib

    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    got = lm.score(spark.createDataFrame([(i, f"a few words {i}") for i in held], "doc_id long, text string")).collect()
    assert len(got) == len(held) and {(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in got} == {(True, 0, 0, 0.0)}
    assert all(r.score < 0 for r in got)
    docs = spark.createDataFrame([(1, "you idiot"), (2, None), (3, "fine")], "doc_id long, text string")
    one = spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, toxic int")
    assert {r.doc_id: r.predicted for r in toxicity.toxicity(docs, one).collect()} == {1: 1, 2: 0, 3: 0}
