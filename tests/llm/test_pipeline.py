"""The pipeline's stages against plain versions on a small corpus, and on awkward rows."""
import random
from collections import Counter

import xxhash

import corpus_pipeline as cp
from reelkit.llm import mixing, quality, vocab
from tests.llm.test_simhash import brute as components
from tests.llm.test_simhash import plain
from tests.llm.test_suffixes import brute as repeats

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_each_stage_on_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    step = cp.quality_classifier(spark, docs, SF).cache()
    left = {r.doc_id: r for r in step.collect()}
    assert step.columns == docs.columns and all(left[i] == before[i] for i in left)
    assert all((i in left) == bool(q) for i, q in labels.items())

    near = cp.simhash_near_dedup(spark, step, SF).cache()
    comp = components([(i, plain(r.text)) for i, r in sorted(left.items())])
    assert near.columns == docs.columns and rows_of(near) == Counter(tuple(left[i]) for i in left if comp[i] == i)

    cut = cp.suffix_dedup(spark, near, SF).cache()
    want = {r[0]: r[1:] for r in repeats([(r.doc_id, r.text) for r in near.collect()])}
    texts = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns and texts.keys() == want.keys()
    assert all(len(r.text.encode()) <= want[i][0] - want[i][1] and r.n_chars == len(r.text) for i, r in texts.items())

    mixed = cp.mix_sources(spark, cut, SF).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    assert mixed.columns == docs.columns
    assert rows_of(mixed) == Counter({tuple(texts[i]): n for i, n in copies.items() if n})

    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=vocab.vocabulary_path("piece_bpe_32k.model"))
    last = cp.sentencepiece(spark, mixed, SF).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in last) == Counter(
        {(i, len(sp.encode(texts[i].text)) + 1): n for i, n in copies.items() if n})
    assert rows_of(cp.run(spark, SF)) == Counter(tuple(r) for r in last)


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(1)
    text = " ".join(str(rng.random()) for _ in range(40))
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, nth int, g long, row string, size int"
    rows = [(i, t, None, s, None, "x", None, 1, 2, "r", 3) for i, t, s in
            [(1, None, None), (2, "", "a"), (3, text, "b"), (3, text, "b"), (4, text, None), (None, text, "a"), (None, None, "b"),
             (7, "word " * 30_000, "a"), (8, text + "é" * 200, "ß")]]
    labels = spark.createDataFrame([(3, 1, 0), (7, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        step = docs
        for name, stage in cp.STAGES:
            before = step
            step = stage(spark, step, sf)
            assert name == cp.STAGES[-1][0] or step.columns == before.columns == docs.columns
        found = step.collect()
        assert len(found) <= 2 * len(data) and bool(data) >= bool(found)


def test_near_dedup_keeps_one_and_rows_without_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in [(5, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (9, "z y x w v u")]], schema)
    assert sorted(str(r.doc_id) for r in cp.simhash_near_dedup(spark, docs, SF).collect()) == ["2", "9", "None"]


def test_near_dedup_keeps_one_row_of_each_group(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghijklmnopq", k=12)) for _ in range(25)]
    rows = [(rng.choice([None, *range(12)]), rng.choice([t, t.upper(), t.title()])) for t in texts * 6] + [(None, texts[0])] * 5
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    digest = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)
    comp = components(list({plain(t): plain(t) for _, t in rows}.items()))
    want = {}
    for i, t in rows:
        group = (comp[plain(t)], i is None)
        want[group] = min(want.get(group, (i or 0, digest(t), t)), (i or 0, digest(t), t))
    got = Counter((r.doc_id, r.text) for r in cp.simhash_near_dedup(spark, docs, SF).collect())
    assert got == Counter((None if alone else i, t) for (_, alone), (i, _, t) in want.items())


def test_without_labels_all_stay(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert cp.quality_classifier(spark, docs, str(tmp_path)).count() == 1
    assert quality.held_out() is not None
