"""The registered queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from reelkit.llm import ann, codes, mixing, pieces_bpe, pii, quality, resampling, sharding, simhash, sketches, suffixes, token_counts, vocab, wavelet
from reelkit.llm.common import shared_path, table

QUERIES, ORACLES = {}, {}


def _register(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return put


@_register("op5_wavelet_token_files")
def op5(spark, sf_dir):
    return wavelet.token_files(table(spark, sf_dir, "documents"), vocab.vocabulary_path("byte_bpe_50k.json"))


@_register("op6_token_counts")
def op6(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocab.vocabulary_path("word_bpe_49k.json"),
                                     shared_path(spark, "token-counts"))


@_register("op7_sentencepiece")
def op7(spark, sf_dir):
    return pieces_bpe.encode_decode(table(spark, sf_dir, "documents"), vocab.vocabulary_path("piece_bpe_32k.model"))


@_register("op2_simhash_near_dedup")
def op2(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_register("op9_mix_sources", mixing.ORACLE)
def op9(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@_register("op8_graph_neighbours")
def op8(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


@_register("op3_balanced_shards")
def op3(spark, sf_dir):
    return sharding.shards(table(spark, sf_dir, "documents"))


@_register("op4_quality_classifier")
def op4(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register("op1_suffix_dedup")
def op1(spark, sf_dir):
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@_register("op10_sketch_fingerprints")
def op10(spark, sf_dir):
    return sketches.sketches(table(spark, sf_dir, "documents"))


@_register("op13_active_entry_codes", codes.oracle())
def op13(spark, sf_dir):
    return codes.codes(table(spark, sf_dir, "embeddings"))


@_register("op11_importance_resampling", resampling.ORACLE)
def op11(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register("op12_candidate_pii")
def op12(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))
