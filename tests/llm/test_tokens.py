"""Operators 5, 6 and 7 against their libraries on whole texts, and the wavelet matrix against plain arrays."""
import hashlib
import zlib

import numpy as np

from reelkit.llm import pieces_bpe, token_counts, vocab, wavelet

SCHEMA = "doc_id long, text string, digest string, n_tokens int, shard string"
AWKWARD = ["", None, " ", "  a  b\n c\0d", "x\n\ny z", "a\n", "\nq", "w <|endoftext|> e<|startoftext|>.", "don't I'LL, é., ﬁ x y  z",
           "Σίσυφος ΣΑΣ. word,. x,\ny", "é ́a", "tab\there\r\nnew", "日本語、テスト。 123 4a5.", "a \n b", "a.\n!b", "1.\n2, x1. A!",
           "a   ", "a▁b ▁▁c", "<s> </s> <unk> <0x41> ▁", "😀 x", "word, " * 30_000, "x" * 5000, "A.B.C, d.e"]


def rows_of(spark):
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = AWKWARD + given[:80] + given[:5]
    rows = [(i * 3 % 211, t) for i, t in enumerate(texts)] + [(None, "no id"), (6, "again"), (6, "again")]
    return rows, spark.createDataFrame([(i, t, "x", 0, "y") for i, t in rows], SCHEMA)


def test_token_files(spark):
    rows, df = rows_of(spark)
    path = vocab.vocabulary_path("byte_bpe_50k.json")
    t = vocab.library_tokenizer(path)
    start, want = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = wavelet.token_files(df, path).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert wavelet.token_files(spark.createDataFrame([], SCHEMA), path).count() == 0


def test_small_files_follow_each_other(spark, tmp_path):
    rows, df = rows_of(spark)
    path = vocab.vocabulary_path("byte_bpe_50k.json")
    wavelet.write_token_files(df, f"{tmp_path}/t", path, file_tokens=500)
    a = wavelet.read_token_files(spark, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() > 20
    assert sorted(map(str, a.collect())) == sorted(map(str, wavelet.token_files(df, path).collect()))


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for a in (np.minimum(rng.zipf(1.4, 3000), 50256), np.zeros(5, int), np.array([70_000, 3, 70_000]), np.zeros(0, int), np.arange(1030)):
        a = a.astype(np.uint32)
        w = wavelet.WaveletMatrix(wavelet.encode(a))
        assert (w.tokens() == a).all() and w.n == len(a)
        for i in rng.integers(0, max(1, len(a)), 40) if len(a) else ():
            token = int(a[i])
            assert w.access(int(i)) == token and w.count(token) == (a == token).sum()
            assert w.rank(token, int(i)) == (a[:i] == token).sum()
            assert w.occurrences(token)[:9] == np.flatnonzero(a == token)[:9].tolist() if len(a) < 2000 else True
        assert w.count(999_999) == 0 and w.rank(-1, 0) == 0


def test_token_counts_and_their_cache(spark, tmp_path):
    rows, df = rows_of(spark)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"):
        path, cache = vocab.vocabulary_path(name), f"{tmp_path}/{name}"
        if name.endswith(".json"):
            n = lambda t: len(vocab.library_tokenizer(path).encode(t, add_special_tokens=False).ids)  # noqa: E731, B023
        else:
            import sentencepiece
            n = lambda t, sp=sentencepiece.SentencePieceProcessor(model_file=path): len(sp.encode(t))
        want = sorted([(i, len((t or "").encode()), n(t or ""), n(t or "") > 2048) for i, t in rows], key=str)
        assert sorted(map(tuple, token_counts.token_counts(df.limit(40), path, cache).collect()), key=str)
        before = spark.read.parquet(cache)
        first = {r.digest for r in before.collect()}
        assert sorted(map(tuple, token_counts.token_counts(df, path, cache).collect()), key=str) == want
        after = [r.digest for r in spark.read.parquet(cache).collect()]
        assert len(after) == len(set(after)) and first < set(after)  # only misses were encoded and appended
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), path, f"{tmp_path}/none").count() == 0


def test_special_strings_in_any_case(spark, tmp_path):
    texts = ["<|ENDOFTEXT|>", "a <|EndOfText|> b", "<|StartOfText|>x", "<|endoftext|>", "A<|endoftext|>B.", "Q<|ENDOFTEXT|><|endoftext|>,",
             "<|EndOfText|>.", "é<|ENDOFTEXT|>", "WORD, <|STARTOFTEXT|> Word."]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = vocab.vocabulary_path(name)
        df = spark.createDataFrame([(i, t, "x", 0, "y") for i, t in enumerate(texts)], SCHEMA)
        want = {i: len(vocab.library_tokenizer(path).encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
        assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, path, f"{tmp_path}/{name}").collect()} == want


def test_pieces(spark):
    rows, df = rows_of(spark)
    path = vocab.vocabulary_path("piece_bpe_32k.model")
    enc = pieces_bpe.encoder(path)
    want = []
    for i, t in rows:
        ids = [*enc.library.encode(t or ""), 2]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(enc.library.decode(ids))))
    assert sorted(map(tuple, pieces_bpe.encode_decode(df, path).collect()), key=str) == sorted(want, key=str)
    out = pieces_bpe.encode_decode(df, path, with_ids=True).filter("doc_id = 9").first()
    assert out.ids[-1] == 2 and out.decoded == enc.library.decode(out.ids)
    assert pieces_bpe.encode_decode(spark.createDataFrame([], SCHEMA), path).count() == 0
    for p in ("▁the", "▁internationalisation", "aaaa▁", "▁" * 40, "x" * 300, "é日😀"):
        assert enc.agenda._short(p) == enc.agenda._long(p)


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(pieces_bpe, "ENTRIES", 3)
    texts = [t or "" for t in AWKWARD] + ["a b c d e f", "g, h. i!\nj"]
    enc = pieces_bpe.PieceEncoder(vocab.vocabulary_path("piece_bpe_32k.model"))
    parts = vocab.ByteLevelParts(vocab.vocabulary_path("byte_bpe_50k.json"))
    for cut in (texts[:5], texts[5:12], texts):
        assert [ids for _, ids in enc.encode(cut)] == enc.library.encode(cut)
        parts.first.trim(0), parts.later.trim(0)
        assert [x.tolist() for x in parts.ids(cut)] == [e.ids for e in parts.tokenizer.encode_batch_fast(cut, add_special_tokens=False)]


def test_words_that_end_in_any_latin_letter():
    path = vocab.vocabulary_path("word_bpe_49k.json")
    whole = vocab.WholeCounts(path).counts
    texts = [f"ab{chr(c)}{m}" for c in range(0x80, 0x250) for m in ".,;:!?"]
    assert vocab.WordCounts(path).counts(texts) == whole(texts)


def test_parts_joined_by_line_feeds():
    t = vocab.ByteLevelParts(vocab.vocabulary_path("byte_bpe_50k.json"))
    parts = [f"w{i}x" for i in range(700)] + ["é́", "日本", "'ll", "<|endoftext|>", "a\tb", "12,3", " lead", "\u200b", "\x85q", "a\u00a0b", "😀"]
    one = [vocab.array(t.kind, e.ids).tobytes() for e in t.tokenizer.encode_batch(parts, add_special_tokens=False)]
    assert t._encode(parts) == one and t._encode([" " + p for p in parts]) == [
        vocab.array(t.kind, e.ids).tobytes() for e in t.tokenizer.encode_batch([" " + p for p in parts], add_special_tokens=False)]
    odd = ["a\n", "b", "c ", "\n", "", "d\ne"]
    assert t._encode(odd) == [vocab.array(t.kind, e.ids).tobytes() for e in t.tokenizer.encode_batch(odd, add_special_tokens=False)]


def test_shard_numbers_of_many_partitions():
    import pyarrow as pa
    shard = 800_000 * 100_000 + 7
    batch = pa.RecordBatch.from_pydict({"shard": [shard], "doc_ids": [[5]], "lengths": [[2]], "n_tokens": [2],
                                        "matrix": [wavelet.encode(np.array([9, 2], np.uint16))]}, schema=wavelet._FILES)
    (out,) = wavelet._read([batch])
    assert out.column("shard").to_pylist() == [shard] and out.column("n_tokens").to_pylist() == [2]


def test_random_texts_of_awkward_characters_are_cut_as_the_library_cuts_them():
    rng = np.random.default_rng(12)
    signs = [" ", " ", " ", "\n", "\n", "a", "B", "z", "'s", "'", ".", ",", ":", "!", "é", "É", "ʼ", "ɐ", "ª", "²", "7", "\t", "\r", "\x1c", "\x85", " ", " ",
             "　", "́", "Ġ", "日", "ſ", "ß", "😀", "<|endoftext|>", "<|", "|>", "\0", "_", "word", "$$", "​", "Ω"]
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 14, 20_000)]
    t = vocab.ByteLevelParts(vocab.vocabulary_path("byte_bpe_50k.json"))
    want = [e.ids for e in t.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for some in (range(0, 9000), range(9000, 20_000), range(0, 20_000, 7)):
        assert [x.tolist() for x in t.ids([texts[i] for i in some])] == [want[i] for i in some]
    assert t.ids([]) == [] and [len(x) for x in t.ids(["", ""])] == [0, 0]


def test_words_that_go_to_the_model_alone():
    t = vocab.ByteLevelParts(vocab.vocabulary_path("byte_bpe_50k.json"))
    words = [chr(c) + x for c in range(0x41, 0x260) if chr(c).isalpha() for x in ("", "b", "é")]
    words += [" " + w for w in words] + ["internationalisation" * 9, " ñciónmenteue"]
    assert any(map(vocab._latin_word, words)) and not any(map(vocab._latin_word, ["", " ", "a b", "\nab", "ab.", "日", "a1", "  a"]))
    assert [np.frombuffer(x, t.kind).tolist() for x in t._encode(words)] == [
        e.ids for e in t.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def test_a_part_that_comes_often_is_looked_up_once(monkeypatch):
    asked, values_of = [], vocab.PartCache.values_of
    monkeypatch.setattr(vocab.PartCache, "values_of", lambda self, cut, parts: asked.extend(map(len, cut)) or values_of(self, cut, parts))
    t = vocab.ByteLevelParts(vocab.vocabulary_path("byte_bpe_50k.json"))
    texts = ["some words, come often.\nsome words come again: often"] * 300
    assert [x.tolist() for x in t.ids(texts)] == [e.ids for e in t.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert sum(asked) < 30
