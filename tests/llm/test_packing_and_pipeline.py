import random
import zlib

import numpy as np
import pytest
from odd_docs import make_docs, odd  # noqa: F401

import corpus_pipeline
from tidemark.llm.packing import WordCache, pack
from tidemark.llm.queries import tokenizer_path

public = pytest.importorskip("public_tokenizers")


def plain_pieces(pairs, capacity):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(tokenizer_path()), []
    for doc_id, text in pairs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), capacity):
            own = ids[at : at + capacity]
            out.append((doc_id, at // capacity, at, len(own), zlib.crc32(own.tobytes())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pieces_and_sequences(make_docs, odd, capacity):  # noqa: F811
    rng = random.Random(9)
    pairs = list(odd) + [(100 + i, " ".join(rng.choice(["Alpha,", "été.", "x1", "don't", "<|endoftext|>."]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    got = pack(make_docs(pairs), tokenizer_path(), capacity=capacity).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == plain_pieces(pairs, capacity)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= -(-sum(r.length for r in got) // capacity) * 1.05 + 1
    assert pack(make_docs(pairs).limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_are_the_tokenizer_s(name):
    cache = WordCache(public.path(name), most=50)
    letters = [chr(i) for i in range(0x250) if chr(i).isalpha()]
    texts = ["", " ", "It's, don't. É, e\u0301. ﬁ x\x1cy 12, ...a. '. ŉ. ẞ <|ENDOFTEXT|>, <|endoftext|>.", *(a + "b, " + a + "." for a in letters)]
    assert [cache.ids(t) for t in texts] == cache._whole(texts)


def test_words_of_latin_letters_need_no_rules():
    """Only stretches that the rules before the merges may change go through them; capitals count as their lower-case form."""
    cache, asked = WordCache(tokenizer_path()), []
    texts = ["This THIS this. Erth,\tBe\nétage thisthis", "X y\u0301 \u212b 7", "Énée this7"]
    expected = cache._whole(texts)
    cache.known.whole = lambda s, f=cache.known.whole: asked.append(s) or f(s)
    assert [cache.ids(t) for t in texts] == expected
    assert sorted(asked) == sorted([".", ",", "y\u0301", "\u212b", "7", "Énée", "this7"])


def test_pipeline_stages_follow_each_other(spark, make_docs, odd, tmp_path):  # noqa: F811
    rng = random.Random(10)
    word = lambda: f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(400)}"
    leak = " ".join(word() for _ in range(14))
    clean = [" ".join(word() for _ in range(60)) for _ in range(60)]
    poor = [" ".join(word().upper() + "!!" for _ in range(60)) for _ in range(30)]
    pairs = list(enumerate(clean))
    pairs += [(100 + i, t) for i, t in enumerate(poor)]
    pairs += [(200, "  " + clean[0]), (201, clean[1] + " more"), (202, clean[2]), (203, clean[3] + " " + leak)]
    docs = make_docs(pairs)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expected = [set(range(60)) | {200, 201, 202, 203}, set(range(1, 60)) | {200, 201, 203}, set(range(1, 60)) | {200, 203}, set(range(1, 60)) | {200}]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected):
        left = stage(spark, left, str(tmp_path))
        assert left.dtypes == docs.dtypes, name
        assert sorted(r.doc_id for r in left.collect()) == sorted(ids), name
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r.doc_id for r in last.collect()}) == sorted(expected[-1])


@pytest.mark.parametrize("texts", [[], [None, "", "a"]])
def test_pipeline_on_tiny_tables(spark, make_docs, texts, tmp_path):  # noqa: F811
    make_docs([*enumerate(texts)] or [(0, "")]).limit(len(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len({t or "" for t in texts})
