import hashlib
import random

import pytest
import sentencepiece
import tokenizers

from groundcheck.llm import queries, sentencepieces, tokencount, vocabulary

MODEL = f"{queries.TOKENIZERS}/{queries.PIECES}"


@pytest.fixture(scope="module")
def vocab():
    return vocabulary.load(MODEL)


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def unigram(vocab, lib):
    model = tokenizers.models.Unigram([(lib.id_to_piece(i), lib.get_score(i)) for i in range(vocab.size)], unk_id=0, byte_fallback=True)
    return tokenizers.Tokenizer(model)


def random_texts(n, seed):
    r = random.Random(seed)
    alphabet = "aaabbcde th inoner   \n\té中😀▁.12ññ"
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 60))) for _ in range(n)] + ["", " ", "     ", "a" * 500, "ab" * 300, " " * 40 + "x"]


def test_encoding_equals_library(vocab, lib):
    encoder = sentencepieces.Encoder(vocab)
    texts = random_texts(1500, 5)
    ids, counts = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        got = ids[at : at + n].tolist()
        assert got == lib.encode(text), text
        assert sentencepieces.decode_ids(got, vocab.surface) == text.replace("▁", " ")
        at += n


def test_unigram_kind_and_counts_equal_library(vocab, unigram):
    encoder, counter = sentencepieces.Encoder(vocab, "unigram"), tokencount.Counter(vocab)
    texts = random_texts(800, 6)
    ids, counts = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        want = unigram.encode(vocabulary.marked(text)).ids
        assert ids[at : at + n].tolist() == want and counter.text(text)[0] == len(want), text
        at += n


def test_queries_over_the_table(spark, small_dir, vocab, lib, unigram):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op3_sentencepiece"](spark, small_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        want = lib.encode(rows[r.doc_id])
        assert (r.n_pieces, r.ids_sha256, r.round_trip) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), True)
    counted = queries.QUERIES["op8_token_counts"](spark, small_dir).collect()
    assert {r.doc_id: r.n_tokens for r in counted} == {i: len(unigram.encode(vocabulary.marked(t)).ids) for i, t in rows.items()}


def test_edge_rows(spark, vocab, lib):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "  blanks  "), (5, "y" * 30000), (6, "word " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_pieces")
    encoded = sentencepieces.encode(docs, vocab, check=True)
    got = encoded.collect()
    assert sorted((r.id or 0, r.ids) for r in got) == sorted((i or 0, lib.encode(t or "")) for i, t in rows) and all(r.round_trip for r in got)
    assert sorted((r.id or 0, r.text) for r in sentencepieces.decode(encoded, vocab).collect()) == sorted((i or 0, t or "") for i, t in rows)
    counts = {r.id: (r.n_tokens, r.score) for r in tokencount.token_counts(docs, vocab).collect()}
    assert counts[1] == counts[2] == (0, 0.0) and counts[3][0] > 0
    assert sentencepieces.encode(docs.limit(0), vocab).count() == tokencount.token_counts(docs.limit(0), vocab).count() == 0
