"""Byte-level BPE and token counts against the libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from rowmill.llm import bpe, token_counts
from rowmill.llm.units import Memo, spaced_words, units

from helpers import documents, odd_texts, save

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "\n", "\n\n", "\t", "a", "the", "é", "日本語", "😀", "12", "٣", "!!", "...", "'s", "'ll", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "<|", "x" * 70, "\x00", " of", "don't"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(1500)] + [t or "" for t in odd_texts()]


def test_encoding_equals_the_library_and_decodes(library, texts):
    own = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for t in texts:
        ids = own.encode(t)
        assert ids.tolist() == library.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_segment_tree_equals_repeated_search():
    rng = random.Random(5)
    ranks = {bytes([c]): c for c in range(256)}
    for k in range(300):
        a, b = rng.choice([*ranks]), rng.choice([*ranks])
        ranks.setdefault((a + b)[:6], 256 + k)
    single = {t: r for t, r in ranks.items()}

    def plain(piece):
        if piece in single:
            return [single[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(single[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in single]
            if not found:
                return [single[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for _ in range(300):
        piece = bytes(rng.choice(b"abcd\xc3") for _ in range(rng.randrange(1, 40)))
        assert bpe.merged(piece, single) == plain(piece)


def test_counts_equal_the_library(texts):
    library = Tokenizer.from_file(JSON)
    want = [len(library.encode(t, add_special_tokens=False)) for t in texts]
    assert token_counts.Counter(JSON).count(texts) == want
    small = token_counts.Counter(JSON, chunk=40, overlap=4)
    assert [small.huge(t) for t in texts[:1500]] == want[:1500]
    assert small.widened > 0


def test_units_join_to_the_text(texts):
    for t in texts:
        assert "".join(units(t)) == t
        words = spaced_words(t)
        assert words is None or " ".join(words) == t


def test_memo_is_bounded():
    asked = []
    memo = Memo(lambda k: asked.append(k) or len(k), most=4, width=2)
    assert [memo[k] for k in ("a", "b", "c", "a", "d", "e", "f", "a", "b", "long")] == [1] * 9 + [4]
    assert len(memo) + len(memo.older) <= 4 and "long" not in memo
    assert asked == ["a", "b", "c", "d", "e", "f", "a", "b", "long"]


def test_op9_and_op10_rows(spark, tmp_path, library):
    given = odd_texts() * 2
    save(documents(spark, given, [*range(len(given) - 1), None]).selectExpr("*", "1 as n_tokens", "2 as ids"), tmp_path, "documents")
    counted = token_counts.counted_documents(spark, str(tmp_path)).collect()
    encoded = {str(r.doc_id): r for r in bpe.encoded_documents(spark, str(tmp_path)).collect()}
    assert len(counted) == len(encoded) == len(given)
    json_library = Tokenizer.from_file(JSON)
    for r in counted:
        t = given[-1 if r.doc_id is None else r.doc_id] or ""
        n = len(json_library.encode(t, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512)
        ids = np.array(library.encode_ordinary(t), "<u4")
        e = encoded[str(r.doc_id)]
        assert (e.n_tokens, e.ids_sha256, e.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_ids_column_decodes_and_empty_table(spark):
    df = documents(spark, ["hello world", None])
    made = bpe.encode(df, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "text"])
    back = bpe.decode(made, RANKS, public_tokenizers.PATTERN).collect()
    assert [bytes(r.bytes).decode() for r in back] == ["hello world", ""]
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.count_tokens(df.limit(0), JSON).count() == 0
