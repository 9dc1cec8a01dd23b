import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sentilake.llm.common import work_path
from sentilake.llm.token_files import SegmentEncoder, read_token_files, token_digest, write_token_files
from tests.llm.helpers import edge_documents, edge_rows, empty_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


ENCODER = SegmentEncoder(PATH)
PIECES = st.sampled_from([" ", "  ", "\n", " \n", "\t", "\xa0", "\x1c", "\x85", "a", "the", "'s", "Über", "日本", "12", "!!", "😀", "Ġ",
                          "<|endoftext|>", " ", "."])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join) | st.text(max_size=30), max_size=6))
def test_encoder_equals_the_library(plain, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ENCODER.encode(texts) == [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_round_trip_of_edge_rows(spark, plain):
    path, rows = work_path(spark, "tokens"), edge_rows()
    write_token_files(edge_documents(spark, rows), path)
    tokens = read_token_files(spark, path)
    got = sorted(tokens.collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda k: (k is not None, k))
    assert [r["start"] for r in got] == [0, *np.cumsum([len(r["ids"]) for r in got])[:-1]]
    want = Counter((r[0], tuple([*plain.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    sums = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in token_digest(tokens).collect()}
    for r in got:
        assert sums[r["doc_id"], r["start"]] == (len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) and r["n_tokens"] == len(r["ids"])


def test_metadata_reads_skip_the_ids(spark):
    path = work_path(spark, "tokens")
    write_token_files(edge_documents(spark), path)
    plan = read_token_files(spark, path).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan


def test_empty_table(spark):
    path = work_path(spark, "tokens")
    write_token_files(empty_documents(spark), path)
    assert token_digest(read_token_files(spark, path)).count() == 0


def test_words_and_their_end_marks_are_kept_apart():
    """A word before a comma was another word; the ids are those of the whole text."""
    from sentilake.llm.token_files import SegmentEncoder
    enc = SegmentEncoder(PATH)
    texts = ["a river river river, river. river's (river) \"river\" river%%% ñi. ñi ×. ÷, x", "river, river", "end.", "e.\nf. g's' h'", "a, \x01, b", "\x01",
             "don't, we'll. it's! a.b, c-d; 1, 2. _x_ y_ z`", "naïve, Été! İ. ß? ﬁ, 中, á. b­, ok",
             "a,  b", "a, ", " a, b", "", ",", ", ,"]
    assert enc.encode(texts) == [np.asarray(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert not any(w.endswith((",", ".", "%")) and w[:-1].isascii() and w[:-1].isalpha() for w in enc.later)
    assert "river" in enc.later
