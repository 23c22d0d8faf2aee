import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weirstream.llm.bpe import PIECES, EncodedText, PrefixCoder, read_ranks
from weirstream.llm.encode import DEFAULT_VOCABULARY, count_tokens, encode

tiktoken = pytest.importorskip("tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary file here")


@pytest.fixture(scope="module")
def pair():
    with open(DEFAULT_VOCABULARY, "rb") as f:
        ranks = read_ranks(f.read())
    return PrefixCoder(ranks), tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n1é漢!s", max_size=60)))
def test_same_ids_as_the_library(pair, text):
    text = text.encode("utf-8", "replace").decode()
    assert pair[0].encode(text) == pair[1].encode_ordinary(text)


def test_every_prefix_has_its_own_encoding(pair):
    coder, library = pair
    data = "Parliamentarians interrupted".encode()
    last = coder.extend(data, [])
    for i in range(1, len(data) + 1):
        assert coder.read_off(last[:i]) == library._encode_single_piece(data[:i])


def test_append_and_edit(pair):
    coder, library = pair
    rnd = random.Random(7)
    for _ in range(200):
        e = EncodedText(coder, "".join(rnd.choice("ab c1\n!é'") for _ in range(rnd.randint(0, 30))))
        for _ in range(4):
            i = rnd.randint(0, len(e.text))
            e.splice(i, rnd.randint(i, min(len(e.text), i + 5)), "".join(rnd.choice("ab c1\n!é'") for _ in range(rnd.randint(0, 6))))
            assert e.ids() == library.encode_ordinary(e.text)
        e.append("bc  d")
        assert e.ids() == library.encode_ordinary(e.text)


def test_long_piece_is_linear_and_right(pair):
    assert pair[0].encode("a" * 30_000) == pair[1].encode_ordinary("a" * 30_000)


def test_table_with_nulls_repeats_and_clashing_columns(spark, pair):
    rows = [(1, "Order, order.", 0), (2, None, 0), (3, "", 0), (1, "Order, order.", 0), (4, "word " * 50_000, 0), (None, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = [(r.doc_id, list(r.ids)) for r in encode(df).collect()]
    assert got == [(i, pair[1].encode_ordinary(t) if t else []) for i, t, _ in rows]
    assert encode(df.limit(0)).count() == 0
    assert [r.tokens for r in count_tokens(df).collect()] == [len(x) for _, x in got]
