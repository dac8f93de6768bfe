import base64
import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from clearfold.llm import bpe
from clearfold.llm.common import TOKENIZERS
from clearfold.llm.packing import PATTERN

PATH = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(r) for a, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def ids(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]


@given(st.lists(st.text(alphabet="'strvemldx  \n\t1,é字\x85　²", max_size=30), max_size=5))
@settings(max_examples=300, deadline=None)
def test_as_the_library_does(library, encoder, texts):
    assert ids(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(library, encoder):
    texts = [f"a{c}1{c} {c}" for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff"]
    assert ids(encoder, texts) == library.encode_ordinary_batch(texts)


def test_long_pieces(library, encoder):
    texts = ["ab" * 20_000, "é" * 9_999, " " * 5_000 + "x", " \n" * 4_000, "z" * 49]
    assert ids(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_offsets_and_decoding(encoder):
    text = "Größe  it's 字 12"
    raw, offsets = next(encoder.encode_with_offsets([text]))
    parts = [encoder.ranks.bytes[i] for i in np.frombuffer(raw, "<u4").tolist()]
    data = text.encode()
    assert [data[a:b] for a, b in zip(offsets, offsets[1:])] == parts
    assert encoder.decode(raw) == data


def test_odd_rows(odd, library):
    found = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(odd, PATH).collect())
    wanted = []
    for r in odd.collect():
        text = r["text"] or ""
        own = library.encode_ordinary(text)
        raw = np.array(own, "<u4").tobytes()
        wanted.append((len(own), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert found == sorted(wanted)


def test_empty_table(docs_of):
    assert bpe.round_trip(docs_of([]), PATH).count() == 0
