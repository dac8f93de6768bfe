import base64

from hypothesis import given, settings
from hypothesis import strategies as st

from clearfold.llm.common import TOKENIZERS
from clearfold.llm.pieces import UNKNOWN, LongestMatch, token_counts

PATH = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def brute(word, vocabulary):
    count = at = 0
    while at < len(word):
        fits = [n for n in range(len(word) - at, 0, -1) if word[at : at + n] in vocabulary]
        if not fits:
            return UNKNOWN
        count, at = count + 1, at + fits[0]
    return count


WORDS = st.text(alphabet="abc", min_size=1, max_size=6).map(str.encode)


@given(st.sets(WORDS, max_size=12), st.lists(st.text(alphabet="abc", max_size=14).map(str.encode), max_size=20))
@settings(max_examples=300, deadline=None)
def test_against_greedy_matching(vocabulary, words):
    match = LongestMatch(sorted(vocabulary))
    assert [match.count(w) for w in words] == [brute(w, vocabulary) for w in words]


def test_public_vocabulary_and_odd_rows(odd):
    with open(PATH, "rb") as lines:
        vocabulary = {base64.b64decode(line.split()[0]) for line in lines}
    wanted = []
    for r in odd.collect():
        words = (r["text"] or "").encode().split()
        wanted.append((r["doc_id"], len(words), sum(brute(b" " + w, vocabulary) for w in words)))
    found = [tuple(r) for r in token_counts(odd, PATH).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_empty_table(docs_of):
    assert token_counts(docs_of([]), PATH).count() == 0
