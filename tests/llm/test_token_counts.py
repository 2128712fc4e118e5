import random

import public_tokenizers
import pytest

from sieveworks.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


def viterbi(word, scores, unknown):
    """Plain dynamic programme over one word: the best score of each prefix, and the tokens of that segmentation."""
    best = [(0.0, 0, False)] + [None] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(e):
            if word[s:e] in scores and (best[e] is None or best[s][0] + scores[word[s:e]] > best[e][0]):
                best[e] = (best[s][0] + scores[word[s:e]], best[s][1] + 1, False)
        if word[e - 1] not in scores:
            t = best[e - 1][0] + unknown
            if best[e] is None or t > best[e][0]:
                best[e] = (t, best[e - 1][1] + (not best[e - 1][2]), True)
    return best[-1][1]


@pytest.fixture(scope="module")
def trie():
    return T.PrefixTrie(T.read_pieces(PATH))


def test_trie_equals_a_plain_programme(trie):
    r = random.Random(9)
    words = ["".join(r.choice("abcdeinorst☃é한") for _ in range(r.randrange(1, 25))) for _ in range(400)] + ["internationalization", "☃☃☃", "a" * 300]
    want = [viterbi(T.MARK + w, trie.scores, trie.unknown) for w in words]
    assert trie.counts(words).tolist() == want
    r.shuffle(words)
    assert [trie.insert(T.MARK + w) for w in words] == [viterbi(T.MARK + w, trie.scores, trie.unknown) for w in words]


def test_agrees_with_a_unigram_model_of_another_library(trie):
    tokenizers = pytest.importorskip("tokenizers")
    pieces = T.read_pieces(PATH)
    model = tokenizers.models.Unigram([("<unk>", trie.unknown), *pieces], 0, False)
    r = random.Random(10)
    for _ in range(200):
        w = "".join(r.choice("abcdeghilmnoprstuy") for _ in range(r.randrange(1, 18)))
        trie.insert(T.MARK + w)
        assert sum(trie.scores[t.value] for t in model.tokenize(T.MARK + w)) == pytest.approx(trie.best[-1])


def test_shared_prefixes_are_scored_once():
    trie, made = T.PrefixTrie([("a", -1.0), ("ab", -1.5), (T.MARK, -1.0)]), []
    trie.clear()

    class Kept(list):
        def append(self, x):
            made.append(x)
            super().append(x)

    trie.best = Kept(trie.best)
    words = ["abab", "abba", "aba"]
    trie.counts(words)
    assert len(made) == len({(T.MARK + w)[:k] for w in words for k in range(1, 6)})


@pytest.mark.parametrize("depth", [1, 3, 7, 4096])
def test_deep_words_are_whole_and_memory_is_bounded(monkeypatch, depth):
    monkeypatch.setattr(T, "DEPTH", depth)
    r = random.Random(11)
    trie = T.PrefixTrie([(p, s) for p, s in T.read_pieces(PATH) if len(p) <= 5])
    words = ["".join(r.choice("abcdeinorst☃") for _ in range(n)) for n in (5, 6, 20, 21, 200, 201, 900)]
    words += [words[-1][:300] + "x", words[-1] + "é"]
    assert trie.counts(words).tolist() == [viterbi(T.MARK + w, trie.scores, trie.unknown) for w in words]
    assert len(trie.best) <= 2 * (trie.longest + depth) + 1


def test_frame(spark, docs):
    rows = [(1, "hello world"), (1, "hello world"), (None, "x"), (2, None), (3, "  \n"), (4, "word " * 50_000), (5, "q" * 1_000_000), (6, "")]
    got = {r.doc_id: r.n_tokens for r in T.token_counts(docs(rows), PATH).collect()}
    trie = T.PrefixTrie(T.read_pieces(PATH))
    assert got[2] == got[3] == got[6] == 0 and got[4] == 50_000 * trie.counts(["word"])[0] and got[None] >= 1
    assert got[5] == trie.counts(["q" * 1_000_000])[0]
    assert T.token_counts(docs(rows), PATH).count() == 8 and T.token_counts(docs(rows).limit(0), PATH).count() == 0
