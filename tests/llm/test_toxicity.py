"""Toxicity: the automaton against plain edit distances, held-out labels, quotation, and odd texts."""

import random
import zlib

import pytest

from tessera.llm import toxicity as T
from tests.llm.cases import documents, rows, sentence

INSULTS = ["grobbler", "snivelord", "muckhead", "drong"]


def distance(a, b):
    """Levenshtein's distance by its table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def plain(terms, edits, word):
    found = []
    for k, (term, most) in enumerate(zip(terms, edits, strict=True)):
        swaps = {term[:i] + term[i + 1] + term[i] + term[i + 2 :] for i in range(len(term) - 1)}
        begins = [word[:n] for n in range(max(0, len(word) - T.SUFFIX), len(word) + 1)]
        least = min((distance(term, x) if x not in swaps else min(1, distance(term, x)) for x in begins), default=99)
        least = 0 if word.startswith(term) else max(1, least)
        if least <= most:
            found.append((k, least))
    return sorted(found)


def test_automaton_walks_the_trie_as_distances_say():
    rng = random.Random(3)
    terms = ["abcab", "abca", "bacca", "cabbacab", "acbacbacba", "abc", "bb"]
    trie = T.Trie(terms)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    for term in terms:
        for _ in range(200):
            own = list(term + rng.choice(["", "s", "dd", "xyz", "wxyz"]))
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(own))
                kind = rng.randrange(4)
                if kind == 0:
                    own[i] = rng.choice("abcd")
                elif kind == 1:
                    own.insert(i, rng.choice("abcd"))
                elif kind == 2 and len(own) > 1:
                    del own[i]
                elif i + 1 < len(own):
                    own[i], own[i + 1] = own[i + 1], own[i]
            words.append("".join(own))
    for word in words:
        assert sorted(trie.near(word)) == plain(terms, trie.edits, word), word


def test_spellings():
    assert T.spellings("IDI0T!!!") == ["idiot"] and T.spellings("**st00pid**") == ["stoopid"]
    assert T.spellings("idioooot") == ["idiot"] and T.spellings("loser-like") == ["loser", "like"]
    assert T.spellings("...") == [] and T.spellings("2024") == [] and T.spellings("ｍｏｒｏｎ") == ["moron"]


def corpus(rng, n=400):
    own = []
    for k in range(n):
        words = sentence(rng, rng.randrange(20, 120)).split()
        toxic = k % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        own.append((k, " ".join(words), int(toxic)))
    return own


@pytest.fixture(scope="module")
def learned(spark):
    own = corpus(random.Random(4))
    df = documents(spark, [(k, t) for k, t, _ in own])
    labels = spark.createDataFrame([(k, y) for k, _, y in own], "doc_id long, toxic int")
    return own, df, labels, T.trained(df, labels)


def test_held_out_labels(spark, learned):
    own, df, labels, model = learned
    assert set(model.terms) == set(INSULTS)
    label = {k: y for k, _, y in own}
    got = T.score_toxicity(df, model).collect()
    assert len(got) == len(own)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7) == label[r["doc_id"]]


def test_labels_of_the_held_out_fold_change_nothing(spark, learned):
    own, df, _, model = learned
    other = [(k, 1 - y if zlib.crc32(str(k).encode()) % 3 == 1 else y) for k, _, y in own]
    again = T.trained(df, spark.createDataFrame(other, "doc_id long, toxic int"))
    assert (again.terms, again.edits, again.weights.tolist()) == (model.terms, model.edits, model.weights.tolist())


def test_misspelled_and_mentioned(learned):
    model = learned[3]
    base = sentence(random.Random(9), 40)
    abuse = model.score(f"{base} you grobler and snivlord you mukchead drongs")
    quoted = model.score(f'{base} the word "grobbler" was written and "snivelord" was called an insult')
    assert abuse > 0.7 > 0.3 > quoted
    assert model.score(f"{base} grobblers {base} snivelords {base} muckheads drong") > 0.7


def test_odd_texts(spark, learned):
    model = learned[3]
    got = T.score_toxicity(documents(spark), model).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in got)
    same = [r["score"] for r in got if r["doc_id"] == 20]
    assert len(same) == 3 and len(set(same)) == 1
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    long = " ".join([sentence(random.Random(1), 50_000), *INSULTS])
    assert model.score(long) < 0.7 < model.score(" ".join(INSULTS))


def test_without_labels_or_documents(spark):
    df = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scores = {r["score"] for r in T.score_toxicity(df, T.trained(df, none)).collect()}
    assert len(scores) == 1
    assert T.score_toxicity(documents(spark, []), T.trained(documents(spark, []), none)).collect() == []
