"""Near copies of the pipeline's stage against brute force over sets of five words."""

import random

import numpy as np
import pytest

from tessera.llm import nearcopies, simhash
from tests.llm.cases import documents


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def planted(seed=1):
    """Texts with copies that differ in some words, by more than two bits of their fingerprints."""
    rng = random.Random(seed)
    out = []
    for _ in range(25):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 300))]
        out.append(" ".join(words))
        for changes in (0, 1, 2, 3, 5, 9):
            other = list(words)
            for at in rng.sample(range(len(words)), changes):
                other[at] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(other))
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for _ in range(90):  # a group over ALL_PAIRS: copies of one text, unlike each other by more than from it
        other = list(base)
        for at in rng.sample(range(200), 3):
            other[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(other))
    out += [" ".join(base), None, "", " \n", "one two", "One  two", "one two three"]
    rng.shuffle(out)
    return list(enumerate(out))


def kept_by_brute_force(data):
    sets = {k: shingles(t) for k, t in data}
    label = {k: k for k in sets}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or 5 * shared >= 4 * len(sets[a] | sets[b])):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {k for k in sets if root(k) == k}


@pytest.mark.parametrize("chunk", [20_000, 40])
def test_stage_keeps_one_of_each(spark, chunk):
    data = planted()
    kept = nearcopies.one_of_each_near(documents(spark, data), chunk=chunk)
    assert kept.columns == documents(spark, data).columns
    assert {r.doc_id for r in kept.collect()} == kept_by_brute_force(data)


def test_texts_apart_meet_their_candidates():
    rng = np.random.default_rng(1)
    key, root = np.arange(60), np.array([0] * 40 + list(range(40, 60)))
    sketch = rng.integers(0, 256, (60, nearcopies.LONG)).astype(np.uint8)
    sketch[41] = sketch[7]
    sketch[42] = sketch[43]
    sketch[44, :70], sketch[45, :60] = sketch[7, :70], sketch[7, :60]
    sketch[50, :57] = sketch[7, :57]  # one value too few
    # the texts outside component 0 ask, all are asked
    both = [np.concatenate([x[40:], x]) for x in (key, sketch, root)]
    asks = np.array([True] * 20 + [False] * 60)
    earlier = np.arange(80).reshape(80, 1)  # no table before has two of them together
    a, b, more = nearcopies.proposed_apart(*both, asks, earlier, 100)
    whole = set(zip(a.tolist(), b.tolist(), strict=True))
    assert {(41, 7), (43, 42), (44, 7), (44, 41), (45, 7), (45, 41), (45, 44)} == whole and not more
    a, b, more = nearcopies.proposed_apart(*both, asks, earlier, 1)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(41, 7), (43, 42), (44, 7), (45, 7)} and more
    assert len(nearcopies.proposed_apart(both[0], both[1], np.zeros(80, int), asks, earlier, 8)[0]) == 0
    earlier[[1, 20 + 7]] = -1  # 41 and 7 meet in a table before
    a, b, _ = nearcopies.proposed_apart(*both, asks, earlier, 100)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == whole - {(41, 7)}


def blended(rng, base, mixed):
    """A text of ``base`` with a run of its words exchanged."""
    own = list(base)
    at = rng.randrange(len(own) - mixed)
    own[at : at + mixed] = [f"m{rng.randrange(10**6)}" for _ in range(mixed)]
    return own


@pytest.mark.parametrize("chunk", [20_000, 50])
def test_a_pair_that_ranks_below_many_others_is_linked(spark, chunk):
    """Texts that share a bucket's words, too unlike each other to be copies, and pairs among them whose sketches agree less than with others."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    data = []
    for _ in range(120):  # each keeps about three quarters of the base: 0.55 to each other, in common buckets
        data.append(blended(rng, base, 60))
    for _ in range(6):
        copy = list(data[rng.randrange(120)])
        for at in rng.sample(range(400), 6):
            copy[at] = f"c{rng.randrange(10**6)}"
        data.append(copy)
    rows = list(enumerate(" ".join(x) for x in data))
    rng.shuffle(rows)
    kept = {r.doc_id for r in nearcopies.one_of_each_near(documents(spark, rows), chunk=chunk).collect()}
    assert kept == kept_by_brute_force(rows)


def test_copies_of_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    data = []
    for _ in range(60):
        one = list(base)
        for at in rng.sample(range(300), 9):
            one[at] = f"x{rng.randrange(10**6)}"
        two = list(one)
        for at in rng.sample(range(300), 5):
            two[at] = f"y{rng.randrange(10**6)}"
        data += [" ".join(one), " ".join(two)]
    rng.shuffle(data)
    data = list(enumerate(data))
    kept = {r.doc_id for r in nearcopies.one_of_each_near(documents(spark, data)).collect()}
    assert kept == kept_by_brute_force(data) and 1 < len(kept) < 100


def test_pipeline_drops_near_copies_beyond_two_bits(spark):
    import corpus_pipeline

    data = planted(2)[:60]
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, documents(spark, data), "").collect()} == kept_by_brute_force(data)


def test_reused_ids_and_no_rows(spark):
    data = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "own words of the second row"), (None, "a b c d e f")]
    kept = nearcopies.one_of_each_near(documents(spark, data)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "a b c d e f"), (1, "a b c d e f"), (2, "own words of the second row")]
    assert nearcopies.one_of_each_near(documents(spark, [])).count() == 0


def test_operator_keeps_other_texts_of_a_reused_id(spark):
    data = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "own words of the second row"), (2, None), (3, ""), (None, "a b c d e f")]
    kept = simhash.one_of_each(documents(spark, data)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "a b c d e f"), (1, "a b c d e f"), (2, ""), (2, "own words of the second row")]


def test_texts_are_fetched_once_for_all_rounds(spark, monkeypatch):
    """Rounds that compare more pairs read the texts that the first fetch left; before, each fetched them from all documents again."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]

    def changed(words, n):
        own = list(words)
        for at in rng.sample(range(300), n):
            own[at] = f"c{rng.randrange(10**6)}"
        return own

    data = [changed(base, 5) for _ in range(80)]  # 0.7 to each other: no copies, but no sketch rules them out
    data += [changed(data[rng.randrange(80)], 2) for _ in range(6)]
    rows = list(enumerate(" ".join(x) for x in data)) + [(0, " ".join(data[0])), (None, " ".join(data[1]))]
    names, real = [], nearcopies.written

    def told(df, name, *args):
        names.append(name)
        return real(df, name, *args)

    monkeypatch.setattr(nearcopies, "written", told)
    kept = {r.doc_id for r in nearcopies.one_of_each_near(documents(spark, rows)).collect()}
    assert kept == kept_by_brute_force(rows[:86]) | {None}
    assert names.count("similar") > 1 and names.count("compared") == 1
