"""Small tables with nulls, ties, repeats, empty and long texts, and columns with names that operators use inside."""

import random

WORDS = "the of and river stone cloud paper signal matter orange violet window garden silver copper forest ladder market bridge".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts(seed=5, n=60):
    rng = random.Random(seed)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    own = [" ".join(f"{rng.choice(WORDS)}{rng.randrange(10**4)}" for _ in range(rng.randrange(3, 120))) for _ in range(n)]
    own[3] = own[2]
    own[5] = own[4] + " tail"
    own[7] = own[6] + "\n" + passage
    own[9] = passage + "\n" + own[8]
    own[11] = "a" * 1000
    own[12] = "ab " * 400
    own[13] = "é" * 300 + " ÀÉ Straße"
    own[14] = "\n\n"
    own[15] = " ".join(f"long{rng.randrange(10**7)}" for _ in range(40_000))
    own[17] = own[16].upper()
    return own


def rows(n=60):
    own = [(k, t) for k, t in enumerate(texts(n=n))]
    own += [(None, "no id here but a line of words"), (1000, None), (1001, ""), (1002, ""), (20, own[20][1]), (20, own[20][1])]
    return own


def documents(spark, data=None):
    """doc_id and text with extra columns that clash with names used inside."""
    data = rows() if data is None else data
    full = [(i, t, "en", "src0", None if t is None else len(t), 1, "x", 2.0) for i, t in data]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, pos int, version string, score double")


def both(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)
