"""Small corpora with the cases every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, vocabulary=400):
    return [f"w{rng.randint(0, vocabulary)}" for _ in range(n)]


def awkward_texts(seed=1):
    """Texts with copies, near copies, shared passages, empty and long ones."""
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    base = sentence(rng, 120)
    texts = [None, "", " \t\n", "one", "One two\x0bthree", "É é ß\x1c x", "a" * 5000, "x " * 3000]
    texts += [" ".join(sentence(rng, rng.randint(5, 90))) for _ in range(30)]
    for _ in range(12):
        texts.append(" ".join(sentence(rng, 30) + passage + sentence(rng, 25)))
    for i in range(45):  # more near copies than a bucket gives pairs for
        words = base[:]
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 9)}"
        texts.append(" ".join(words))
    texts += [texts[10]] * 4 + [" ".join(base[:60] + sentence(rng, 60))]
    texts += [" ".join(sentence(rng, 4000, 5000))]
    return texts


def rows(seed=1):
    texts = awkward_texts(seed)
    rng = random.Random(seed)
    order = list(range(len(texts)))
    rng.shuffle(order)
    out = []
    for i, t in zip(order, texts):
        source = None if i % 11 == 0 else f"s{i % 5}" if i % 2 else "s0"
        out.append((i, t, "en", source, len(t) if t else None))
    out += [out[12], out[12], (None, texts[12], None, None, None), (None, None, None, None, None)]
    out += [(out[20][0], "same id another text " * 5, "en", "s1", 1)]
    return out


def frame(spark, seed=1):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """The frame with extra columns of these names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})


def key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


def same(a, b):
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
