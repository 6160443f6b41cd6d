"""Small tables with the cases that every operator has to stand, and plain versions to compare with."""

import random

WORDS = "the of river basin flow rain soil level month value cloud storm grid cell zone tile depth gauge field north south".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def texts(seed=0):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(20, 160)) for _ in range(12)]
    out = [None, "", " \n\t", "one", "Two Words", "ÉÀ ß 日本 \U0001f600"]
    out += base + base[:3] + [base[0]] * 5
    for t in base[:6]:  # near copies
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    passage = sentence(rng, 90)
    out += [f"{sentence(rng, 15)} {passage} {sentence(rng, 15)}" for _ in range(4)]
    out.append("a" * 3000)
    out.append("ab cd ef gh " * 400)
    out.append(sentence(rng, 30_000))  # very long
    return out


def documents(spark, rows=None, extra=True):
    """doc_id, text, and columns whose names operators use inside."""
    rows = texts() if rows is None else rows
    data = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        for name in ("th", "spans", "cls", "size", "shard", "batch", "n", "grp", "cell", "slot", "akey", "ids", "part", "label", "one", "start"):
            df = df.withColumn(name, df["lang"])
    return df


def labels(spark, n=40):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(n)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
