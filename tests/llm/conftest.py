import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, registers string"


def words(rng, n):
    return [rng.choice(["th", "er", "on", "ble", "nd", "ing"]) + rng.choice(["a", "tion", "st", "ly", "es"]) + str(rng.randrange(30)) for _ in range(n)]


def thue_morse(n):
    """A word of n letters and its complement: power sums of their letters agree to a high degree."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def texts():
    """Texts with copies, near copies, edges of every kind; the ids are their places."""
    rng = random.Random(5)
    base = words(rng, 120)
    out = [" ".join(base), " ".join(base), " ".join([*base, "more"]), " ".join(base[:60] + ["x"] + base[60:]), " ".join(base[:100])]
    for k in range(12):  # a chain of near copies of another text
        near = words(random.Random(9), 200)
        near[k * 3] = f"changed{k}"
        out.append(" ".join(near))
    out += [None, "", " \n\t ", "one", "ONE", "one two three four", "one two three four five", "One Two three four five", "a b c", "x" * 3000, "é" * 70 + "\r\nok 你好 🎉", "don't </s> [INST] \\< <|end|>"]
    out += [" ".join(words(rng, rng.randrange(50, 160))) for _ in range(20)]
    out.append(" ".join(words(rng, 40_000)))
    for n in (1024, 4096):  # two words each, alone and inside texts, that only a sound hash tells apart
        out += thue_morse(n)
        out += [f"one two {w} three four five six" for w in thue_morse(n)]
    out.append("same line\nsame line\n\nsame line\nother\n" * 3)
    return out


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(i, t, None if i % 3 else "en", "hot", None, "no", "1.0", "z") for i, t in enumerate(texts())]
    rows.append((rows[0][0], *rows[0][1:]))  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def by_id():
    return dict(enumerate(texts()))
