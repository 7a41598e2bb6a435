import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: columns whose names the operators use inside
EXTRA = "lang string, source string, n_chars long, ver string, node int, start string, own int, part int, word string"


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text) pairs, with extra columns of clashing names."""
    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), "v", 1, "s", 2, 3, "w") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, " + EXTRA)
    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    return docs([(1, None), (2, ""), (3, "  \n\t "), (4, "a"), (5, "a b c"), (5, "a b c"), (6, "a b c"), (7, long),
                 (8, "é ß 中文 \x00 x"), (9, "one two"), (9, "other text"), (None, "a b c")])


@pytest.fixture(scope="session")
def random_texts():
    """Texts over few words, some sharing long runs."""
    import random
    rnd = random.Random(7)
    vocabulary = [f"t{i}" for i in range(60)]
    runs = [[rnd.choice(vocabulary) for _ in range(45)] for _ in range(4)]
    out = []
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            run = rnd.choice(runs)
            a = rnd.randint(0, 20)
            at = rnd.randint(0, len(words))
            words[at:at] = run[a:a + rnd.randint(10, 45)]
        out.append((i, rnd.choice([" ", "\n", "  "]).join(words)))
    return out + [(100, out[3][1]), (101, out[3][1]), (102, out[5][1] + " more")]
