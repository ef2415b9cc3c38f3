import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, texts, sources=None, ids=None):
    rows = [(i if ids is None else ids[k], t, "en", (sources or ["s"])[k % len(sources or ["s"])], len(t or "")) for k, (i, t) in enumerate(enumerate(texts))]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts(seed=1):
    """Near and exact copies, shared passages, short, empty, blank, null, huge and multilingual texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage = text(60)
    base = text(120).split()
    near = []
    for _ in range(6):
        words = list(base)
        words[r.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    out = [text(r.randint(20, 200)) for _ in range(12)] + near + [" ".join(base)] * 3
    out += [f"{text(30)} {passage} {text(20)}", f"{passage}\n{text(25)}", f"{text(3)} {passage}", "x " * 90, "one", "two words", "A\tB\x0bC", "", "  \n ", None, None, text(30_000)]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return make(spark, odd_texts())


@pytest.fixture(scope="session")
def texts():
    return odd_texts()
