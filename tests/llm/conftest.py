import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    spark.conf.set("spark.sql.shuffle.partitions", "3")


@pytest.fixture
def table(spark):
    """Documents from texts (or pairs of id and text)."""

    def build(*texts, more="", value=None):
        rows = []
        for k, t in enumerate(texts):
            doc_id, text = t if isinstance(t, tuple) else (k, t)
            row = (doc_id, text, "xx", "s", None if text is None else len(text))
            rows.append(row + (value,) * more.count(","))
        return spark.createDataFrame(rows, SCHEMA + more)

    return build


def corpus(seed: int, n: int = 60, words: int = 120) -> list:
    """Texts with copies, near copies, shared passages, odd characters, nulls and empty ones."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdéöñß中日") for _ in range(rnd.randint(1, 7))) for _ in range(400)]

    def words_of(k):
        return [rnd.choice(vocabulary) for _ in range(k)]

    passage = words_of(70)
    texts = []
    for _ in range(n):
        kind = rnd.random()
        if texts and kind < 0.15:
            texts.append(rnd.choice(texts))
        elif texts and kind < 0.4:
            own = rnd.choice([t for t in texts if t] or ["x"]).split(" ")
            for _ in range(rnd.randint(1, 1 + len(own) // 12)):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            texts.append(" ".join(own))
        elif kind < 0.6:
            a = words_of(rnd.randint(0, words))
            texts.append(" ".join(a + passage + words_of(rnd.randint(0, words))))
        elif kind < 0.7:
            texts.append(" ".join(words_of(rnd.randint(1, 6)) * rnd.randint(1, 40)))
        else:
            own = words_of(rnd.randint(1, words))
            texts.append("".join(w + rnd.choice([" ", " ", " ", "\n", "  ", ", ", ".\n"]) for w in own))
    texts[3:3] = [None, "", " ", "\n\t", None, "A", "A b C d"]
    return texts
