import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, text_sha256 string, __extra int"


def words(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Nulls, empty and white texts, one very long word and text, copies, near copies, shared passages and lines."""
    r = random.Random(3)
    base = words(r, 300)
    passage = words(r, 80)
    line = "  A shared Line of text "
    found = [None, "", " \t\n ", "one", "One", "a b c d", "a  b\tc d", "x" * 3000, "é漢字 ñandú\x0b\x0c\r end", base, base, base.replace(" ", "  ")]
    tokens = base.split()
    for i in range(6):
        t = list(tokens)
        for k in range(0, 300, 60 + i):
            t[k] = f"new{i}"
        found.append(" ".join(t))
    for i in range(12):
        found.append(words(r, 30 + 10 * i) + " " + passage + "\n" + line + "\n" + words(r, 60))
        found.append("intro\n\n" + words(r, 20) + "\n" + (line.lower() if i % 2 else line) + "\n\nunder the MIT License, version 2\n")
    found.append(" ".join([words(r, 4000, 9000), passage, words(r, 4000, 9000)]))
    found += [words(r, r.randrange(1, 120)) for _ in range(20)]
    return found


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with ids that don't follow the order, a null id, a repeated row, and columns whose names clash."""
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = [(i, t, "en", "s", len(t or ""), 1, "x", 2) for i, t in zip(ids, texts, strict=True)]
    rows += [rows[9], (None, "one", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
