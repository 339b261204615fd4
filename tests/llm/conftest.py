from __future__ import annotations

import random
import uuid

import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, tag string, h long, rows int, node string"


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): nulls, empty and long texts, copies, near copies, shared passages and lines, odd characters."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgéßñ日") for _ in range(rng.randint(1, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, line = prose(70), "A line that many of the documents share, " + prose(4)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "short"), (4, "\n\n"), (5, "a" * 3000), (6, "x y " * 900)]
    base = prose(200)
    for k in range(7, 12):
        rows.append((k, base if k % 2 else base.upper()))
    for k in range(12, 30):  # near copies
        words = base.split()
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((k, " ".join(words)))
    for k in range(30, 60):
        text = prose(rng.randint(1, 120))
        if k % 2:
            text += "\n" + line + "\n" + prose(5)
        if k % 3 == 0:
            text = prose(3) + " " + passage + " " + text
        rows.append((k, text))
    rows.append((60, prose(9000) + "   \n \t don't we'll 12345 " + "z" * 700 + " " * 600 + prose(3000)))
    rows += [(61, "don't  stop\n\n it's 'RE  "), (62, "é   　 x\x1cy 1234 <|endoftext|>"), (63, "  İ ß")]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def docs(spark, corpus):
    """The corpus with columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "en", f"s{d % 3}", None, "x", 1, 2, None) for d, t in corpus], COLUMNS).repartition(5)


@pytest.fixture
def scratch(spark):
    from fulluse.llm.common import Scratch

    return Scratch(spark)


@pytest.fixture
def folder():
    return uuid.uuid4().hex
