from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"
WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te") for b in ("n", "sa", "vor", "pel", "dam", "x")]


def prose(seed: int, lines: int = 4, words: int = 12) -> str:
    rng = random.Random(seed)
    return "\n".join(
        " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words)).capitalize() + "."
        for _ in range(lines)
    )


@pytest.fixture(scope="session")
def documents(spark):
    """Texts of all kinds: null, empty, blank, long, equal, nearly equal, in any script."""
    base = prose(1)
    passage = prose(50, 1, 60)
    texts = [
        base,
        base,
        base.replace("kan", "Kan", 1),
        base + "\nOne more line that is not in the others.",
        None,
        "",
        "  \n\t\n ",
        "word",
        "two words",
        "Ünïcödé text, 数字 一二三 and 🙂🙂 signs. Done.\r\nNext\x0bline\x1c.",
        prose(2) + "\n" + passage,
        prose(3) + " " + passage + " " + prose(4),
        "a" * 5000,
        "ab " * 4000,
        prose(5, 300),
        prose(6) + "\n" + prose(6),
        "x" * 49 + "\n" + "y" * 50,
        "y" * 50,
        base.replace(".", "!"),
        "\n".join(f"A numbered line of the report, number {k % 7}" for k in range(30)),
    ]
    rows = [(k, text, "en", f"src{k % 3}", len(text or "")) for k, text in enumerate(texts)]
    rows.append(rows[3])  # a row that repeats whole
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null ids and sources, and columns that have the names of the operators' own."""
    rows = [(None, "no id here", None, None, None, 1), (7, None, None, None, None, 2)]
    rows.append((8, "eight " * 30, None, None, 180, 3))
    extra = "shard int, kept int, ids int, n_words int, gone int, spans int, _old int, line int"
    frame = spark.createDataFrame(rows, DOCUMENTS + ", slot int")
    return frame.selectExpr("*", *[f"slot as {c.split()[0]}" for c in extra.split(", ")])
