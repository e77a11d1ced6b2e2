import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and tion ing worthless über naïve token AKIA key end Once 12 x".split()


def made_texts(n: int, seed: int = 7) -> list[str]:
    """Invented texts with copies, near copies and shared lines."""
    rng = random.Random(seed)
    texts: list[str] = []
    for i in range(n):
        if i % 5 == 3:
            texts.append(texts[rng.randrange(len(texts))])
        elif i % 5 == 4:
            words = texts[rng.randrange(len(texts))].split(" ")
            words[rng.randrange(len(words))] = "edited"
            texts.append(" ".join(words))
        else:
            lines = [
                " ".join(rng.choice(WORDS) + rng.choice(["", "", "ly", "."]) for _ in range(rng.randrange(1, 40)))
                for _ in range(rng.randrange(1, 5))
            ]
            texts.append("\n".join(lines))
    return texts


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rows = [(i, text, "en" if i % 3 else "de", f"s{i % 7}", len(text)) for i, text in enumerate(made_texts(60))]
    rows += [
        (100, None, "en", "s1", None),
        (101, "", "de", "s2", 0),
        (102, " \n\t ", None, "s3", 4),
        (103, "word " * 60_000, "en", "s4", 300_000),
        (104, "x" * 100_000, "en", None, 100_000),
        (105, "漢字 😀 ẞ ﬁ \u0000 <|endoftext|> <s> İ", "zz", "s5", 30),
        (106, "shared boilerplate line of the site\nown text", "en", None, 44),
        (None, "a text without an id", None, None, None),
    ]
    rows += [(200 + i, f"shared boilerplate line of the site\nnumber {i}", "en", f"s{i}", 40) for i in range(7)]
    return [*rows, rows[5], rows[5], (5, "another text under a used id", "en", "s1", 28)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge_docs):
    """edge_docs with extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    names = "key digest n_tokens score spans items found kept tail n_lines n_removed piece rank length bucket fp doc n n_words contaminated words lines".split()
    return edge_docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in names])
