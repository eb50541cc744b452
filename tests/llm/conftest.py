"""Small documents with planted cases, shared by the operators' tests."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted() -> list[tuple]:
    """Near copies of many sizes, shared passages, personal data, odd texts, nulls and very long texts."""
    rnd, out, vocabulary = random.Random(5), [], [f"w{k}" for k in range(300)]

    def add(text):
        out.append((100 + len(out), text, "en", "s", len(text or "")))

    for _ in range(8):
        source = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 4, 5, 8, 15, 25, 60, 200]))]
        for _ in range(rnd.choice([3, 15, 30])):
            words = list(source)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                at, kind = rnd.randrange(len(words)), rnd.random()
                if kind < 0.4:
                    words[at] = rnd.choice(vocabulary)
                elif kind < 0.7:
                    words.insert(at, rnd.choice(vocabulary))
                elif len(words) > 1:
                    del words[at]
            add(" ".join(words) if rnd.random() < 0.8 else "\t".join(words).upper())
    passage = "é" * 30 + "a passage of words that repeats across many of the documents"
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    for _ in range(25):
        add(noise(rnd.randint(0, 80)) + passage + noise(rnd.randint(0, 80)))
    for text in (
        None, "", " \n\t ", "a", "A", "a b", "a b c", "a" * 1000, "a" * 49, "b" + "a" * 50, "ab" * 500, "ab" * 40, "x" * 50, "x" * 50,
        "a<|endoftext|>b  \n c<|endoftext|>X <|startoftext|>", "it's we'll \t\t x   z Déjà VU, É. É́ ΑΣ ΑΣ. İx don't 12ab ab12. a.b,c",
        "日本語 ١٢٣ ½ é́ \x1c\x1f|\x85y <|endoftext|><|endoftext|>", "mail a@b.c-%d@e.f x@y.z. 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 9.9.9",
        "4111 1111-1111 1111 4111  1111 1111 1111 4111111111111111- 5 +1 (988) 555-2485 +12 . +44 20 7946 0958, 4111111111111111",
        "Released under the MIT License. mit license\nMIT-License apache license", "x\nAll rights reserved.\nGNU general public license, General Public License",
        "one two three four five six seven eight nine ten " * 3, "line\nline\nother\n \nline", "word " * 5000, "the of and to " + "### $$$ " * 20,
    ):
        add(text)
    out += [(None, "a row without an id, a row without an id", None, None, None), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="session")
def rows():
    return planted()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The planted rows over several partitions, with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("kept", "spans", "digest", "key", "root", "count", "quality_rules", "n", "a.b"):
        df = df.withColumn(name, F.lit("own"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
