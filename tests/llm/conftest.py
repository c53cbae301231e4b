import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "shard int, n_words long, score double, n_lines string, before int, h int")


def words(rng, n, vocabulary=400):
    return " ".join("w" + chr(97 + k % 26) + str(k) for k in
                    (rng.randrange(vocabulary) for _ in range(n)))


@pytest.fixture(scope="session")
def rows():
    """Small documents with nulls, empties, ties, repeated rows, copies and a long text;
    extra columns have names that operators use themselves."""
    rng = random.Random(7)
    out = []
    shared = [words(rng, 12) for _ in range(6)]
    for i in range(60):
        lines = [words(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 8))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), shared[i % 6])
        if i % 10 == 0:
            lines.append(shared[0].upper() + "  ")
        out.append((i, "\n".join(lines)))
    base = out[5][1] + "\n" + words(rng, 120)
    for k in range(8):                                   # near copies
        part = base.split(" ")
        part[k * 7] = f"changed{k}"
        out.append((100 + k, " ".join(part)))
    out += [(200 + k, base) for k in range(5)]           # exact copies
    out += [(300, None), (301, ""), (302, "\n"), (303, " \t\n "), (304, "one two"),
            (305, "ONE  two"), (306, "x" * 5000), (307, words(rng, 3000)), (308, "a a a a a a a"),
            (309, "Été 中文 ﬁ <|endoftext|> \x02 tab\there nbsp"),
            (310, "12 34. 56,\n\n78"), (None, "no id here at all, but text"), (None, None)]
    out += [(7, out[7][1]), (304, "one two")]            # repeated rows
    return [(i, t, ["en", "fr", None][(i or 0) % 3], f"s{(i or 0) % 4}" if i != 300 else None,
             len(t or ""), 1, 2, 0.5, "x", 3, 4) for i, t in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from corpuslink.session import get_spark
    return get_spark("local[4]", app="corpuslink-tests", shuffle_partitions=4,
                     extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cl-ckpt-")})
