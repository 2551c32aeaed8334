import random

import pytest
from prose import prose


@pytest.fixture(scope="session")
def write(spark, tmp_path_factory):
    """Write rows as Parquet and read them again, as the operators' tables come."""

    def put(rows, schema):
        path = str(tmp_path_factory.mktemp("table") / "t.parquet")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return put


CLASH = "_f string, _r string, _row string, fp string, root string, size string, copies string, kept string, spans string, m string, h string, pos string, item string, copy string, score string, n_words string"


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, n_chars) with copies, near copies, blanks, nulls, ties and one long text."""
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(60)]
    texts += [texts[3], texts[3], texts[5] + " tail", "x " + texts[7], texts[8].upper()]
    passage = prose(rng, 70)
    texts += [prose(rng, 30) + " " + passage + "\n" + prose(rng, 20), passage, "a " + passage]
    texts += ["", " \t\n", "one", "one two three", "spam " * 300, prose(rng, 9000), "café naïve 　wide \x1cfs " * 9]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None]), len(t)) for i, t in enumerate(texts)]
    rows += [(900, None, "en", "a", None), (None, texts[3], None, None, None), (None, None, None, "b", 0)]
    rows += [rows[11], rows[11], (rows[12][0], *rows[13][1:])]
    return rows


@pytest.fixture(scope="session")
def docs(write, corpus):
    return write(corpus, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def wide(write, corpus):
    """The corpus with extra columns whose names the operators use inside."""
    extra = len(CLASH.split(", "))
    return write([(*r, *["kept as it is"] * extra) for r in corpus],
                 "doc_id long, text string, lang string, source string, n_chars long, " + CLASH)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
