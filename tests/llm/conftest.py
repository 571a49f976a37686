import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score int, n_words string, id int, content int"
STEMS = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(STEMS, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of documents from (doc_id, text) or (doc_id, text, lang, source); other columns clash with operators' own names."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame([(i, t, g, s, len(t or ""), "own", 7, "own", 3, 4) for i, t, g, s in full], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, one-word, very long, tied and repeated rows."""
    rng = random.Random(5)
    long = "\n".join(sentence(rng, 40) for _ in range(700))
    return [(None, "a null id here", "en", "s1"), (1, None, "en", "s1"), (2, "", None, None), (3, " \n\t ", "en", ""), (4, "word", "en", "s2"),
            (5, long, "en", "s1"), (6, long, "en", "s1"), (7, "same text twice", "en", "s2"), (7, "same text twice", "en", "s2"),
            (8, "Émile ça va\x00   “q” 漢字 ᾼ", "fr", "s2"), (9, "12 34 !!", "en", None)]
