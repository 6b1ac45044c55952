import random

import pytest

SYLLABLES = {"en": "the ing and tion er ed on at st wh ou".split(), "fr": "é eau ou ment tre le qu ai ç è".split(), "de": "sch ung ver ein ß ü ch keit ä er".split(), "es": "ción ñ os ado ll ie mente rr í ez".split()}


class Prose:
    """Invented prose from a seed."""

    def __init__(self, seed):
        self.rng = random.Random(seed)

    def words(self, n, lang="en"):
        return ["".join(self.rng.choices(SYLLABLES[lang], k=self.rng.randint(1, 4))) for _ in range(n)]

    def text(self, n, lang="en"):
        return " ".join(self.words(n, lang)).capitalize() + "."


@pytest.fixture
def prose(request):
    return Prose(request.node.name)


@pytest.fixture(scope="session")
def documents(spark):
    """documents-like rows with every hard case, and extra columns with names that operators use."""
    p = Prose(1)
    rows = []
    for k in range(240):
        lang = ("en", "fr", "de", "es")[k % 4]
        rows.append([k, p.text(p.rng.choice((3, 40, 150, 300)), lang), lang])
    base = p.text(200)
    rows += [[300 + k, base, "en"] for k in range(12)]  # exact copies
    for k in range(30):  # near copies around one source
        w = base.split()
        for _ in range(k % 5):
            w[p.rng.randrange(len(w))] = p.words(1)[0]
        rows.append([330 + k, " ".join(w), "en"])
    passage = p.text(60)
    rows += [[400 + k, f"{p.text(50)} {passage} {p.text(50)}", "en"] for k in range(15)]
    rows += [[500, None, "en"], [501, "", "fr"], [502, "   \n\t ", None], [503, "123 !!", "de"], [504, "-" * 500, None], [505, "ab " * 400, "en"], [506, "é" * 300, "fr"]]
    rows += [[507, p.text(60_000), "en"], [508, "x" * 1_200_000, None], [509, "one two", "en"], [510, "One  TWO", "en"], [511, "\x00a\x01b" * 60, None]]
    return spark.createDataFrame([(i, t, lang, "src0", len(t or ""), 1, 0.5, "z", 7) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, id int, score double, rejected string, n int").repartition(5).cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
