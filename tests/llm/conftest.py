import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc string, text_a int"


def prose(seed, n=60):
    return " ".join(f"word{(seed * 31 + i * i * 7 + i) % 997}" for i in range(n)) + "."


@pytest.fixture(scope="session")
def rows():
    """Ties, copies, NULLs, empties, a very long text, and columns whose names clash with inner ones."""
    texts = [prose(1), prose(1), prose(2), None, "", " ", "a", "tiny text", prose(3) + "\n" + prose(3)]
    texts += [prose(4) + " me.x@mail.example.com or +1 (555) 123-4567 " + prose(5), "4111 1111 1111 1111 10.0.0.256 1.2.3.4.5"]
    texts += ["aaaa" * 200, prose(2) + " tail", "Ünï çödé 😀 " + prose(6), "|#*$" * 60, prose(7, 30000)]
    texts += [prose(1)[:200], "x\ty  z \n\n end ", "<|endoftext|> a", prose(8) + " " + prose(1)]
    found = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, 0, "d", 1) for i, t in enumerate(texts)]
    return [*found, (3, None, None, None, None, None, None), (1, prose(1), "en", "s1", 0, "d", 1), (None, prose(9), "en", "s0", 0, "d", 1)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
