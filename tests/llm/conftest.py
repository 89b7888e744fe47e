import pytest

#: Names that the operators use themselves, and that a table may have too.
CLASHING = "size long, shard string, slot string, score double, target string, node string, bucket int, n_words string, _items int, _row int, _id long, _key int, _cut string, _copies int, _found int, copies int, `_Spans` int, reason string"


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows, clashing=False):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame(full, kinds).repartition(3)
        if clashing:
            names = [c.strip().split(" ") for c in CLASHING.split(",")]
            df = df.selectExpr("*", *[f"cast(null as {t}) as {n}" for n, t in names])
        return df

    return make


def text(seed: int, words: int, vocabulary: int = 5000) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))
