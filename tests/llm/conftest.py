import pytest
from pyspark.sql import functions as F

# Texts with the awkward cases: null, empty, blank, repeated, tied, accented, without spaces, very long.
LONG = " ".join(f"word{i % 997} stays{i % 31}" for i in range(9000))
TEXTS = [
    None, "", "  \n\t ", "same text here again", "same text here again", "same text here again", "Same text here again", "naïve café déjà-vu 12½ Straße",
    "日本語のテキスト と混ぜる", "x" * 5000, LONG, LONG + " end", "one", "one two", "emoji 🙂 and tab\tand\u00a0space", "Licensed under the MIT License? no.",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case, a repeated row, a repeated id and extra columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else None, "hot" if i % 3 else None, None) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (4, "another text under id four", "fr", "cold", 1), (None, "no id", "de", "cold", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = {c: F.lit("clash") for c in ("size", "shard", "sha", "bytes", "run", "ids", "fp", "score", "tokens", "part", "key", "_id", "_keep", "segment", "count", "slot")}
    return spark.createDataFrame(rows, schema).withColumns(extra)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
