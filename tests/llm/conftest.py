import public_tokenizers
import pytest

SF = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

#: Texts that exercise the edges of every text operator.
ODD_TEXTS = [
    "",
    None,
    " ",
    "\n\t ",
    "a",
    "a\x1cb c\x1f d\x85e f",
    "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>",
    "I'll don't O'S 's é é ΑΣ İ ẞ",
    "x" * 5000,
    "你好世界" * 200,
    "\U0001f600\U0001f44d\U0001f3fd ‍",
    "\x00\x01 \x7f",
    "word " * 20000,
    "ab" * 300 + "ba" * 300,
    "Same text twice.",
    "Same text twice.",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with ids, nulls in every column, a repeated row and columns
    whose names operators use themselves."""
    rows = [(i, t, None, i, "n", 0.5) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens long, row string, score double")


@pytest.fixture(scope="session")
def repeated(spark):
    """Null and repeated ids."""
    rows = [(3, "one two"), (3, "one two"), (3, "other"), (None, "x y"), (None, None), (1, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")
